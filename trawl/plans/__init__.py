"""Plan building blocks (top-k, sizing, lineage) and the registered queries."""
