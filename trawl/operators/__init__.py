"""Search, write, delete, lookup and entity operators."""
