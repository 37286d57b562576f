"""Schemas, adapters from the given tables, and the bucketed Parquet store."""
