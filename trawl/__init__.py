"""Batch retrieval on Spark: a table of queries against a table of content.

Every operator takes DataFrames and returns a DataFrame.  A single query is a
query table with one row.
"""
