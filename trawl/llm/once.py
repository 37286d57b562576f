"""A column that is worked out once a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(rows: DataFrame, name: str, column: Column) -> DataFrame:
    """The rows with one more column, as a generator of one row each.

    The optimizer copies a plain column's expression into every filter and
    lambda that names it, and an expression within a lambda is worked out for
    each element; it does not look into a generator.
    """
    return rows.select("*", F.explode(F.array(column)).alias(name))
