"""Joins whose small side is checked, with a way that holds beyond the check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
SALTS = 32


def at_most(df: DataFrame, rows: int) -> bool:
    """True when ``df`` has no more than ``rows`` rows; only partial counts move."""
    return df.count() <= rows


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a side that a join shuffles and sorts.

    Spark broadcasts a side by its compressed bytes, which for millions of
    alike short rows are few, and the driver then holds the rows whole.
    """
    return df.hint("merge")


def join_checked(
    big: DataFrame,
    small: DataFrame,
    on: str,
    spread: str | None = None,
    *,
    rows: int | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Inner join of a large table with a query-side one.

    The query side is broadcast when its row count passes the check.  Beyond
    it both sides are shuffled, whatever their files weigh.  Where a key of the large side may repeat
    without limit (a word, a parent), name a ``spread`` column: its hash salts
    the key, so one that holds a third of the rows is shared by ``salts``
    tasks.  Keys unique on the large side need none.
    """
    if at_most(small, BROADCAST_ROWS if rows is None else rows):
        return big.join(F.broadcast(small), on)
    if spread is None:
        return big.join(shuffled(small), on)
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
    return salted.join(shuffled(copies), [on, "_salt"]).drop("_salt")
