"""Top-k per query and late materialisation of the wide columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trawl.plans.sizing import BROADCAST_ROWS, SALTS, at_most

WINDOW_LIMIT_ROWS = 1000
PAYLOAD = ("uri", "text", "urtext", "parent_id", "labels", "metadata", "ingestion_timestamp")


def check_k(k: int) -> int:
    if k < 1:
        raise ValueError("k must be at least 1")
    return k


def top_k(scored: DataFrame, k: int, score: str = "score") -> DataFrame:
    """The ``k`` best rows per ``query_id`` with their ``rank``.

    Scores are ranked as they are; exact ties go to the smaller id.  Spark keeps
    only ``k`` rows per query and task ahead of the shuffle (window group
    limit); that holds below a thousand, so a larger ``k`` is cut in two steps,
    first within salted slices of each query.
    """
    check_k(k)
    order = [F.col(score).desc(), F.col("id").asc()]
    ranked = scored
    if k >= WINDOW_LIMIT_ROWS:
        slices = Window.partitionBy("query_id", "_slice").orderBy(*order)
        ranked = (
            ranked.withColumn("_slice", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
            .withColumn("_in_slice", F.row_number().over(slices))
            .where(F.col("_in_slice") <= k)
            .drop("_slice", "_in_slice")
        )
    per_query = Window.partitionBy("query_id").orderBy(*order)
    return ranked.withColumn("rank", F.row_number().over(per_query)).where(F.col("rank") <= k)


def cut(results: DataFrame, threshold: float = 0.0, ceiling: float | None = None) -> DataFrame:
    """Drop results below the threshold, after the top-k.

    With a ``ceiling`` a stricter threshold is eased to it.
    """
    limit = threshold if ceiling is None else min(threshold, ceiling)
    return results.where(F.col("score") >= F.lit(float(limit)))


def with_payload(results: DataFrame, elements: DataFrame, rows: int, columns=PAYLOAD) -> DataFrame:
    """Join the wide columns back onto a finished ranking.

    ``rows`` bounds the ranking (queries times k); small rankings are
    broadcast, so the element table is read once and not shuffled.
    """
    wide = [c for c in columns if c in elements.columns]
    side = F.broadcast(results) if rows <= BROADCAST_ROWS else results
    return elements.select("id", *wide).join(side, "id")


def bounded_rows(queries: DataFrame, k: int, limit: int = BROADCAST_ROWS) -> int:
    """queries x k when that is within ``limit``, else just above it."""
    most = max(limit // k, 1)
    return most * k if at_most(queries, most) else limit + 1
