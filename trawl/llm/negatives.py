"""Hard negatives: for each anchor and positive the best rows of other labels in a score window.

An anchor's positives are its best rows of the same label.  A positive with
score p opens the window from ``low_percent`` hundredths of p up to p, and its
negatives are the best rows of other labels within.  The windows of an anchor
overlap, so its scores are split at the positives' scores, the upper limits,
into disjoint slots.  Every task keeps the best rows of each slot, those are
merged per slot, and a positive reads the slots from its own downwards: the
slots are in falling order, so a suffix of the joined lists is the answer, cut
at the lower limit.

Anchors meet rows in groups: rows are dealt into groups of bounded size, a
group is held by one task as a matrix, and the anchors stream past it.  The
work is anchors x rows by its nature; what moves is each row once, each anchor
once a group, and the kept rows.  Nothing is broadcast or held by the driver.

Awkward rows: those with a null id, label or vector, or a null or non-finite
component, take no part.  An id names one row: of rows that share it the first
by label (as text) and vector counts, so repeated rows count once.  A missing
component of a shorter vector counts as zero.  Equal scores go by the smaller
id.  Anchors without a positive, and windows of negative positives, give no
rows.  Scores beyond 64 bits stop at their bounds.  Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trawl.plans.lineage import materialize

#: Bytes of the matrix one task holds.
GROUP_BYTES = 32 << 20
#: Rows a group has at least, as long as that leaves fewer groups than shuffle partitions.
GROUP_ROWS = 256
#: Anchors compared at a time.
TILE = 64
MOST = (1 << 63) - 1


def first_places(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores in falling order, ties by place."""
    places = np.arange(len(scores))
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > least)
        places = np.concatenate([above, np.flatnonzero(scores == least)[: k - len(above)]])
    return places[np.lexsort((places, ~scores[places]))]


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors as the rows of a matrix, short ones filled with zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(sizes.max()) if len(sizes) else 0
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _widened(matrix: np.ndarray, width: int) -> np.ndarray:
    return np.pad(matrix[:, :width], ((0, 0), (0, max(0, width - matrix.shape[1]))))


def _largest(matrix: np.ndarray) -> int:
    return max(int(matrix.max()), -int(matrix.min())) if matrix.size else 0


class Group:
    """The rows of one task, by rising id."""

    def __init__(self, ids: list, labels: list, parts: list):
        width = max((p.shape[1] for p in parts), default=0)
        self.ids = np.concatenate([np.zeros(0, np.int64), *ids])
        self.matrix = np.concatenate([np.zeros((0, width), np.int64), *(_widened(p, width) for p in parts)])
        self.codes: dict[str, int] = {}
        self.labels = np.array([self.code(x) for x in labels], dtype=np.int64)
        self.floats = self.matrix.astype(np.float64).T
        self.largest = _largest(self.matrix)

    def code(self, label: str) -> int:
        return self.codes.setdefault(label, len(self.codes))

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        """Inner products, exact: doubles hold whole numbers below 2 ** 53."""
        width = self.matrix.shape[1]
        vectors = _widened(vectors, width)
        if width * self.largest * _largest(vectors) < 1 << 53:
            return (vectors.astype(np.float64) @ self.floats).astype(np.int64)
        whole = vectors.astype(object) @ self.matrix.T.astype(object)
        return np.clip(whole, -MOST, MOST).astype(np.int64)


def _past_groups(work: Callable, names: list[str]):
    """A function for mapInArrow: rows (kind 0) become a Group, then anchors
    (kind 1) go past it; ``work(group, scores, id, label, limits)`` yields columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, parts, group = [], [], [], None
        for batch in batches:
            kinds = batch.column("kind").to_numpy(zero_copy_only=False)
            cut = int(np.searchsorted(kinds, 1))
            if cut:
                rows = batch.slice(0, cut)
                ids.append(rows.column("id").to_numpy(zero_copy_only=False))
                labels += rows.column("label").to_pylist()
                parts.append(_matrix(rows.column("vector")))
            anchors = batch.slice(cut)
            if not anchors.num_rows:
                continue
            if group is None:
                group = Group(ids, labels, parts)
                ids, labels, parts = [], [], []
            found = []
            for first in range(0, anchors.num_rows, TILE):
                tile = anchors.slice(first, TILE)
                scores = group.scores(_matrix(tile.column("vector")))
                asked = zip(*(tile.column(c).to_pylist() for c in ("id", "label", "limits")))
                for row, (anchor, label, limits) in zip(scores, asked):
                    for part in work(group, row, anchor, group.code(label), limits):
                        found.append([np.full(len(part[-1]), anchor, np.int64), *part])
            if found:
                columns = [pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*found)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _same_label(k: int) -> Callable:
    def work(group, scores, anchor, label, limits):
        places = np.flatnonzero((group.labels == label) & (group.ids != anchor))
        best = places[first_places(scores[places], k)]
        yield group.ids[best], scores[best]

    return work


def _slots(k: int, low_percent: int) -> Callable:
    def work(group, scores, anchor, label, limits):
        rising = np.array(limits[::-1], dtype=np.int64)
        open_windows = rising[rising >= 0]
        if not len(open_windows):
            return
        lowest = -(-low_percent * int(open_windows[0]) // 100)
        places = np.flatnonzero((group.labels != label) & (scores >= lowest) & (scores <= rising[-1]))
        slots = len(rising) - 1 - np.searchsorted(rising, scores[places], side="left")
        for slot in np.unique(slots):
            own = places[slots == slot]
            best = own[first_places(scores[own], k)]
            yield np.full(len(best), slot), group.ids[best], scores[best]

    return work


def _against_all(rows: DataFrame, anchors: DataFrame, groups: int, work: Callable, names: list[str]) -> DataFrame:
    """``work`` on every anchor and every group of rows."""
    no_limits = F.array().cast("array<bigint>")
    dealt = rows.select(
        F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int").alias("group"), F.lit(0).alias("kind"),
        "id", "label", "vector", no_limits.alias("limits"),
    )
    copies = anchors.select(
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), F.lit(1).alias("kind"),
        "id", "label", "vector", "limits",
    )
    placed = dealt.unionByName(copies).repartitionById(groups, F.col("group")).sortWithinPartitions("kind", "id")
    schema = ", ".join(f"{n} long" for n in names)
    return placed.drop("group").mapInArrow(_past_groups(work, names), schema)


def _best(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("id"))
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("place")


def prepared(
    rows: DataFrame, anchors: Column, *, scale: float = 256.0, id_column: str = "vec_id",
    label_column: str = "label", vector_column: str = "embedding",
) -> DataFrame:
    """(id, label, vector of whole numbers, anchor), one row an id."""
    named = rows.select(
        rows[id_column].cast("long").alias("id"), rows[label_column].cast("string").alias("label"),
        rows[vector_column].cast("array<double>").alias("raw"), F.coalesce(anchors, F.lit(False)).alias("anchor"),
    ).where("id IS NOT NULL AND label IS NOT NULL AND raw IS NOT NULL")
    finite = F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("raw", lambda x: F.floor(x * F.lit(float(scale))))
    one = F.min(F.struct("label", "vector", "anchor")).alias("row")
    return (
        named.where(finite).select("id", "label", whole.alias("vector"), "anchor")
        .groupBy("id").agg(one).select("id", "row.label", "row.vector", "row.anchor")
    )


def hard_negatives(
    rows: DataFrame, anchors: Column, *, positives: int = 5, negatives: int = 5, low_percent: int = 80,
    scale: float = 256.0, id_column: str = "vec_id", label_column: str = "label", vector_column: str = "embedding",
) -> DataFrame:
    """(anchor, positive, rank, negative, positive_score, negative_score).

    ``anchors`` says which rows are asked.  Components count as
    floor(``scale`` x component); scores are inner products of these.
    """
    if positives < 1 or negatives < 1 or not 0 <= low_percent <= 100:
        raise ValueError("at least one positive and negative, and a lower limit within 0..100 per cent")
    spark = rows.sparkSession
    table = materialize(prepared(
        rows, anchors, scale=scale, id_column=id_column, label_column=label_column, vector_column=vector_column))
    count, components = table.agg(F.count("*"), F.sum(F.size("vector").cast("long"))).first()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = max(-(-8 * (components or 0) // GROUP_BYTES), min(partitions, -(-count // GROUP_ROWS)), 1)

    asked = table.where("anchor").drop("anchor")
    bare = asked.withColumn("limits", F.array().cast("array<bigint>"))
    same = _against_all(table, bare, groups, _same_label(positives), ["anchor", "id", "score"])
    best = materialize(_best(same, ["anchor"], positives))

    limits = best.groupBy("anchor").agg(F.sort_array(F.collect_set("score"), asc=False).alias("limits"))
    limited = asked.join(limits.withColumnRenamed("anchor", "id"), "id")
    kept = _against_all(
        table, limited, groups, _slots(negatives, low_percent), ["anchor", "slot", "id", "score"])
    falling = F.sort_array(F.collect_list(F.struct("slot", (-F.col("score")).alias("behind"), "id")))
    joined = _best(kept, ["anchor", "slot"], negatives).groupBy("anchor").agg(falling.alias("falling"))

    slot = F.array_position("limits", F.col("score")) - 1
    wide = lambda c: c.cast("decimal(38,0)")
    asked_low = wide(F.col("positive_score")) * low_percent
    return (
        best.join(limits, "anchor")
        .select("anchor", F.col("id").alias("positive"), F.col("score").alias("positive_score"), slot.alias("slot"))
        .join(joined, "anchor")
        .select(
            "anchor", "positive", "positive_score",
            F.posexplode(F.slice(F.filter("falling", lambda x: x["slot"] >= F.col("slot")), 1, negatives)),
        )
        .where(wide(-F.col("col.behind")) * 100 >= asked_low)
        .select(
            "anchor", "positive", (F.col("pos") + 1).cast("int").alias("rank"), F.col("col.id").alias("negative"),
            "positive_score", (-F.col("col.behind")).alias("negative_score"),
        )
    )
