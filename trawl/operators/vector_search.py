"""Exact and approximate cosine search of a query table against a corpus.

The corpus is scanned in place and never shuffled: every task compares its
Arrow batches with a block of query vectors and keeps a running top-k, so a
task emits at most ``queries x k`` rows whatever it reads.  A query block is bounded
in bytes and rows; a query table larger than one block is searched in as many
scans as it has blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.functions.filters import Filter, combine
from trawl.plans.lineage import materialize
from trawl.plans.topk import bounded_rows, check_k, cut, top_k, with_payload

QUERY_BLOCK_BYTES = 32 << 20
QUERY_BLOCK_ROWS = 16_384
SLICE_ROWS, SLICE_QUERIES = 1024, 2048
HITS = "query_id string, id string, score double"
EVERYWHERE = -1
Embedder = Callable[[DataFrame], DataFrame]
#: More than a matrix product of unit vectors can be off.
MATRIX_ERROR = 1e-9
#: Share of the cells that an approximate search visits by default.
PROBED = 0.7


def embedded(queries: DataFrame, embed: Embedder | None) -> DataFrame:
    """The queries with their vectors; an embedder's are made once."""
    return queries if embed is None else materialize(embed(queries))


def is_chunk() -> Column:
    """Only chunks are searchable."""
    return F.array_contains("labels", "Chunk")


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; zero rows become NaN and are left out."""
    lengths = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    with np.errstate(divide="ignore", invalid="ignore"):
        return vectors / lengths[:, None]


def arrow_matrix(column: pa.ChunkedArray | pa.Array, dimension: int) -> np.ndarray:
    """A non-null Arrow list column as a double matrix, lengths checked."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(flat) != len(column) * dimension or not (np.diff(column.offsets.to_numpy()) == dimension).all():
        raise ValueError(f"every embedding must have {dimension} numbers")
    return flat.astype(np.float64).reshape(len(column), dimension)


class Best:
    """The k best (score, id) pairs of each query; ties go to the smaller id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.floors = np.full(queries, -np.inf)
        self.held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def offer(self, members: np.ndarray, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, unit: np.ndarray) -> None:
        """Scores of corpus ``rows`` (down) for the queries ``members`` (across)."""
        peaks = scores.max(axis=0)
        for at in np.flatnonzero((peaks >= self.floors[members] - MATRIX_ERROR) & (peaks > -np.inf)):
            self._keep(int(members[at]), scores[:, at], ids, rows, unit[:, at])

    def _keep(self, q: int, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, asked: np.ndarray) -> None:
        near = np.flatnonzero((scores >= self.floors[q] - MATRIX_ERROR) & (scores > -np.inf))
        if len(near) > self.k:
            kept = scores[near]
            near = near[kept >= np.partition(kept, len(kept) - self.k)[len(kept) - self.k] - MATRIX_ERROR]
        # a matrix product may give equal rows last digits of their own; summed
        # up row by row, equal vectors have equal scores
        scores, ids = (rows[near] * asked).sum(axis=1), ids[near]
        if q in self.held:
            scores = np.concatenate([self.held[q][0], scores])
            ids = np.concatenate([self.held[q][1], ids])
        order = np.lexsort((ids.astype(str), -scores))[: self.k]
        self.held[q] = scores[order], ids[order]
        if len(order) == self.k:
            self.floors[q] = scores[order[-1]]


def scan_kernel(query_ids: list[str], vectors: np.ndarray, cells: list[list[int]] | None, k: int):
    """An Arrow kernel that keeps the best corpus rows for a block of queries.

    Corpus batches hold ``id``, ``embedding`` and, when ``cells`` is given, the
    ``cell`` of each row; a query then only meets the rows of its own cells.
    Score matrices are formed in slices of a fixed size.
    """
    dimension = vectors.shape[1]
    unit = unit_rows(vectors).T
    grouped: dict[int, list[int]] = {}
    for q, own in enumerate(cells or [[EVERYWHERE]] * len(query_ids)):
        for cell in own:
            grouped.setdefault(cell, []).append(q)
    by_cell = {cell: np.array(members) for cell, members in grouped.items()}

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(query_ids), k)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows = unit_rows(arrow_matrix(batch.column("embedding"), dimension))
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            cell_of = (
                np.full(len(ids), EVERYWHERE)
                if cells is None
                else batch.column("cell").to_numpy(zero_copy_only=False)
            )
            for cell in np.unique(cell_of):
                members = by_cell.get(int(cell), ())
                here = np.flatnonzero(cell_of == cell)
                for i in range(0, len(here) if len(members) else 0, SLICE_ROWS):
                    part = here[i : i + SLICE_ROWS]
                    for j in range(0, len(members), SLICE_QUERIES):
                        asked = members[j : j + SLICE_QUERIES]
                        scores = rows[part] @ unit[:, asked]
                        scores[np.isnan(scores)] = -np.inf
                        best.offer(asked, scores, ids[part], rows[part], unit[:, asked])
        for q, (scores, ids) in best.held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([query_ids[q]] * len(ids), pa.string()), pa.array(ids, pa.string()), pa.array(scores, pa.float64())],
                names=["query_id", "id", "score"],
            )

    return kernel


def query_blocks(queries: DataFrame, block_bytes: int = QUERY_BLOCK_BYTES):
    """(ids, vectors) blocks of the query table, each of a bounded size."""
    present = queries.where(F.col("embedding").isNotNull()).select(
        F.col("query_id").cast("string").alias("query_id"), F.col("embedding").cast("array<float>").alias("embedding")
    )
    total, dimension, shortest = present.agg(
        F.count("*"), F.max(F.size("embedding")), F.min(F.size("embedding"))
    ).first()
    if not total:
        return
    if dimension != shortest:
        raise ValueError("query embeddings differ in length")
    blocks = max(ceil(total * dimension * 4 / block_bytes), ceil(total / QUERY_BLOCK_ROWS))
    numbered = present.withColumn("_block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
    for number in range(blocks):
        part = numbered if blocks == 1 else numbered.where(F.col("_block") == number)
        table = part.select("query_id", "embedding").toArrow()
        if table.num_rows:
            yield table.column("query_id").to_pylist(), arrow_matrix(table.column("embedding"), dimension)


def empty_hits(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], HITS)


def nearest(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    *,
    block_bytes: int = QUERY_BLOCK_BYTES,
) -> DataFrame:
    """(query_id, rank, id, score) of the ``k`` nearest corpus rows."""
    check_k(k)
    rows = corpus.where(F.col("embedding").isNotNull()).select(
        F.col("id").cast("string").alias("id"), F.col("embedding").cast("array<float>").alias("embedding")
    )
    scans = [
        rows.mapInArrow(scan_kernel(ids, vectors, None, k), HITS)
        for ids, vectors in query_blocks(queries, block_bytes)
    ]
    hits = reduce(DataFrame.unionByName, scans) if scans else empty_hits(corpus)
    return top_k(hits, k)


def vector_search(
    queries: DataFrame,
    elements: DataFrame,
    k: int = 10,
    threshold: float = 0.0,
    *,
    ceiling: float | None = 0.5,
    metadata_filter: Filter | None = None,
    entity_filter: Filter | None = None,
    payload: bool = True,
    embed: Embedder | None = None,
) -> DataFrame:
    """Chunks nearest to each query, best ``k`` first, then the score cut.

    Filters narrow the corpus ahead of the top-k; pass ``ceiling=None`` with
    them to take the threshold as it is.  ``embed`` (DataFrame -> DataFrame)
    fills the queries' vectors from their texts.
    """
    queries = embedded(queries, embed)
    corpus = elements.where(is_chunk() & combine(metadata_filter, entity_filter))
    ranked = cut(nearest(queries, corpus, k), threshold, ceiling)
    return with_payload(ranked, elements, bounded_rows(queries, k)) if payload else ranked


# --- approximate search ----------------------------------------------------


def train_cells(corpus: DataFrame, cells: int, *, seed: int = 17) -> np.ndarray:
    """Cell centres by k-means over unit vectors.

    Spark trains them on every row; only the centres come to the driver.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import Normalizer
    from pyspark.ml.functions import array_to_vector

    rows = corpus.where(F.col("embedding").isNotNull()).select(
        array_to_vector(F.col("embedding").cast("array<double>")).alias("raw")
    )
    total = rows.count()
    unit = Normalizer(inputCol="raw", outputCol="features", p=2.0).transform(rows).select("features")
    model = KMeans(k=max(2, min(cells, total)), seed=seed, maxIter=10).fit(unit)
    return unit_rows(np.array(model.clusterCenters()))


def closest_cells(vectors: np.ndarray, centres: np.ndarray, probes: int) -> np.ndarray:
    similarity = unit_rows(vectors) @ centres.T
    probes = min(probes, centres.shape[0])
    return np.argsort(-similarity, axis=1, kind="stable")[:, :probes]


def assign_cells(corpus: DataFrame, centres: np.ndarray) -> DataFrame:
    """(id, embedding, cell): each row with its closest centre, row by row.

    Written partitioned by ``cell``, the result is the stored form of the
    approximate index: a search then reads only the probed cells.
    """
    dimension = centres.shape[1]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors = arrow_matrix(batch.column("embedding"), dimension)
                cell = closest_cells(np.nan_to_num(vectors), centres, 1)[:, 0]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(cell, pa.int32())], names=["id", "embedding", "cell"]
                )

    rows = corpus.where(F.col("embedding").isNotNull()).select(
        F.col("id").cast("string").alias("id"), F.col("embedding").cast("array<float>").alias("embedding")
    )
    return rows.mapInArrow(assign, "id string, embedding array<float>, cell int")


def nearest_approximate(
    queries: DataFrame,
    indexed: DataFrame,
    centres: np.ndarray,
    k: int,
    *,
    probes: int | None = None,
    block_bytes: int = QUERY_BLOCK_BYTES,
) -> DataFrame:
    """Top-k among the rows of each query's closest cells, scored exactly.

    Without ``probes`` a query visits ``PROBED`` of the cells, which keeps
    recall above 0.9 even where vectors form no clusters; clustered vectors
    need far fewer.
    """
    check_k(k)
    probes = max(8, ceil(PROBED * len(centres))) if probes is None else probes
    scans = []
    for ids, vectors in query_blocks(queries, block_bytes):
        cells = closest_cells(np.nan_to_num(vectors), centres, probes).tolist()
        probed = sorted({cell for own in cells for cell in own})
        rows = indexed.where(F.col("cell").isin(probed)).select("id", "embedding", "cell")
        scans.append(rows.mapInArrow(scan_kernel(ids, vectors, cells, k), HITS))
    hits = reduce(DataFrame.unionByName, scans) if scans else empty_hits(indexed)
    return top_k(hits, k)


def recall(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """(query_id, found, wanted): how much of the exact top-k was found."""
    hit = approximate.select("query_id", "id", F.lit(1).alias("hit"))
    return (
        exact.select("query_id", "id")
        .join(hit, ["query_id", "id"], "left")
        .groupBy("query_id")
        .agg(F.count("hit").alias("found"), F.count("*").alias("wanted"))
    )
