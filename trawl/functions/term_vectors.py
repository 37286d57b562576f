"""Vectors of texts by signed feature hashing of their words.

A word's digest names one of ``BUCKETS`` buckets, a slot of the vector and a
sign.  Buckets are weighed by how few texts have them; the table of weights has
one row a bucket, whatever the corpus, so each task has it whole.  Arrow
batches look up each distinct word once and sum a text's words where it is
read; one row a text is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.functions.text import words
from trawl.operators.lexicon import slices
from trawl.plans.lineage import materialize

BUCKETS = 1 << 16
DIMENSION = 64


def _digested(held: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The row, bucket and sign of every word of a column of word lists."""
    flat = held.flatten().dictionary_encode()
    digests = [md5(w.encode()).digest() for w in flat.dictionary.to_pylist()]
    bucket = np.array([d[0] << 8 | d[1] for d in digests], np.int64)
    sign = np.array([1.0 if d[2] < 128 else -1.0 for d in digests])
    of_word = flat.indices.to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(held)), np.diff(held.offsets.to_numpy()))
    return row, bucket[of_word], sign[of_word]


def _having(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, texts) of a task: how many texts have a word of the bucket."""
    texts = np.zeros(BUCKETS, np.int64)
    for batch in slices(batches):
        row, bucket, _ = _digested(batch.column(1))
        texts += np.bincount(np.unique(row * BUCKETS + bucket) % BUCKETS, minlength=BUCKETS)
    found = np.flatnonzero(texts)
    yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(texts[found])], names=["bucket", "texts"])


def bucket_weights(texts: DataFrame, text: str = "text") -> DataFrame:
    """(bucket, weight) of all buckets: ln((1 + texts) / (1 + texts with it)) + 1."""
    held = texts.select(F.lit(None).cast("string").alias("key"), words(F.col(text)).alias("words"))
    having = held.mapInArrow(_having, "bucket int, texts bigint").groupBy("bucket").agg(F.sum("texts").alias("texts"))
    total = texts.count()
    weight = F.log((1.0 + F.lit(total)) / (1.0 + F.coalesce("texts", F.lit(0)))) + 1.0
    every = texts.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    return materialize(every.join(having, "bucket", "left").select("bucket", weight.alias("weight")))


def _summed(weights: np.ndarray, dimension: int):
    """An Arrow kernel from (key, words) to (key, embedding)."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            row, bucket, sign = _digested(batch.column(1))
            sums = np.bincount(row * dimension + bucket % dimension, sign * weights[bucket], batch.num_rows * dimension)
            offsets = np.arange(0, len(sums) + 1, dimension, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(sums))], names=["key", "embedding"]
            )

    return kernel


def term_vectors(rows: DataFrame, weights: DataFrame, key: str, text: str, dimension: int = DIMENSION) -> DataFrame:
    """(key, embedding) of every text that has a word; texts of one key are summed."""
    # one number a bucket, whatever the corpus
    table = np.zeros(BUCKETS)
    for bucket, weight in weights.select("bucket", "weight").collect():
        table[bucket] = weight
    held = rows.select(F.col(key).alias("key"), words(F.col(text)).alias("words")).where(F.size("words") > 0)
    kind = held.schema["key"].dataType.simpleString()
    found = held.mapInArrow(_summed(table, dimension), f"key {kind}, embedding array<double>")
    parts = found.groupBy("key").agg(F.collect_list("embedding").alias("parts"))
    none = F.array_repeat(F.lit(0.0), dimension)
    total = F.aggregate("parts", none, lambda a, b: F.zip_with(a, b, lambda x, y: x + y))
    # a key has one text as a rule
    embedding = F.when(F.size("parts") == 1, F.get("parts", F.lit(0))).otherwise(total)
    return parts.select(F.col("key").alias(key), embedding.alias("embedding"))


@dataclass(frozen=True)
class TermEmbedder:
    """Fills ``embedding`` from a text column; fit for the searches' ``embed=``."""

    weights: DataFrame
    dimension: int = DIMENSION

    @classmethod
    def fit(cls, texts: DataFrame, text: str = "text", dimension: int = DIMENSION) -> TermEmbedder:
        return cls(bucket_weights(texts, text), dimension)

    def __call__(self, rows: DataFrame, key: str = "query_id", text: str = "query") -> DataFrame:
        """The rows with their vectors, NULL for texts without a word."""
        vectors = term_vectors(rows, self.weights, key, text, self.dimension)
        return rows.drop("embedding").join(vectors, key, "left")
