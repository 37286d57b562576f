"""From raw documents to token ids in five stages.

1. language: texts without letters, or without one language that has two
   fifths of their letters, go.  The model learns from all labelled rows of the input.
2. near_duplicates: of each group of near copies the row with the smallest
   doc_id stays.  Fingerprints take four-word shingles and 64 bits; texts are
   linked at 4 differing bits or fewer, as in the operator's own query.
3. repeated_units: lines and sentences that stood earlier in the corpus are
   cut out; a text of which nothing is left goes.  n_chars follows the text.
4. decontamination: texts that overlap with a benchmark item go.
5. encoding: adds n_tokens, ids and round_trip.

All stages keep the columns of documents and work on everything that their
predecessor kept.  What each does with nulls, empty texts, repeated rows and
empty tables is stated in its operator's module.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from trawl.llm import decontam, langid, pieces, simhash, units
from trawl.plans.lineage import checkpoint_folder

MIN_SHARE = 0.4
SHINGLE_WORDS = 4
DIFFERING_BITS = 4


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.in_one_language(docs, langid.fit(docs), min_share=MIN_SHARE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs, words=SHINGLE_WORDS, bits=DIFFERING_BITS)


def repeated_units(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return units.without_repeats(docs, size_column="n_chars")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.without_overlaps(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.with_ids(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_units", repeated_units),
    ("decontamination", decontamination),
    ("encoding", encoding),
]
#: Merges and votes of the stages are beyond SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for place, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{place}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
