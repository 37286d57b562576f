"""Table schemas and bringing any frame to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.functions import text as tx

TEXT, TEXTS, VECTOR = T.StringType(), T.ArrayType(T.StringType()), T.ArrayType(T.FloatType())

ELEMENTS = (
    T.StructType()
    .add("id", TEXT, False)
    .add("uri", TEXT)
    .add("text", TEXT)
    .add("urtext", TEXT)
    .add("clean_text", TEXT)
    .add("tokens", TEXTS)
    .add("embedding", VECTOR)
    .add("parent_id", TEXT)
    .add("labels", TEXTS)
    .add("metadata", TEXT)
    .add("ingestion_timestamp", T.TimestampNTZType())
    .add("raw_content", T.BinaryType())
    .add("content_type", TEXT)
)
ENTITIES = (
    T.StructType()
    .add("id", TEXT, False)
    .add("name", TEXT, False)
    .add("description", TEXT)
    .add("uri", TEXT)
    .add("labels", TEXTS)
    .add("properties", TEXT)
    .add("metadata", TEXT)
    .add("context_id", TEXT)
    .add("embedding", VECTOR)
)
RELATIONSHIPS = (
    T.StructType()
    .add("source_id", TEXT, False)
    .add("target_id", TEXT, False)
    .add("relationship_name", TEXT, False)
    .add("properties", TEXT)
)
POSTINGS = (
    T.StructType()
    .add("id", TEXT, False)
    .add("lexeme", TEXT, False)
    .add("positions", T.ArrayType(T.IntegerType()))
)
DERIVED = ("clean_text", "tokens")


def conform(df: DataFrame, schema: T.StructType = ELEMENTS) -> DataFrame:
    """Every schema column in order, cast; a missing one is NULL.

    Columns outside the schema are dropped, except a store's ``bucket``.
    """
    have = set(df.columns)
    kept = [
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    return df.select(*kept, *[c for c in ("bucket",) if c in have])


def conform_entities(df: DataFrame) -> DataFrame:
    """Entity rows with the defaults of the table: '' and empty collections."""
    rows = conform(df, ENTITIES)
    return rows.withColumns(
        {
            "description": F.coalesce("description", F.lit("")),
            "labels": F.coalesce("labels", F.array().cast("array<string>")),
            "properties": F.coalesce("properties", F.lit("{}")),
            "metadata": F.coalesce("metadata", F.lit("{}")),
        }
    )


def with_derived(elements: DataFrame) -> DataFrame:
    """Fill the derived text columns; the same code serves batch and stream."""
    cleaned = elements.withColumn("clean_text", tx.clean_text(F.col("text")))
    return cleaned.withColumn("tokens", tx.tokens(F.col("clean_text")))


def check_dimension(df: DataFrame, dimension: int) -> DataFrame:
    """Fail the job on an embedding of another length."""
    if dimension < 1:
        raise ValueError("the embedding dimension must be positive")
    message = F.format_string(f"embedding of %s numbers, expected {dimension}", F.size("embedding"))
    wrong = F.col("embedding").isNotNull() & (F.size("embedding") != dimension)
    return df.withColumn(
        "embedding", F.when(wrong, F.raise_error(message).cast("array<float>")).otherwise(F.col("embedding"))
    )
