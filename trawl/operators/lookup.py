"""Lookups, existence checks and counts over the element table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.functions.properties import as_map, text_value
from trawl.plans.sizing import join_checked

READ = ("id", "uri", "text", "urtext", "parent_id", "labels", "metadata", "ingestion_timestamp")
LABEL_OF_TYPE = {"Chunk": "Chunk", "ContentRoot": "Document", "ContentElement": "ContentElement"}


def has_label(label: str) -> Column:
    """Label membership; no labels at all is not a member."""
    return F.array_contains("labels", label)


def is_root() -> Column:
    return has_label("Document") | has_label("ContentRoot")


def supports_type(name: str) -> bool:
    """Only chunks can be searched."""
    return name == "Chunk"


def require_searchable(name: str) -> None:
    if not supports_type(name):
        raise ValueError(f"only Chunk can be searched, not {name}")


def all_chunks(elements: DataFrame) -> DataFrame:
    return elements.where(has_label("Chunk")).select(*READ)


def as_read(elements: DataFrame) -> DataFrame:
    """Rows as handed back: missing text forms filled, labels and attributes
    completed; ``kind`` tells a Chunk from any other element."""
    chunk = F.coalesce(has_label("Chunk"), F.lit(False))
    own = F.coalesce("labels", F.array().cast("array<string>"))
    return elements.select(
        "id",
        "uri",
        F.when(chunk, F.coalesce("text", F.lit(""))).alias("text"),
        F.when(chunk, F.coalesce("urtext", "text", F.lit(""))).alias("urtext"),
        F.when(chunk, F.coalesce("parent_id", F.lit(""))).otherwise(F.col("parent_id")).alias("parent_id"),
        F.array_union(own, F.array(F.lit("ContentElement"))).alias("labels"),
        as_map(F.col("metadata")).alias("metadata"),
        "ingestion_timestamp",
        F.when(chunk, "Chunk").otherwise("ContentElement").alias("kind"),
    )


def as_roots(elements: DataFrame) -> DataFrame:
    """Root rows: title and ingestion time out of the metadata.

    The time may be ISO text or epoch milliseconds; NULL when missing.
    """
    stamp = text_value(F.col("metadata"), "ingestionTimestamp")
    from_text = F.try_to_timestamp(stamp)
    from_millis = F.timestamp_millis(stamp.try_cast("bigint"))
    return elements.select(
        "id",
        F.coalesce("uri", F.lit("")).alias("uri"),
        F.coalesce(text_value(F.col("metadata"), "title"), F.lit("")).alias("title"),
        F.when(stamp.rlike(r"^-?\d+$"), from_millis).otherwise(from_text).alias("ingested_at"),
        as_map(F.col("metadata")).alias("metadata"),
    )


def find_by_id(ids: DataFrame, elements: DataFrame) -> DataFrame:
    return join_checked(elements.select(*READ), ids.select("id").distinct(), "id")


def find_chunks(ids: DataFrame, elements: DataFrame) -> DataFrame:
    """Chunks among the ids; no ids, no rows."""
    return find_by_id(ids, elements.where(has_label("Chunk")))


def find_all(elements: DataFrame, type_name: str = "Chunk") -> DataFrame:
    """All elements of a type, newest first."""
    label = LABEL_OF_TYPE.get(type_name, "ContentElement")
    return elements.where(has_label(label)).select(*READ).orderBy(F.desc("ingestion_timestamp"), "id")


def roots_exist(uris: DataFrame, elements: DataFrame) -> DataFrame:
    """(uri, found) for every uri asked."""
    roots = elements.where(is_root()).select("uri").distinct().withColumn("found", F.lit(True))
    return uris.select("uri").distinct().join(roots, "uri", "left").select(
        "uri", F.coalesce("found", F.lit(False)).alias("found")
    )


def find_roots_by_uri(uris: DataFrame, elements: DataFrame) -> DataFrame:
    found = join_checked(
        elements.where(is_root()).select(*READ), uris.select("uri").distinct(), "uri", spread="id"
    )
    return as_roots(found)


def raw_content(ids: DataFrame, elements: DataFrame) -> DataFrame:
    """Stored bytes of Documents."""
    rows = elements.where(has_label("Document")).select(
        "id", "uri", "raw_content", "content_type", "labels", "metadata"
    )
    return join_checked(rows, ids.select("id").distinct(), "id")


def statistics(elements: DataFrame) -> DataFrame:
    """Documents, chunks and all elements, in one pass."""
    return elements.agg(
        F.count_if(has_label("Document")).alias("document_count"),
        F.count_if(has_label("Chunk")).alias("chunk_count"),
        F.count("*").alias("content_element_count"),
    ).withColumns({"has_embeddings": F.lit("embedding" in elements.columns), "is_persistent": F.lit(True)})
