"""Search and navigation over named entities and their relationships."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.functions.filters import Filter, combine
from trawl.functions.properties import typed_value
from trawl.operators.vector_search import Embedder, embedded, nearest
from trawl.plans.sizing import join_checked, shuffled
from trawl.plans.topk import bounded_rows, cut, top_k, with_payload

ENTITY_PAYLOAD = ("name", "description", "uri", "labels", "properties", "metadata", "context_id")
DIRECTIONS = ("OUTGOING", "INCOMING", "BOTH")


def find_entities(ids: DataFrame, entities: DataFrame) -> DataFrame:
    return join_checked(entities, ids.select("id").distinct(), "id")


def find_by_label(entities: DataFrame, label: str) -> DataFrame:
    return entities.where(F.array_contains("labels", label))


def in_scope(context: str) -> Column:
    """Entities whose metadata names this context, as text."""
    value = typed_value(F.col("metadata"), "context_id")
    return (F.schema_of_variant(value) == "STRING") & (F.try_variant_get(value, "$", "string") == F.lit(context))


def scoped(entities: DataFrame, context: str | None) -> DataFrame:
    return entities if context is None else entities.where(in_scope(context))


def _finish(ranked: DataFrame, entities: DataFrame, rows: int, context: str | None, post_filter: bool) -> DataFrame:
    found = with_payload(ranked, entities, rows, ENTITY_PAYLOAD)
    return scoped(found, context) if post_filter else found


def entity_vector_search(
    queries: DataFrame,
    entities: DataFrame,
    k: int = 10,
    threshold: float = 0.0,
    *,
    metadata_filter: Filter | None = None,
    entity_filter: Filter | None = None,
    context: str | None = None,
    post_filter: bool = False,
    embed: Embedder | None = None,
) -> DataFrame:
    """Entities nearest to each query.

    A ``context`` narrows ahead of the top-k, so a scope gets its full ``k``;
    ``post_filter`` narrows the finished top-k instead.  ``embed`` (DataFrame
    -> DataFrame) fills the queries' vectors from their texts.
    """
    queries = embedded(queries, embed)
    corpus = entities.where(combine(metadata_filter, entity_filter))
    if not post_filter:
        corpus = scoped(corpus, context)
    ranked = cut(nearest(queries, corpus, k), threshold)
    return _finish(ranked, entities, bounded_rows(queries, k), context, post_filter)


def _grams(text: Column, size: int) -> Column:
    last = F.length(text) - (size - 1)
    return F.when(
        last >= 1, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substring(text, i, F.lit(size)))
    ).otherwise(F.array().cast("array<string>"))


def entity_text_matches(queries: DataFrame, entities: DataFrame) -> DataFrame:
    """(query_id, id): entities whose name or description contains the query.

    A contained text brings its own leading gram along, so queries meet
    entities by an equal gram of at most three letters and ``contains`` then
    decides; no pair without a common gram is formed.
    """
    asked = queries.select(
        F.col("query_id").cast("string").alias("query_id"), F.lower("query").alias("wanted")
    ).withColumn("gram", F.left("wanted", F.lit(3)))
    sizes = [r[0] for r in asked.select(F.length("gram")).distinct().collect()]
    name, description = F.lower("name"), F.lower(F.coalesce("description", F.lit("")))
    parts = [_grams(t, n) for n in sorted(sizes) if n for t in (name, description)]
    if 0 in sizes:
        parts.append(F.array(F.lit("")))
    if not parts:
        parts = [F.array().cast("array<string>")]
    offered = entities.select(
        "id", name.alias("in_name"), description.alias("in_description"),
        F.explode(F.array_distinct(F.concat(*parts))).alias("gram"),
    )
    met = join_checked(offered, asked, "gram", spread="id")
    return met.where(
        F.col("in_name").contains(F.col("wanted")) | F.col("in_description").contains(F.col("wanted"))
    ).select("query_id", "id")


def entity_text_search(
    queries: DataFrame,
    entities: DataFrame,
    k: int = 10,
    *,
    metadata_filter: Filter | None = None,
    entity_filter: Filter | None = None,
    context: str | None = None,
    post_filter: bool = False,
) -> DataFrame:
    """Entities that contain the query, score 1, the first ``k`` by id."""
    corpus = entities.where(combine(metadata_filter, entity_filter))
    if not post_filter:
        corpus = scoped(corpus, context)
    matches = entity_text_matches(queries, corpus).withColumn("score", F.lit(1.0))
    return _finish(top_k(matches, k), entities, bounded_rows(queries, k), context, post_filter)


def related_ids(sources: DataFrame, relationships: DataFrame, name: str, direction: str = "OUTGOING") -> DataFrame:
    """(source, id) pairs one hop away along relationships of one name."""
    if direction not in DIRECTIONS:
        raise ValueError(f"direction is one of {DIRECTIONS}")
    links = relationships.where(F.col("relationship_name") == name)
    asked = sources.select(F.col("id").alias("source")).distinct()

    def leg(near: str, far: str, *, loops: bool = True) -> DataFrame:
        rows = links if loops else links.where("source_id <> target_id")
        return join_checked(
            rows.select(F.col(near).alias("source"), F.col(far).alias("id")), asked, "source", spread="id"
        )

    if direction == "OUTGOING":
        return leg("source_id", "target_id")
    if direction == "INCOMING":
        return leg("target_id", "source_id")
    # a self-loop is met once, through the outgoing leg
    return leg("source_id", "target_id").unionByName(leg("target_id", "source_id", loops=False))


def find_related(
    sources: DataFrame,
    relationships: DataFrame,
    entities: DataFrame,
    name: str,
    direction: str = "OUTGOING",
) -> DataFrame:
    """Entities one hop from each source.  Both sides are shuffled; adaptive
    execution splits an entity many links point to."""
    return shuffled(related_ids(sources, relationships, name, direction)).join(entities, "id")
