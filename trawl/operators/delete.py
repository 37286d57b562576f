"""Tree and entity deletes over whole tables of requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.plans.lineage import materialize
from trawl.plans.sizing import join_checked


def roots_by_uri(uris: DataFrame, elements: DataFrame) -> DataFrame:
    """(root_uri, id) of every Document with one of the uris."""
    documents = elements.where(F.array_contains("labels", "Document")).select(
        F.col("uri").alias("root_uri"), "id"
    )
    asked = uris.select(F.col("uri").alias("root_uri")).distinct()
    return join_checked(documents, asked, "root_uri", spread="id")


def descendants(roots: DataFrame, elements: DataFrame) -> DataFrame:
    """(root_uri, id) of each root and everything below it.

    Parent links are doubled each round: after ``n`` rounds a link leads
    ``2 ** n`` levels up, and every element within that distance of a root is
    found, so rounds grow with the logarithm of the depth.  Links that lead
    beyond the top go.  In a circle none does; there the loop ends when a link
    is longer than there are elements.  Rounds are written out, which ends the
    lineage of the loop.
    """
    found = materialize(roots.select("root_uri", "id").distinct())
    links = materialize(
        elements.where("parent_id IS NOT NULL AND id IS NOT NULL").select("id", F.col("parent_id").alias("up")).distinct()
    )
    left = most = links.count()
    length = 1
    while left and length <= most:
        below = join_checked(links, found.withColumnRenamed("id", "up"), "up", spread="id").select("root_uri", "id")
        found = materialize(found.unionByName(below).distinct())
        # one parent may have much of the table as children; there the join's larger side is split
        further = links.select(F.col("id").alias("up"), F.col("up").alias("top"))
        links = materialize(links.join(further, "up").select("id", F.col("top").alias("up")).distinct())
        left = links.count()
        length *= 2
    return found


def delete_trees(uris: DataFrame, elements: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept elements, (root_uri, deleted)) for a table of root uris.

    Only Documents are roots here; a uri without one has no row in the counts.
    Several roots under one uri go together.
    """
    doomed = descendants(roots_by_uri(uris, elements), elements)
    kept = elements.join(doomed.select("id").distinct(), "id", "left_anti")
    return kept, doomed.groupBy("root_uri").agg(F.countDistinct("id").alias("deleted"))


def delete_entities(
    ids: DataFrame, entities: DataFrame, relationships: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(kept entities, kept relationships, (id, deleted)) for a table of ids.

    Relationships at either end of a deleted entity go with it.
    """
    asked = ids.select("id").distinct()
    gone = asked.join(entities.select("id"), "id", "left_semi")
    kept = entities.join(asked, "id", "left_anti")
    links = relationships.join(gone.withColumnRenamed("id", "source_id"), "source_id", "left_anti").join(
        gone.withColumnRenamed("id", "target_id"), "target_id", "left_anti"
    )
    told = asked.join(gone.withColumn("deleted", F.lit(True)), "id", "left").withColumn(
        "deleted", F.coalesce("deleted", F.lit(False))
    )
    return kept, links.select(*relationships.columns), told
