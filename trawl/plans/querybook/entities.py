"""Registered entity searches, navigation and writes."""

from __future__ import annotations

from pyspark.sql import functions as F

from trawl.functions.filters import Eq, HasAnyLabel
from trawl.operators import delete, entities as e, upsert
from trawl.plans.querybook import sql
from trawl.plans.querybook.registry import query
from trawl.sources import corpus as c
from trawl.sources.schemas import ENTITIES, conform

ENTITY_SQL = """
places AS (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey),
entities AS (
  SELECT 'nation-' || n_nationkey AS id, n_name AS name, 'Nation in ' || r_name AS description,
         ['Nation', 'Place'] AS labels, '{}' AS properties, CAST(json_object('context_id', r_name) AS VARCHAR) AS metadata,
         r_name AS context_id, CAST(NULL AS FLOAT[]) AS embedding FROM places
  UNION ALL
  SELECT 'customer-' || c_custkey, c_name, 'Customer from ' || n_name, ['Customer', 'Party'],
         CAST(json_object('acctbal', c_acctbal) AS VARCHAR), CAST(json_object('context_id', r_name) AS VARCHAR),
         r_name, v.embedding
  FROM customer JOIN places ON c_nationkey = n_nationkey LEFT JOIN embeddings v ON v.vec_id = c_custkey
  UNION ALL
  SELECT 'supplier-' || s_suppkey, s_name, 'Supplier from ' || n_name, ['Supplier', 'Party'],
         CAST(json_object('acctbal', s_acctbal) AS VARCHAR), CAST(json_object('context_id', r_name) AS VARCHAR),
         r_name, v.embedding
  FROM supplier JOIN places ON s_nationkey = n_nationkey LEFT JOIN embeddings v ON v.vec_id = s_suppkey
)"""

LINKS = """
located AS (
  SELECT 'customer-' || c_custkey AS source_id, 'nation-' || c_nationkey AS target_id, 'LOCATED_IN' AS relationship_name FROM customer
  UNION ALL
  SELECT 'supplier-' || s_suppkey, 'nation-' || s_nationkey, 'LOCATED_IN' FROM supplier
)"""

PURCHASES = """
purchases AS (
  SELECT 'customer-' || o_custkey AS source_id, 'supplier-' || l_suppkey AS target_id,
         'BOUGHT_FROM' AS relationship_name, count(*) AS lines
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_suppkey
)"""


def shown(rows):
    return rows.select("id", "name", "description", F.array_join("labels", ",").alias("labels"), "metadata", "context_id")


SHOWN = "id, name, description, array_to_string(labels, ',') AS labels, metadata, context_id"


@query("scan_entities", f"WITH {ENTITY_SQL} SELECT {SHOWN} FROM entities")
def scan(spark, sf):
    return shown(c.entities(spark, sf))


@query("scan_relationships", f"WITH {LINKS} SELECT * FROM located")
def scan_links(spark, sf):
    return c.relationships(spark, sf).select("source_id", "target_id", "relationship_name")


@query("find_entities", f"""
WITH {ENTITY_SQL} SELECT {SHOWN} FROM entities WHERE id IN (SELECT 'customer-' || o_custkey FROM orders)
""")
def find(spark, sf):
    ids = c.read(spark, sf, "orders").select(F.concat(F.lit("customer-"), "o_custkey").alias("id"))
    return shown(e.find_entities(ids, c.entities(spark, sf)))


@query("find_entities_by_label", f"WITH {ENTITY_SQL} SELECT {SHOWN} FROM entities WHERE list_contains(labels, 'Party')")
def by_label(spark, sf):
    return shown(e.find_by_label(c.entities(spark, sf), "Party"))


@query("find_entities_in_scope", f"""
WITH {ENTITY_SQL} SELECT {SHOWN} FROM entities WHERE list_contains(labels, 'Party') AND context_id = 'ASIA'
""")
def in_scope(spark, sf):
    return shown(e.scoped(e.find_by_label(c.entities(spark, sf), "Party"), "ASIA"))


def vector_sql(before: str, after: str = "true") -> str:
    return f"""
WITH {sql.ITEM_QUERIES}, {ENTITY_SQL},
scored AS (
  SELECT q.query_id, e.id, list_cosine_similarity(q.embedding::DOUBLE[], e.embedding::DOUBLE[]) AS score
  FROM item_queries q, entities e WHERE e.embedding IS NOT NULL AND {before}
), {sql.top_k("scored", "score")}
SELECT query_id, rank, id, rounded AS score, name FROM ranked JOIN entities USING (id)
WHERE score >= 0.1 AND {after}
"""


@query("entity_vector_search", vector_sql("list_has_any(e.labels, ['Customer'])"))
def vectors(spark, sf):
    found = e.entity_vector_search(
        c.benchmark_queries(spark, sf), c.entities(spark, sf), 10, 0.1, entity_filter=HasAnyLabel(["Customer"])
    )
    return found.select("query_id", "rank", "id", F.round("score", 6).alias("score"), "name")


@query("entity_vector_search_scoped", vector_sql("e.context_id = 'EUROPE'"))
def vectors_scoped(spark, sf):
    found = e.entity_vector_search(c.benchmark_queries(spark, sf), c.entities(spark, sf), 10, 0.1, context="EUROPE")
    return found.select("query_id", "rank", "id", F.round("score", 6).alias("score"), "name")


@query("entity_vector_search_post_filtered", vector_sql("true", "context_id = 'EUROPE'"))
def vectors_post(spark, sf):
    found = e.entity_vector_search(
        c.benchmark_queries(spark, sf), c.entities(spark, sf), 10, 0.1, context="EUROPE", post_filter=True
    )
    return found.select("query_id", "rank", "id", F.round("score", 6).alias("score"), "name")


def text_sql(before: str, after: str = "true") -> str:
    return f"""
WITH {ENTITY_SQL}, {sql.NAMES},
found AS (
  SELECT query_id, id, CAST(1.0 AS DOUBLE) AS score,
         row_number() OVER (PARTITION BY query_id ORDER BY id) AS rank
  FROM name_queries JOIN entities ON contains(lower(name), lower(query)) OR contains(lower(description), lower(query))
  WHERE {before} QUALIFY rank <= 10
)
SELECT query_id, rank, id, score, name FROM found JOIN entities USING (id) WHERE {after}
"""


@query("entity_text_search", text_sql("true"))
def text(spark, sf):
    found = e.entity_text_search(c.name_queries(spark, sf), c.entities(spark, sf), 10)
    return found.select("query_id", "rank", "id", F.round("score", 6).alias("score"), "name")


@query("entity_text_search_filtered", text_sql("list_has_any(labels, ['Supplier', 'Nation']) AND context_id = 'AFRICA'"))
def text_filtered(spark, sf):
    found = e.entity_text_search(
        c.name_queries(spark, sf), c.entities(spark, sf), 10,
        metadata_filter=Eq("context_id", "AFRICA"), entity_filter=HasAnyLabel(["Supplier", "Nation"]),
    )
    return found.select("query_id", "rank", "id", F.round("score", 6).alias("score"), "name")


@query("entity_text_search_post_filtered", text_sql("true", "context_id = 'AFRICA'"))
def text_post(spark, sf):
    found = e.entity_text_search(c.name_queries(spark, sf), c.entities(spark, sf), 10, context="AFRICA", post_filter=True)
    return found.select("query_id", "rank", "id", F.round("score", 6).alias("score"), "name")


@query("related_outgoing", f"""
WITH {ENTITY_SQL}, {LINKS}
SELECT source_id AS source, id, name FROM located JOIN entities ON id = target_id
""")
def outgoing(spark, sf):
    found = e.find_related(
        c.relationships(spark, sf).select(F.col("source_id").alias("id")),
        c.relationships(spark, sf), c.entities(spark, sf), "LOCATED_IN",
    )
    return found.select("source", "id", "name")


@query("related_incoming", f"""
WITH {ENTITY_SQL}, {LINKS}
SELECT target_id AS source, id, name FROM located JOIN entities ON id = source_id
""")
def incoming(spark, sf):
    nations = c.read(spark, sf, "nation").select(F.concat(F.lit("nation-"), "n_nationkey").alias("id"))
    found = e.find_related(nations, c.relationships(spark, sf), c.entities(spark, sf), "LOCATED_IN", "INCOMING")
    return found.select("source", "id", "name")


@query("related_both", f"""
WITH {ENTITY_SQL}, {PURCHASES}, asked AS (SELECT 'supplier-' || s_suppkey AS source FROM supplier)
SELECT source, id, name FROM purchases JOIN asked ON source_id = source JOIN entities ON id = target_id
UNION ALL
SELECT source, id, name FROM purchases JOIN asked ON target_id = source JOIN entities ON id = source_id
WHERE source_id <> target_id
""")
def both(spark, sf):
    suppliers = c.read(spark, sf, "supplier").select(F.concat(F.lit("supplier-"), "s_suppkey").alias("id"))
    found = e.find_related(suppliers, c.purchases(spark, sf), c.entities(spark, sf), "BOUGHT_FROM", "BOTH")
    return found.select("source", "id", "name")


@query("save_entities", f"""
WITH {ENTITY_SQL}
SELECT coalesce('part-' || p_partkey, id) AS id, coalesce(p_name, name) AS name,
       CASE WHEN p_partkey IS NULL THEN description ELSE '' END AS description,
       CASE WHEN p_partkey IS NULL THEN context_id ELSE p_brand END AS context_id
FROM entities FULL OUTER JOIN part ON id = 'part-' || p_partkey
UNION ALL SELECT NULL, NULL, NULL, NULL WHERE false
""")
def save(spark, sf):
    """Parts added to the entities; the scope is read from their metadata."""
    parts = c.read(spark, sf, "part").select(
        F.concat(F.lit("part-"), "p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.array(F.lit("Part")).alias("labels"),
        F.to_json(F.struct(F.col("p_brand").alias("context_id"))).alias("metadata"),
    )
    after = upsert.save_entities(c.entities(spark, sf), conform(parts, ENTITIES))
    return after.select("id", "name", "description", "context_id")


@query("create_relationships_judged", f"""
WITH {LINKS}, {ENTITY_SQL},
added AS (
  SELECT 'customer-' || o_custkey AS source_id, 'nation-' || (o_custkey % 30) AS target_id, 'LOCATED_IN' AS relationship_name,
         o_orderkey
  FROM orders
)
SELECT source_id, target_id, o_orderkey,
       CASE WHEN source_id NOT IN (SELECT id FROM entities) OR target_id NOT IN (SELECT id FROM entities) THEN 'unknown endpoint'
            WHEN (source_id, target_id) IN (SELECT (source_id, target_id) FROM located) THEN 'stored already'
            WHEN count(*) OVER (PARTITION BY source_id, target_id) > 1 THEN 'repeated in batch' ELSE '' END AS reason
FROM added
""")
def create_links(spark, sf):
    """Each row of a plain insert with why it is refused, '' when it is not."""
    added = c.read(spark, sf, "orders").select(
        F.concat(F.lit("customer-"), "o_custkey").alias("source_id"),
        F.concat(F.lit("nation-"), F.col("o_custkey") % 30).alias("target_id"),
        F.lit("LOCATED_IN").alias("relationship_name"),
        "o_orderkey",
    )
    accepted, rejected = upsert.new_relationships(c.relationships(spark, sf), c.entities(spark, sf), added)
    return accepted.withColumn("reason", F.lit("")).unionByName(rejected).select(
        "source_id", "target_id", "o_orderkey", "reason"
    )


@query("merge_relationships", f"""
WITH {LINKS},
last AS (SELECT 'customer-' || o_custkey AS source_id, 'nation-' || c_nationkey AS target_id,
                CAST(json_object('order', max(o_orderkey)) AS VARCHAR) AS properties
         FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
SELECT source_id, target_id, relationship_name, coalesce(l.properties, '{{}}') AS properties
FROM located LEFT JOIN last l USING (source_id, target_id)
""")
def merge_links(spark, sf):
    """Known triples get new properties, the last of many wins."""
    customers = c.read(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    added = c.read(spark, sf, "orders").join(customers, "o_custkey").select(
        F.concat(F.lit("customer-"), "o_custkey").alias("source_id"),
        F.concat(F.lit("nation-"), "c_nationkey").alias("target_id"),
        F.lit("LOCATED_IN").alias("relationship_name"),
        F.to_json(F.struct(F.col("o_orderkey").alias("order"))).alias("properties"),
        "o_orderkey",
    )
    return upsert.merge_relationships(c.relationships(spark, sf), added, order="o_orderkey")


DOOMED = "(SELECT 'customer-' || o_custkey FROM orders WHERE o_orderstatus = 'F')"


def doomed(spark, sf):
    orders = c.read(spark, sf, "orders").where("o_orderstatus = 'F'")
    return orders.select(F.concat(F.lit("customer-"), "o_custkey").alias("id"))


@query("delete_entities", f"WITH {ENTITY_SQL} SELECT id FROM entities WHERE id NOT IN {DOOMED}")
def delete_some(spark, sf):
    return delete.delete_entities(doomed(spark, sf), c.entities(spark, sf), c.relationships(spark, sf))[0].select("id")


@query("delete_entities_relationships", f"""
WITH {PURCHASES} SELECT source_id, target_id FROM purchases
WHERE source_id NOT IN {DOOMED} AND target_id NOT IN {DOOMED}
""")
def delete_links(spark, sf):
    """Relationships at either end of a deleted entity go with it."""
    kept = delete.delete_entities(doomed(spark, sf), c.entities(spark, sf), c.purchases(spark, sf))[1]
    return kept.select("source_id", "target_id")
