"""Registered scans, writes, deletes, lookups and counts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from trawl.functions.term_vectors import TermEmbedder
from trawl.operators import delete, lookup, upsert
from trawl.plans.lineage import checkpoint_folder
from trawl.plans.querybook import sql
from trawl.plans.querybook.registry import query
from trawl.sources import corpus as c
from trawl.sources.schemas import conform, with_derived
from trawl.sources.store import ContentStore
from trawl.streaming.upkeep import upkeep

ROOT_URI = "'corpus://' || source || '/' || doc_id"


def now():
    """A fixed time for new rows, so that results repeat."""
    return F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")


def labelled(spark, sf):
    """documents with their labels."""
    return c.read(spark, sf, "documents").join(c.read(spark, sf, "labels"), "doc_id")


def root_uri():
    return F.concat(F.lit("corpus://"), "source", F.lit("/"), "doc_id")


# --- scans -----------------------------------------------------------------


@query("scan_chunks", f"WITH {sql.CHUNKS} SELECT id, uri, text, parent_id, metadata, ingestion_timestamp FROM chunks")
def scan_chunks(spark, sf):
    rows = lookup.all_chunks(c.elements(spark, sf, embeddings=False))
    return rows.select("id", "uri", "text", "parent_id", "metadata", "ingestion_timestamp")


@query("scan_elements", f"""
WITH {sql.ELEMENTS}
SELECT id, uri, text, urtext, parent_id, array_to_string(labels, ',') AS labels, metadata,
       ingestion_timestamp, content_type FROM elements
""")
def scan_elements(spark, sf):
    return c.elements(spark, sf, embeddings=False).select(
        "id", "uri", "text", "urtext", "parent_id", F.array_join("labels", ",").alias("labels"), "metadata",
        "ingestion_timestamp", "content_type",
    )


@query("conform_missing_columns", """
SELECT 'conv-' || conv_id || '-' || turn AS id, text, CAST(NULL AS VARCHAR) AS uri, CAST(NULL AS VARCHAR) AS metadata,
       true AS no_vector FROM conversations
""")
def conform_missing(spark, sf):
    rows = c.read(spark, sf, "conversations").select(
        F.concat(F.lit("conv-"), "conv_id", F.lit("-"), "turn").alias("id"), "text", "role"
    )
    return conform(rows).select("id", "text", "uri", "metadata", F.col("embedding").isNull().alias("no_vector"))


# --- writes ----------------------------------------------------------------


def conversation_chunks(spark, sf):
    """One chunk per conversation; its last turn wins."""
    return c.read(spark, sf, "conversations").select(
        F.concat(F.lit("conv-"), "conv_id").alias("id"),
        F.concat(F.lit("conv://"), "conv_id").alias("uri"),
        "text",
        F.col("text").alias("urtext"),
        F.array(F.lit("Chunk")).alias("labels"),
        F.to_json(F.struct("role")).alias("metadata"),
        "turn",
    )


def toxic_chunks(spark, sf):
    """New text for the first line of toxic documents."""
    return labelled(spark, sf).where("toxic = 1").select(
        F.concat(F.lit("doc-"), "doc_id", F.lit("-0")).alias("id"),
        F.lit("withheld").alias("text"),
        F.lit("withheld").alias("urtext"),
        F.array(F.lit("Chunk")).alias("labels"),
        F.lit("{}").alias("metadata"),
        F.lit(0).cast("bigint").alias("turn"),
    )


def changes(spark, sf):
    return conversation_chunks(spark, sf).unionByName(toxic_chunks(spark, sf), allowMissingColumns=True)


CHANGES = """
changes AS (
  SELECT 'conv-' || conv_id AS id, 'conv://' || conv_id AS uri, arg_max(text, turn) AS text,
         CAST(json_object('role', arg_max(role, turn)) AS VARCHAR) AS metadata
  FROM conversations GROUP BY conv_id
  UNION ALL
  SELECT 'doc-' || doc_id || '-0', NULL, 'withheld', '{}'
  FROM documents JOIN labels USING (doc_id) WHERE toxic = 1
)"""


def shown(rows):
    return rows.select(
        "id", "uri", "text", "metadata", F.col("embedding").isNotNull().alias("has_vector"),
        "clean_text", "ingestion_timestamp",
    )


CLEAN = "regexp_replace(lower(coalesce(text, '')), '[^a-z0-9\\s]', '', 'g')"


def upsert_sql(vector: str) -> str:
    return f"""
WITH {sql.CHUNKS}, {CHANGES},
after AS (
  SELECT coalesce(n.id, c.id) AS id, CASE WHEN n.id IS NULL THEN c.uri ELSE n.uri END AS uri,
         CASE WHEN n.id IS NULL THEN c.text ELSE n.text END AS text,
         CASE WHEN n.id IS NULL THEN c.metadata ELSE n.metadata END AS metadata,
         {vector} AS has_vector,
         CASE WHEN c.id IS NULL THEN TIMESTAMP '2025-01-01' ELSE c.ingestion_timestamp END AS ingestion_timestamp
  FROM chunks c FULL OUTER JOIN changes n ON n.id = c.id
)
SELECT *, {CLEAN} AS clean_text FROM after
"""


@query("save_elements", upsert_sql("c.embedding IS NOT NULL"))
def save_elements(spark, sf):
    """Embeddings and time stamps of known elements stay."""
    return shown(upsert.save_elements(c.chunks(spark, sf), changes(spark, sf), order="turn", now=now()))


@query("save_chunks_without_vector", upsert_sql("n.id IS NULL AND c.embedding IS NOT NULL"))
def save_chunks_without(spark, sf):
    """The vector of an updated chunk becomes NULL."""
    return shown(upsert.save_chunks(c.chunks(spark, sf), changes(spark, sf), order="turn", now=now()))


@query("persist_chunks", upsert_sql("""CASE WHEN n.id IS NULL THEN c.embedding IS NOT NULL
  ELSE n.id IN (SELECT 'conv-' || vec_id FROM embeddings) END"""))
def persist(spark, sf):
    """Chunks with the vectors given for them; the rest get none."""
    vectors = c.read(spark, sf, "embeddings").select(F.concat(F.lit("conv-"), "vec_id").alias("id"), "embedding")
    after = upsert.persist_chunks(c.chunks(spark, sf), changes(spark, sf), vectors, order="turn", now=now())
    return shown(after)


@query("save_documents", f"""
WITH {sql.ELEMENTS}
SELECT e.id, e.uri, e.metadata, md5(p.html) AS digest, octet_length(CAST(encode(p.html) AS BLOB)) AS n_bytes,
       CASE WHEN p.page_id IS NULL THEN e.content_type ELSE 'text/html' END AS content_type,
       e.urtext AS urtext
FROM (SELECT * FROM document_roots UNION ALL BY NAME
      SELECT * REPLACE (TIMESTAMP '2025-01-01' AS ingestion_timestamp) FROM page_roots) e
LEFT JOIN pages p ON e.id = 'page-' || p.page_id
""")
def save_documents(spark, sf):
    """Pages stored with their bytes next to the documents."""
    after = upsert.save_documents(c.document_roots(spark, sf), c.page_roots(spark, sf), now=now())
    return after.select(
        "id", "uri", "metadata", F.md5("raw_content").alias("digest"),
        F.octet_length("raw_content").cast("bigint").alias("n_bytes"), "content_type", "urtext",
    )


@query("chunk_transformer", f"""
WITH {sql.CHUNKS} SELECT id, lower(trim(text, ' ')) AS text, text AS urtext FROM chunks
""")
def transformer(spark, sf):
    """A user's DataFrame -> DataFrame step on chunks ahead of the upsert."""
    fresh = c.chunks(spark, sf)
    empty = fresh.limit(0)

    def tidy(rows):
        return rows.withColumn("text", F.lower(F.trim("text")))

    after = upsert.persist_chunks(empty, fresh, fresh.select("id", "embedding"), now=now(), transform=tidy)
    return after.select("id", "text", "urtext")


@query("embedder_hook", f"""
WITH {sql.CHUNKS}, {sql.term_vectors("chunks", "id", "text")}
SELECT id, CASE WHEN v.id IS NULL THEN NULL ELSE 64 END AS dimension, round(v.total, 4) AS total,
       round(v.embedding[1], 4) AS first
FROM chunks LEFT JOIN (
  SELECT id, embedding, list_sum([(i + 1) * embedding[i + 1] FOR i IN range(64)]) AS total FROM chunks_vectors
) v USING (id)
""")
def embedder(spark, sf):
    """An embedder fills the embedding column: hashed words, weighed by their rarity."""
    chunks = c.chunks(spark, sf, embeddings=False)
    rows = TermEmbedder.fit(chunks)(chunks, key="id", text="text")
    slots = F.col("embedding")
    total = F.aggregate(F.transform(slots, lambda x, i: x * (i + 1)), F.lit(0.0), lambda a, b: a + b)
    return rows.select(
        "id", F.when(slots.isNotNull(), F.size(slots)).alias("dimension"), F.round(total, 4).alias("total"),
        F.round(slots[0], 4).alias("first"),
    )


def _store(spark) -> ContentStore:
    folder = f"{checkpoint_folder(spark)}/store"
    return ContentStore(spark, f"{folder}-{uuid.uuid4().hex}", kind="simple", buckets=16)


STORED = f"""
WITH {sql.CHUNKS}, {CHANGES},
after AS (
  SELECT coalesce(n.id, c.id) AS id, CASE WHEN n.id IS NULL THEN c.text ELSE n.text END AS text
  FROM chunks c FULL OUTER JOIN changes n ON n.id = c.id
)
SELECT id, text, len(list_distinct(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+'))) AS lexemes FROM after
"""


def stored(store: ContentStore):
    held = store.postings.read().groupBy("id").agg(F.count("*").alias("lexemes"))
    return store.elements.read().join(held, "id", "left").select(
        "id", "text", F.coalesce("lexemes", F.lit(0)).cast("bigint").alias("lexemes")
    )


@query("bucketed_store", STORED)
def bucketed(spark, sf):
    """Upserts into the bucketed table, postings kept in step, read back."""
    store = _store(spark)
    store.save(c.chunks(spark, sf), upsert.save_chunks)
    store.save(changes(spark, sf), upsert.save_elements, order="turn")
    return stored(store)


@query("stream_upkeep", STORED)
def stream(spark, sf):
    """The same store kept in step by a stream of changes."""
    store = _store(spark)
    store.save(c.chunks(spark, sf), upsert.save_chunks)
    inbox = f"{store.elements.path}-inbox"
    changes(spark, sf).write.parquet(inbox)
    arriving = spark.readStream.schema(changes(spark, sf).schema).parquet(inbox)
    run = upkeep(arriving, store, f"{store.elements.path}-progress", order="turn").trigger(availableNow=True).start()
    run.awaitTermination()
    return stored(store)


@query("backfill_derived", f"""
WITH {sql.CHUNKS} SELECT count(*) AS analyzed FROM chunks WHERE regexp_matches(text, '[\\p{{L}}\\p{{N}}]')
""")
def backfill(spark, sf):
    """Elements written without postings are found and analyzed."""
    store = _store(spark)
    store.elements.append(with_derived(c.chunks(spark, sf)))
    return spark.range(1).select(F.lit(store.backfill()).cast("bigint").alias("analyzed"))


# --- deletes ---------------------------------------------------------------


def bad_uris(spark, sf):
    """Roots to remove: documents of low quality, and pages by their url."""
    low = labelled(spark, sf).where("quality = 0").select(root_uri().alias("uri"))
    return low.unionByName(c.read(spark, sf, "pages").select(F.col("url").alias("uri")))


TREES = f"""
WITH RECURSIVE {sql.ELEMENTS},
asked AS (
  SELECT {ROOT_URI} AS uri FROM documents JOIN labels USING (doc_id) WHERE quality = 0
  UNION SELECT url FROM pages
),
below AS (
  SELECT e.uri AS root_uri, e.id FROM elements e JOIN asked USING (uri) WHERE list_contains(e.labels, 'Document')
  UNION
  SELECT b.root_uri, e.id FROM elements e JOIN below b ON e.parent_id = b.id
)"""


@query("delete_trees_counts", f"{TREES} SELECT root_uri, count(DISTINCT id) AS deleted FROM below GROUP BY root_uri")
def tree_counts(spark, sf):
    return delete.delete_trees(bad_uris(spark, sf), c.elements(spark, sf, embeddings=False))[1]


@query("delete_trees", f"{TREES} SELECT id FROM elements WHERE id NOT IN (SELECT id FROM below)")
def trees(spark, sf):
    return delete.delete_trees(bad_uris(spark, sf), c.elements(spark, sf, embeddings=False))[0].select("id")


# --- lookups ---------------------------------------------------------------


def asked_ids(spark, sf):
    """Ids of labelled documents and of their first chunks, some not stored."""
    keys = c.read(spark, sf, "labels").select("doc_id")
    return keys.select(F.concat(F.lit("doc-"), "doc_id").alias("id")).unionByName(
        keys.select(F.concat(F.lit("doc-"), "doc_id", F.lit("-0")).alias("id"))
    )


ASKED = "(SELECT 'doc-' || doc_id FROM labels UNION ALL SELECT 'doc-' || doc_id || '-0' FROM labels)"


@query("find_by_id", f"WITH {sql.ELEMENTS} SELECT id, uri, text, parent_id, metadata FROM elements WHERE id IN {ASKED}")
def find_by_id(spark, sf):
    found = lookup.find_by_id(asked_ids(spark, sf), c.elements(spark, sf, embeddings=False))
    return found.select("id", "uri", "text", "parent_id", "metadata")


@query("find_chunks", f"WITH {sql.CHUNKS} SELECT id, text, urtext FROM chunks WHERE id IN {ASKED}")
def find_chunks(spark, sf):
    found = lookup.find_chunks(asked_ids(spark, sf), c.elements(spark, sf, embeddings=False))
    return found.select("id", "text", "urtext")


@query("find_all_roots", f"""
WITH {sql.ELEMENTS} SELECT id, uri, metadata, ingestion_timestamp FROM elements
WHERE list_contains(labels, 'Document') ORDER BY ingestion_timestamp DESC, id
""")
def find_all(spark, sf):
    found = lookup.find_all(c.elements(spark, sf, embeddings=False), "ContentRoot")
    return found.select("id", "uri", "metadata", "ingestion_timestamp")


def asked_uris(spark, sf):
    roots = c.read(spark, sf, "documents").select(root_uri().alias("uri"))
    others = c.read(spark, sf, "part").select(F.concat(F.lit("corpus://src1/"), "p_partkey").alias("uri"))
    return roots.unionByName(others)


ASKED_URIS = f"asked AS (SELECT {ROOT_URI} AS uri FROM documents UNION SELECT 'corpus://src1/' || p_partkey FROM part)"


@query("roots_exist", f"""
WITH {sql.ELEMENTS}, {ASKED_URIS}
SELECT uri, uri IN (SELECT uri FROM elements WHERE list_has_any(labels, ['Document', 'ContentRoot'])) AS found FROM asked
""")
def roots_exist(spark, sf):
    return lookup.roots_exist(asked_uris(spark, sf), c.elements(spark, sf, embeddings=False))


@query("find_roots_by_uri", f"""
WITH {sql.ELEMENTS}, {ASKED_URIS}
SELECT id, uri, json_extract_string(metadata, '$.title') AS title, 1704067200 AS ingested_at
FROM elements WHERE uri IN (SELECT uri FROM asked) AND list_has_any(labels, ['Document', 'ContentRoot'])
""")
def roots_by_uri(spark, sf):
    found = lookup.find_roots_by_uri(asked_uris(spark, sf), c.elements(spark, sf, embeddings=False))
    return found.select("id", "uri", "title", F.unix_seconds("ingested_at").cast("int").alias("ingested_at"))


@query("raw_content", "SELECT 'page-' || page_id AS id, url AS uri, md5(html) AS digest, 'text/html' AS content_type FROM pages")
def raw(spark, sf):
    ids = c.read(spark, sf, "pages").select(F.concat(F.lit("page-"), "page_id").alias("id"))
    found = lookup.raw_content(ids, c.elements(spark, sf, embeddings=False))
    return found.select("id", "uri", F.md5("raw_content").alias("digest"), "content_type")


@query("attributes_as_map", f"""
WITH {sql.ELEMENTS}
SELECT id, array_to_string(list_sort(json_keys(metadata)), ',') AS keys,
       coalesce(json_extract_string(metadata, '$.lang'), '') AS lang FROM elements
""")
def attributes(spark, sf):
    rows = lookup.as_read(c.elements(spark, sf, embeddings=False))
    return rows.select(
        "id", F.array_join(F.array_sort(F.map_keys("metadata")), ",").alias("keys"),
        F.coalesce(F.try_element_at("metadata", F.lit("lang")), F.lit("")).alias("lang"),
    )


@query("labels_on_read", """
SELECT 'event-' || event_id AS id, 'Chunk,' || event_type || ',ContentElement' AS labels, 'Chunk' AS kind,
       '' AS text, '' AS parent_id FROM events
""")
def labels_on_read(spark, sf):
    rows = lookup.as_read(c.event_elements(spark, sf))
    return rows.select("id", F.array_join("labels", ",").alias("labels"), "kind", "text", "parent_id")


@query("label_membership", f"WITH {sql.ELEMENTS} SELECT id FROM elements WHERE list_contains(labels, 'Chunk')")
def membership(spark, sf):
    return c.elements(spark, sf, embeddings=False).where(lookup.has_label("Chunk")).select("id")


@query("store_statistics", f"""
WITH {sql.ELEMENTS}
SELECT count(*) FILTER (WHERE list_contains(labels, 'Document')) AS document_count,
       count(*) FILTER (WHERE list_contains(labels, 'Chunk')) AS chunk_count,
       count(*) AS content_element_count, true AS has_embeddings, true AS is_persistent FROM elements
""")
def statistics(spark, sf):
    return lookup.statistics(c.elements(spark, sf))
