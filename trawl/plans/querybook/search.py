"""Registered searches over chunks."""

from __future__ import annotations

import uuid
from math import isqrt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.functions import text as tx
from trawl.functions.filters import Eq, HasAnyLabel, In
from trawl.functions.term_vectors import TermEmbedder
from trawl.functions.trigrams import similarity
from trawl.functions.vectors import cosine_similarity
from trawl.operators import lexicon
from trawl.operators.fuzzy_search import fuzzy_search, word_table
from trawl.operators.hybrid_search import hybrid_scores, hybrid_search
from trawl.operators.query_terms import query_terms
from trawl.operators.text_search import prefix_matches, text_matches, text_search
from trawl.operators.vector_search import (
    assign_cells,
    is_chunk,
    nearest,
    nearest_approximate,
    recall,
    train_cells,
    vector_search,
)
from trawl.operators.upsert import save_chunks
from trawl.plans.lineage import checkpoint_folder, materialize
from trawl.plans.querybook import sql
from trawl.plans.querybook.registry import query
from trawl.plans.topk import cut, top_k
from trawl.sources import corpus as c
from trawl.sources.store import ContentStore

def shown() -> list:
    """The columns of a ranking; scores are rounded here, after ranks and cuts."""
    return ["query_id", "rank", "id", F.round("score", 6).alias("score")]



def texts(spark: SparkSession, sf: str) -> DataFrame:
    return c.chunks(spark, sf, embeddings=False)


# --- text columns ----------------------------------------------------------


@query("clean_text", f"""
WITH {sql.CHUNKS}
SELECT id, regexp_replace(lower(coalesce(text, '')), '[^a-z0-9\\s]', '', 'g') AS clean_text FROM chunks
""")
def clean(spark, sf):
    return texts(spark, sf).select("id", tx.clean_text(F.col("text")).alias("clean_text"))


@query("tokens", f"""
WITH {sql.CHUNKS}
SELECT id, len(tokens) AS n_tokens, array_to_string(tokens, '|') AS tokens
FROM (SELECT id, string_split_regex(
        regexp_replace(lower(coalesce(text, '')), '[^a-z0-9\\s]', '', 'g'), '\\s+') AS tokens FROM chunks)
""")
def tokens(spark, sf):
    found = tx.tokens(tx.clean_text(F.col("text")))
    return texts(spark, sf).select(
        "id", F.size(found).cast("bigint").alias("n_tokens"), F.array_join(found, "|").alias("tokens")
    )


@query("lexemes_simple", f"""
WITH {sql.CHUNKS}, {sql.POSTINGS}
SELECT id, lexeme, count(*) AS hits, string_agg(pos, ',' ORDER BY pos) AS positions FROM post GROUP BY ALL
""")
def lexemes_simple(spark, sf):
    table = lexicon.postings(texts(spark, sf).select("id", "text"), "simple")
    return table.select(
        "id", "lexeme", F.size("positions").cast("bigint").alias("hits"),
        F.array_join(F.col("positions").cast("array<string>"), ",").alias("positions"),
    )


@query("lexemes_english", f"""
WITH {sql.CHUNKS}, {sql.english()}
SELECT id, lexeme, count(*) AS hits, string_agg(pos, ',' ORDER BY pos) AS positions FROM post GROUP BY ALL
""")
def lexemes_english(spark, sf):
    table = lexicon.postings(texts(spark, sf).select("id", "text"), "english")
    return table.select(
        "id", "lexeme", F.size("positions").cast("bigint").alias("hits"),
        F.array_join(F.col("positions").cast("array<string>"), ",").alias("positions"),
    )


PAGE_WORDS = f"""
page_words AS (
  SELECT 'page-' || page_id AS id, {sql.word_kinds("concat_ws(' ', url, html)")} AS ws FROM pages
)"""


def page_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Pages with their urls, decimals and hyphens as texts."""
    return c.read(spark, sf, "pages").select(
        F.concat(F.lit("page-"), "page_id").alias("id"), F.concat_ws(" ", "url", "html").alias("text")
    )


@query("lexemes_kinds", f"""
WITH {PAGE_WORDS},
post AS (SELECT id, unnest(ws) AS lexeme, unnest(range(1, len(ws) + 1)) AS pos FROM page_words)
SELECT id, lexeme, count(*) AS hits, string_agg(pos, ',' ORDER BY pos) AS positions FROM post GROUP BY ALL
""")
def lexemes_kinds(spark, sf):
    """Urls, addresses, decimals and hyphenated words whole, with their parts."""
    table = lexicon.postings(page_texts(spark, sf), "simple_kinds")
    return table.select(
        "id", "lexeme", F.size("positions").cast("bigint").alias("hits"),
        F.array_join(F.col("positions").cast("array<string>"), ",").alias("positions"),
    )


@query("text_matches_kinds", f"""
WITH {PAGE_WORDS},
asked AS (SELECT 'page-' || page_id AS query_id, {sql.word_kinds("url")} AS ws FROM pages)
SELECT query_id, id FROM asked, page_words p WHERE len(asked.ws) > 0 AND list_has_all(p.ws, asked.ws)
""")
def text_matches_kinds(spark, sf):
    """The pages that name another page's url whole."""
    asked = c.read(spark, sf, "pages").select(F.concat(F.lit("page-"), "page_id").alias("query_id"), F.col("url").alias("query"))
    found = text_matches(asked, page_texts(spark, sf), syntax="plain", kind="simple_kinds")
    return found.select("query_id", "id")


# --- vectors ---------------------------------------------------------------


@query("cosine_similarity", """
SELECT a.vec_id AS vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS score
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1
""")
def cosine(spark, sf):
    a = c.read(spark, sf, "embeddings")
    b = a.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next"))
    return a.join(b, "vec_id").select(
        "vec_id", F.round(cosine_similarity(F.col("embedding"), F.col("next")), 6).alias("score")
    )


def vector_sql(where: str, threshold: float) -> str:
    return f"""
WITH {sql.CHUNKS}, {sql.ITEM_QUERIES},
scored AS (
  SELECT q.query_id, c.id, list_cosine_similarity(q.embedding::DOUBLE[], c.embedding::DOUBLE[]) AS score
  FROM item_queries q, chunks c WHERE c.embedding IS NOT NULL AND {where}
), {sql.top_k("scored", "score")}
SELECT query_id, rank, id, rounded AS score FROM ranked WHERE score >= {threshold}
"""


@query("vector_search", vector_sql("true", 0.0))
def vectors(spark, sf):
    found = vector_search(c.benchmark_queries(spark, sf), c.chunks(spark, sf), 10, payload=False)
    return found.select(*shown())


@query("vector_search_ceiling", vector_sql("true", 0.5))
def vectors_ceiling(spark, sf):
    """A threshold of 0.9 is eased to the ceiling of 0.5, after the top-k."""
    found = vector_search(c.benchmark_queries(spark, sf), c.chunks(spark, sf), 10, 0.9, payload=False)
    return found.select(*shown())


@query(
    "vector_search_filtered",
    vector_sql("json_extract_string(c.metadata, '$.lang') IN ('en', 'de') AND list_has_any(c.labels, ['Chunk'])", 0.3),
)
def vectors_filtered(spark, sf):
    found = vector_search(
        c.benchmark_queries(spark, sf), c.chunks(spark, sf), 10, 0.3, ceiling=None,
        metadata_filter=In("lang", ["en", "de"]), entity_filter=HasAnyLabel(["Chunk"]), payload=False,
    )
    return found.select(*shown())


@query("vector_search_embed", f"""
WITH {sql.CHUNKS}, {sql.ITEM_QUERIES}, {sql.term_vectors("chunks", "id", "text")},
{sql.term_vectors("item_queries", "query_id", "query")},
scored AS (
  SELECT query_id, id, list_cosine_similarity(q.embedding::FLOAT[]::DOUBLE[], c.embedding::FLOAT[]::DOUBLE[]) AS score
  FROM item_queries_vectors q, chunks_vectors c
  WHERE list_max(c.embedding) > 0 OR list_min(c.embedding) < 0
), {sql.top_k("scored", "score")}
SELECT query_id, rank, rounded AS score FROM ranked WHERE score >= 0
""")
def vectors_embed(spark, sf):
    """Chunks nearest to query texts that an embedder turns into vectors."""
    chunks = texts(spark, sf)
    embedder = TermEmbedder.fit(chunks)
    asked = c.benchmark_queries(spark, sf).drop("embedding")
    held = embedder(chunks, key="id", text="text")
    found = vector_search(asked, held, 10, payload=False, embed=embedder)
    return found.select("query_id", "rank", F.round("score", 6).alias("score"))


def _approximate(spark, sf, probes=None):
    """Queries, corpus and what the approximate search finds; -1 probes all cells."""
    corpus = materialize(c.chunks(spark, sf).where("embedding IS NOT NULL").select("id", "embedding"))
    centres = train_cells(corpus, max(4, isqrt(corpus.count())))
    indexed = assign_cells(corpus, centres)
    asked = c.benchmark_queries(spark, sf)
    return asked, corpus, nearest_approximate(asked, indexed, centres, 10, probes=len(centres) if probes == -1 else probes)


@query("vector_search_approximate", vector_sql("true", -2.0))
def vectors_approximate(spark, sf):
    """Every cell visited: the same as the exact search."""
    return _approximate(spark, sf, -1)[2].select(*shown())


@query("vector_search_recall", "SELECT true AS enough")
def vectors_recall(spark, sf):
    """Mean recall at the default share of cells, held against 0.9."""
    asked, corpus, found = _approximate(spark, sf)
    share = recall(found, nearest(asked, corpus, 10)).agg(F.sum("found") / F.sum("wanted"))
    return share.toDF("share").select((F.col("share") >= 0.9).alias("enough"))


# --- text ------------------------------------------------------------------


@query("query_terms_plain", f"""
WITH {sql.SENTENCES}
SELECT query_id, lexeme, count(*) AS uses
FROM (SELECT query_id, unnest(regexp_extract_all(lower(query), '[\\p{{L}}\\p{{N}}]+')) AS lexeme FROM sentences)
GROUP BY query_id, lexeme
""")
def terms_plain(spark, sf):
    terms = query_terms(c.sentence_queries(spark, sf), "plain", "simple")
    return terms.groupBy("query_id", "lexeme").agg(F.count("*").alias("uses"))


@query("query_terms_web", f"""
WITH {sql.SENTENCES}, {sql.web_terms("sentences")}
SELECT query_id, count(DISTINCT clause) AS clauses, count(DISTINCT lexeme) AS lexemes
FROM terms GROUP BY query_id
""")
def terms_web(spark, sf):
    terms = query_terms(c.sentence_queries(spark, sf), "web", "simple")
    return terms.groupBy("query_id").agg(
        F.countDistinct("clause").alias("clauses"), F.countDistinct("lexeme").alias("lexemes")
    )


MATCHED = f"{sql.CHUNKS}, {sql.POSTINGS}, {sql.SENTENCES}"


@query("text_rank", f"""
WITH {MATCHED}, {sql.plain_terms("sentences")}, {sql.MATCHES}
SELECT query_id, id, round(raw_rank, 6) AS raw_rank FROM matches
""")
def ranks(spark, sf):
    found = text_matches(
        c.sentence_queries(spark, sf), texts(spark, sf).select("id", "text"), syntax="plain", kind="simple"
    )
    return found.select("query_id", "id", F.round("raw_rank", 6).alias("raw_rank"))


def text_sql(terms: str, threshold: float, matches: str = "matches") -> str:
    return f"""
WITH {MATCHED}, {terms}, {sql.MATCHES}, {sql.top_k(matches, "raw_rank")}
SELECT query_id, rank, id, round(least(1.0, 3.0 * raw_rank), 6) AS score
FROM ranked WHERE least(1.0, 3.0 * raw_rank) >= {threshold}
"""


@query("text_search", text_sql(sql.web_terms("sentences"), 0.1))
def text_web(spark, sf):
    found = text_search(c.sentence_queries(spark, sf), texts(spark, sf), 10, 0.1, kind="simple", payload=False)
    return found.select(*shown())


@query(
    "text_search_filtered",
    text_sql(
        sql.plain_terms("sentences"), 0.2,
        "(SELECT * FROM matches JOIN chunks USING (id) WHERE json_extract_string(metadata, '$.lang') = 'en')",
    ),
)
def text_filtered(spark, sf):
    found = text_search(
        c.sentence_queries(spark, sf), texts(spark, sf), 10, 0.2, ceiling=None, syntax="plain", kind="simple",
        metadata_filter=Eq("lang", "en"), payload=False,
    )
    return found.select(*shown())


def _indexed(spark, sf):
    """A store with all chunks, and in how many of them each lexeme stands."""
    store = ContentStore(spark, f"{checkpoint_folder(spark)}/store-{uuid.uuid4().hex}", kind="simple", buckets=16)
    store.save(c.chunks(spark, sf), save_chunks)
    return store, lexicon.document_frequencies(store.postings.read())


@query("text_search_indexed", text_sql(sql.web_terms("sentences"), 0.1))
def text_indexed(spark, sf):
    """From stored postings, drivers by frequency, texts joined to the ranking."""
    store, frequencies = _indexed(spark, sf)
    found = text_search(
        c.sentence_queries(spark, sf), store.elements.read(), 10, 0.1, kind="simple", index=store.postings.read(),
        frequencies=frequencies, index_covers_all=True, payload=False,
    )
    return store.elements.attach(found, ["text"]).where("text IS NOT NULL").select(*shown())


@query(
    "text_search_indexed_narrowed",
    text_sql(
        sql.web_terms("sentences"), 0.1,
        "(SELECT * FROM matches JOIN chunks USING (id) WHERE json_extract_string(metadata, '$.lang') = 'en')",
    ),
)
def text_indexed_narrowed(spark, sf):
    """Rows cut down by the caller: the index finds nothing outside of them."""
    store, _ = _indexed(spark, sf)
    some = store.elements.read().where("get_json_object(metadata, '$.lang') = 'en'")
    found = text_search(c.sentence_queries(spark, sf), some, 10, 0.1, kind="simple", index=store.postings.read())
    return found.select(*shown())


@query("text_search_english", f"""
WITH {sql.CHUNKS}, {sql.SENTENCES}, {sql.english("sentences")}, {sql.MATCHES}, {sql.top_k("matches", "raw_rank")}
SELECT query_id, rank, id, round(least(1.0, 3.0 * raw_rank), 6) AS score
FROM ranked WHERE least(1.0, 3.0 * raw_rank) >= 0.1
""")
def text_english(spark, sf):
    found = text_search(c.sentence_queries(spark, sf), texts(spark, sf), 10, 0.1, payload=False)
    return found.select(*shown())


@query("text_search_items", f"""
WITH {sql.CHUNKS}, {sql.POSTINGS}, {sql.ITEM_QUERIES}, {sql.plain_terms("item_queries")}, {sql.MATCHES},
{sql.top_k("matches", "raw_rank")}
SELECT query_id, rank, id, round(least(1.0, 3.0 * raw_rank), 6) AS score FROM ranked
""")
def text_items(spark, sf):
    """Whole benchmark items as queries: chunks that hold every word of one."""
    found = text_search(
        c.benchmark_queries(spark, sf), texts(spark, sf), 10, syntax="plain", kind="simple", payload=False
    )
    return found.select(*shown())


@query("prefix_match", f"""
WITH {sql.CHUNKS}, {sql.POSTINGS}, starts AS (SELECT DISTINCT lang AS query_id, lang AS start FROM documents)
SELECT query_id, id, count(DISTINCT lexeme) AS words
FROM starts JOIN post ON starts_with(lexeme, start) GROUP BY ALL
""")
def prefixes(spark, sf):
    """Chunks with a word that starts with a language code."""
    asked = c.read(spark, sf, "documents").select(F.col("lang").alias("query_id"), F.col("lang").alias("query"))
    return prefix_matches(asked.distinct(), texts(spark, sf).select("id", "text"))


# --- fuzzy -----------------------------------------------------------------


@query("trigram_similarity", """
WITH pairs AS (
  SELECT c_custkey, c_mktsegment AS a, n_name AS b FROM customer JOIN nation ON c_nationkey = n_nationkey
),
names AS (SELECT DISTINCT a AS name FROM pairs UNION SELECT DISTINCT b FROM pairs),
grams AS (
  SELECT name, list_distinct(flatten(list_transform(regexp_extract_all(lower(name), '[\\p{L}\\p{N}]+'),
    lambda w: list_transform(range(1, length(w) + 2), lambda i: substring('  ' || w || ' ', i, 3))))) AS g
  FROM names
)
SELECT c_custkey, round(len(list_intersect(x.g, y.g)) /
         (len(x.g) + len(y.g) - len(list_intersect(x.g, y.g))), 6) AS similarity
FROM pairs JOIN grams x ON x.name = a JOIN grams y ON y.name = b
""")
def trigrams(spark, sf):
    nation = c.read(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    pairs = c.read(spark, sf, "customer").join(nation, "c_nationkey")
    return pairs.select(
        "c_custkey", F.round(similarity(F.col("c_mktsegment"), F.col("n_name")).cast("double"), 6).alias("similarity")
    )


@query("fuzzy_search", f"""
WITH {sql.CHUNKS}, {sql.NAMES}, {sql.fuzzy_matches("name_queries")}, {sql.top_k("fuzzy_matches", "score")}
SELECT query_id, rank, id, rounded AS score FROM ranked
""")
def fuzzy(spark, sf):
    return fuzzy_search(c.name_queries(spark, sf), texts(spark, sf), 10, payload=False).select(*shown())


@query("fuzzy_search_word_table", f"""
WITH {sql.CHUNKS}, {sql.SENTENCES}, {sql.fuzzy_matches("sentences")}, {sql.top_k("fuzzy_matches", "score", 5)}
SELECT query_id, rank, id, rounded AS score FROM ranked
""")
def fuzzy_sentences(spark, sf):
    """Sentences, whose sets are far larger than a word's, against a word table made before."""
    chunks = materialize(texts(spark, sf).select("id", "text", "labels"))
    return fuzzy_search(c.sentence_queries(spark, sf), chunks, 5, words=word_table(chunks), payload=False).select(*shown())


# --- hybrid ----------------------------------------------------------------

SCORED = """
scored AS (
  SELECT m.query_id, m.id,
         0.7 * coalesce(list_cosine_similarity(c.embedding::DOUBLE[], q.embedding::DOUBLE[]), 0)
         + 0.3 * m.raw_rank / (1 + m.raw_rank) AS score
  FROM matches m JOIN chunks c USING (id) JOIN sentences q USING (query_id)
)"""
HYBRID = f"{MATCHED}, {sql.web_terms('sentences')}, {sql.MATCHES}, {SCORED}"
ENGLISH_HYBRID = f"{sql.CHUNKS}, {sql.SENTENCES}, {sql.english('sentences')}, {sql.MATCHES}, {SCORED}"


@query("hybrid_scores", f"""
WITH {HYBRID} SELECT query_id, id, round(score, 6) AS score FROM scored
""")
def hybrid_all(spark, sf):
    found = hybrid_scores(c.sentence_queries(spark, sf), c.chunks(spark, sf), kind="simple")
    return found.select("query_id", "id", F.round("score", 6).alias("score"))


def hybrid_sql(scored: str) -> str:
    """Hybrid answers, and fuzzy ones where those fall short."""
    return f"""
WITH {scored}, {sql.top_k("scored", "score")},
answered AS (SELECT query_id, rank, id, rounded AS score, 'hybrid' AS strategy FROM ranked WHERE score >= 0.02),
open_queries AS (SELECT * FROM sentences WHERE query_id NOT IN (SELECT query_id FROM answered)),
{sql.fuzzy_matches("open_queries")},
fuzzy_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank
  FROM (SELECT *, round(score, 6) AS rounded FROM fuzzy_matches) QUALIFY rank <= 10
), results AS (
  SELECT * FROM answered
  UNION ALL SELECT query_id, rank, id, rounded, 'fuzzy' FROM fuzzy_ranked
)
"""


HYBRID_SQL = hybrid_sql(HYBRID) + "SELECT * FROM results"


@query("hybrid_search", HYBRID_SQL)
def hybrid(spark, sf):
    found = hybrid_search(
        c.sentence_queries(spark, sf), c.chunks(spark, sf), 10, 0.02, kind="simple", payload=False
    )
    return found.select(*shown(), "strategy")


@query("hybrid_search_indexed", HYBRID_SQL)
def hybrid_indexed(spark, sf):
    store, frequencies = _indexed(spark, sf)
    found = hybrid_search(
        c.sentence_queries(spark, sf), store.elements.read(), 10, 0.02, kind="simple", index=store.postings.read(),
        frequencies=frequencies, payload=False,
    )
    return found.select(*shown(), "strategy")


@query(
    "hybrid_search_english",
    hybrid_sql(ENGLISH_HYBRID)
    + "SELECT r.*, c.uri, c.text, c.parent_id, c.metadata FROM results r JOIN chunks c USING (id)",
)
def hybrid_english(spark, sf):
    """The flagship: web syntax, stemming, vectors, fallback, whole rows."""
    found = hybrid_search(c.sentence_queries(spark, sf), c.chunks(spark, sf), 10, 0.02)
    return found.select(*shown(), "strategy", "uri", "text", "parent_id", "metadata")


@query("score_cut", f"""
WITH {sql.CHUNKS}, {sql.ITEM_QUERIES},
scored AS (
  SELECT q.query_id, c.id, list_cosine_similarity(q.embedding::DOUBLE[], c.embedding::DOUBLE[]) AS score
  FROM item_queries q, chunks c WHERE c.embedding IS NOT NULL
), {sql.top_k("scored", "score", 20)}
SELECT query_id, rank, id, rounded AS score FROM ranked WHERE score >= 0.35
""")
def score_cut(spark, sf):
    """The cut follows the top-k, without a ceiling."""
    found = nearest(c.benchmark_queries(spark, sf), c.chunks(spark, sf).where(is_chunk()), 20)
    return cut(found, 0.35).select(*shown())


@query("top_k_per_key", """
SELECT o_custkey AS query_id, rank, id, score FROM (
  SELECT o_custkey, o_orderkey AS id, round(o_totalprice, 6) AS score,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank
  FROM orders) WHERE rank <= 3
""")
def top_orders(spark, sf):
    """The top-k building block on its own: each customer's largest orders."""
    orders = c.read(spark, sf, "orders").select(
        F.col("o_custkey").alias("query_id"), F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("score")
    )
    return top_k(orders, 3).select(*shown())
