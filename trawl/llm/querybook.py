"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.llm import (
    decontam, langid, licenses, lines, mixing, negatives, pieces, prefixtrie, repair, simhash, units, urlfilter, warc,
)
from trawl.plans.lineage import checkpoint_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return keep


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _folder(spark: SparkSession, kind: str) -> str:
    """A new folder all executors share."""
    return f"{checkpoint_folder(spark)}/{kind}-{uuid.uuid4().hex}"


@query("op1_repair_files")
def repair_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark, "ids")
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    repair.write_ids(_table(spark, sf_dir, "documents"), tokenizer, folder, end_id=1)
    return repair.read_digests(spark, folder).select(
        F.col("id").alias("doc_id"), "start", F.col("n_ids").alias("n_tokens"), F.col("crc32").alias("ids_crc32")
    )


RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

URL_SQL = """
WITH cut AS (
  SELECT page_id, row_number() OVER () AS row,
         CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
  FROM pages
), url AS (
  SELECT page_id, row,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), rules(rule, verdict) AS (
  VALUES ('net/', 'block'), ('example.net/en/', 'allow'), ('example.com/de/', 'block'), ('org/fr/', 'allow')
), parts AS (
  SELECT rule, verdict, split_part(rule, '/', 1) AS h, substr(rule, position('/' IN rule)) AS p FROM rules
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM url LEFT JOIN parts ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
QUALIFY row_number() OVER (PARTITION BY row ORDER BY length(rule) DESC NULLS LAST, rule DESC) = 1
"""


@query("op2_url_cascade", URL_SQL)
def url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "rule string, verdict string")
    return urlfilter.judge_urls(_table(spark, sf_dir, "pages"), rules).withColumnRenamed("id", "page_id")


WARC_SQL = """
WITH sized AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), latest AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS newest FROM sized
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN newest <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN newest <> page_id THEN newest END AS refers_to
FROM latest
"""


@query("op3_warc_chunks", WARC_SQL)
def warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark, "warc")
    warc.write_archive(_table(spark, sf_dir, "pages"), folder)
    return warc.read_archive(spark, folder).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query("op4_line_cleaning")
def line_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = lines.clean_lines(_table(spark, sf_dir, "documents"))
    return judged.select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_lines", "n_removed_lines", "n_removed_words",
        F.sha1(F.encode("cleaned", "UTF-8")).alias("cleaned_sha1"),
    )


@query("op5_simhash_pigeonhole")
def simhash_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), words=4, bits=4)
    return found.select(
        F.col("id").alias("doc_id"), simhash.hex_of("fp").alias("fingerprint"), F.col("component").alias("component_id")
    )


@query("op6_language_spans")
def language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = langid.fit(docs.where(~held_out))
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return langid.label(marked, model).select(
        F.col("id").alias("doc_id"),
        (F.crc32(F.col("id").cast("string").cast("binary")) % 5 == 0).alias("held_out"),
        F.col("lang").alias("lang_pred"), "score", F.size("spans").cast("long").alias("n_spans"),
    )


@query("op7_repeated_units")
def repeated_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = units.repeated_units(_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "start", "stop", F.concat(simhash.hex_of("high"), simhash.hex_of("low")).alias("digest"),
        F.col("kept_id").alias("kept_doc_id"), "kept_start",
    )


@query("op8_piece_agenda")
def piece_agenda(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = pieces.digest_texts(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return coded.withColumnRenamed("id", "doc_id")


@query("op10_license_index")
def license_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


LEAK_SQL = r"""
WITH words AS (
  SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM documents
), items AS (
  SELECT item_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS v FROM benchmark
), tw AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, unnest(range(len(w))) AS place FROM words),
iw AS (SELECT item_id, len(v) AS m, unnest(v) AS word, unnest(range(len(v))) AS item_at FROM items),
same AS (
  SELECT doc_id, item_id, n, m, least(m, 20) AS length, place - item_at AS diagonal, item_at
  FROM tw JOIN iw USING (word)
), dense AS (
  SELECT doc_id, item_id, diagonal, any_value(n) AS n, any_value(m) AS m, any_value(length) AS length, list(item_at) AS places
  FROM same GROUP BY ALL HAVING count(*) >= 0.8 * any_value(length)
), windows AS (
  SELECT *, unnest(range(greatest(0, -diagonal), least(m, n - diagonal) - length + 1)) AS item_start FROM dense
), counted AS (
  SELECT doc_id, item_id, diagonal, item_start, length,
         len(list_filter(places, lambda p: p >= item_start AND p < item_start + length)) AS same
  FROM windows
)
SELECT doc_id, item_id, diagonal + item_start AS start_word, diagonal + item_start + length AS stop_word,
       item_start, same AS n_same
FROM counted WHERE same >= 0.8 * length
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY same DESC, diagonal + item_start, item_start) = 1
"""


@query("op9_spaced_seeds", LEAK_SQL)
def spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), F.col("item").alias("item_id"), F.col("start").cast("long").alias("start_word"),
        F.col("stop").cast("long").alias("stop_word"), F.col("item_start").cast("long").alias("item_start"),
        F.col("same").cast("long").alias("n_same"),
    )


NEGATIVE_SQL = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM whole a JOIN whole b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""


@query("op11_slot_negatives", NEGATIVE_SQL)
def slot_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", moved.alias("label"), "embedding")
    found = negatives.hard_negatives(rows, rows["vec_id"] % 100 == 0, positives=5, negatives=5, low_percent=80)
    return found.select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank",
        F.col("negative").alias("negative_id"), "positive_score", "negative_score",
    )


TRIE_SQL = r"""
WITH plain AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL
), lists AS (
  SELECT conv_id, list({'r': r, 't': t} ORDER BY turn NULLS FIRST, r, md5(length(r)::VARCHAR || ':' || r || t)) AS own
  FROM plain GROUP BY conv_id
), heads AS (
  SELECT *, (xor(4294967295, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
        lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)))) % 4)::INT AS h
  FROM lists
), rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(p.own[1:c.h], []), c.own[c.h + 1:]) AS path
  FROM heads c LEFT JOIN lists p ON p.conv_id = c.conv_id - c.conv_id % 20
), prefixes AS (
  SELECT conv_id, path, unnest(range(len(path) + 1)) AS depth FROM rebuilt
), nodes AS (
  SELECT path[1:depth] AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(path) = depth), '')) AS ends_sha256
  FROM prefixes GROUP BY ALL
), counted AS (
  SELECT n.*, len(regexp_extract_all(coalesce(node[depth].t, ''), '[^\x20\x09-\x0D]+')) * (n_convs - 1) AS saved,
         (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.node[1:n.depth] = n.node) AS n_children
  FROM nodes n
), above AS (
  SELECT node, saved, n_children, unnest(range(depth + 1)) AS d FROM counted
), subtrees AS (
  SELECT node[1:d] AS node, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM above GROUP BY ALL
)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, s.n_leaves, s.saved_tokens, c.ends_sha256
FROM counted c JOIN subtrees s ON s.node = c.node
LEFT JOIN nodes p ON p.depth = c.depth - 1 AND p.node = c.node[1:c.depth - 1]
"""


@query("op12_prefix_trie", TRIE_SQL)
def prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefixtrie.turn_lists(_table(spark, sf_dir, "conversations"))
    return prefixtrie.prefix_trie(prefixtrie.spliced(turns, every=20, heads=4))


MIX_SQL = r"""
WITH judged AS (
  SELECT doc_id, avg(CASE quality WHEN 1 THEN 2.0::DOUBLE WHEN 0 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END) AS weight
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), docs AS (
  SELECT d.doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ 	-]+')) AS size,
         coalesce(weight, 1.0::DOUBLE) AS weight
  FROM documents d LEFT JOIN judged j ON j.doc_id = d.doc_id
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source
), weighed AS (
  SELECT *, [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::BIGINT AS w FROM sources
), ordered AS (
  SELECT *, row_number() OVER caps AS place,
         150 * sum(source_size) OVER () - 200 * (sum(source_size) OVER caps - source_size) AS over,
         100 * (sum(w) OVER () - sum(w) OVER caps + w) AS under
  FROM weighed WINDOW caps AS (ORDER BY source_size / w::DOUBLE, source NULLS LAST ROWS UNBOUNDED PRECEDING)
), level AS (
  SELECT min_by({'place': place, 'over': over, 'under': under}, place) AS l FROM ordered WHERE w * over <= 2 * source_size * under
), planned AS (
  SELECT source, source_size,
         CASE WHEN place < l.place THEN (2 * source_size)::DOUBLE ELSE w::DOUBLE * l.over::DOUBLE / l.under::DOUBLE END AS target
  FROM ordered, level
), budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM planned
), keyed AS (
  SELECT doc_id, size, source_size, target, epochs, target - (epochs * source_size)::DOUBLE AS budget, p.source,
         -ln((('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || size), 1, 13))::BIGINT + 1)::DOUBLE
             / 4503599627370496.0::DOUBLE) / weight AS arrival
  FROM docs d JOIN budgets p ON p.source IS NOT DISTINCT FROM d.source
), counted AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY arrival, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) - size AS before
  FROM keyed
)
SELECT doc_id, size, source_size, target,
       ((epochs + CASE WHEN budget > before AND 2 * (budget - before) >= size THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM counted
"""


@query("op13_weighted_mix", MIX_SQL)
def weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = F.when(F.col("quality") == 1, 2.0).when(F.col("quality") == 0, 0.5).otherwise(1.0)
    quality = _table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), good.alias("weight"))
    mixed = mixing.mix(_table(spark, sf_dir, "documents"), weights=(3, 1, 2), share_percent=150, quality=quality, seed="mix")
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")
