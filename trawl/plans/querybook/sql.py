"""SQL of the adapters, shared by the oracle queries (DuckDB dialect)."""

from __future__ import annotations

from trawl.functions.stemming import KEPT_AFTER_PLURAL, STEP_2, STEP_3, STEP_4, STOP_WORDS, WHOLE_WORDS

CHUNKS = """
lines AS (
  SELECT d.doc_id, d.lang, d.source, d.n_chars, i - 1 AS pos, string_split(d.text, chr(10))[i] AS text
  FROM documents d, unnest(range(1, len(string_split(d.text, chr(10))) + 1)) AS t(i)
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS ord
  FROM lines WHERE trim(text, ' ') <> ''
),
chunks AS (
  SELECT 'doc-' || n.doc_id || '-' || n.pos AS id,
         'corpus://' || n.source || '/' || n.doc_id AS uri,
         n.text AS text, n.text AS urtext, 'doc-' || n.doc_id AS parent_id,
         ['Chunk', 'ContentElement'] AS labels,
         CAST(json_object('lang', n.lang, 'source', n.source, 'n_chars', n.n_chars) AS VARCHAR) AS metadata,
         TIMESTAMP '2024-01-01 00:00:00' + n.doc_id * INTERVAL 1 SECOND AS ingestion_timestamp,
         CAST(NULL AS VARCHAR) AS content_type,
         e.embedding AS embedding
  FROM numbered n LEFT JOIN embeddings e ON e.vec_id = n.doc_id AND n.ord = 0
)"""

ELEMENTS = CHUNKS + """,
document_roots AS (
  SELECT 'doc-' || doc_id AS id, 'corpus://' || source || '/' || doc_id AS uri,
         CAST(NULL AS VARCHAR) AS text, CAST(NULL AS VARCHAR) AS urtext, CAST(NULL AS VARCHAR) AS parent_id,
         ['Document', 'ContentRoot', 'ContentElement'] AS labels,
         CAST(json_object('title', 'Document ' || doc_id, 'ingestionTimestamp', '2024-01-01T00:00:00Z',
                          'lang', lang, 'source', source, 'n_chars', n_chars) AS VARCHAR) AS metadata,
         TIMESTAMP '2024-01-01 00:00:00' + doc_id * INTERVAL 1 SECOND AS ingestion_timestamp,
         CAST(NULL AS VARCHAR) AS content_type
  FROM documents
),
page_roots AS (
  SELECT 'page-' || page_id AS id, url AS uri,
         CAST(NULL AS VARCHAR) AS text, CAST(NULL AS VARCHAR) AS urtext, CAST(NULL AS VARCHAR) AS parent_id,
         ['Document', 'ContentRoot', 'ContentElement'] AS labels,
         CAST(json_object('title', 'Page ' || page_id) AS VARCHAR) AS metadata,
         TIMESTAMP '2024-01-01 00:00:00' + page_id * INTERVAL 1 SECOND AS ingestion_timestamp,
         'text/html' AS content_type
  FROM pages
),
elements AS (
  SELECT * FROM document_roots
  UNION ALL BY NAME SELECT * EXCLUDE (embedding) FROM chunks
  UNION ALL BY NAME SELECT * FROM page_roots
)"""

EVENTS = """
event_elements AS (
  SELECT 'event-' || event_id AS id, ['Chunk', event_type] AS labels, props AS metadata,
         ts AS ingestion_timestamp
  FROM events
)"""

ITEM_QUERIES = """
item_queries AS (
  SELECT 'b' || b.item_id AS query_id, b.text AS query, e.embedding AS embedding
  FROM benchmark b LEFT JOIN embeddings e ON e.vec_id = b.item_id
)"""

SENTENCES = ITEM_QUERIES + """,
sentences AS (
  SELECT query_id || '-' || (i - 1) AS query_id,
         trim(string_split_regex(query, '[.\\n]+')[i], ' ') AS query, embedding
  FROM item_queries, unnest(range(1, len(string_split_regex(query, '[.\\n]+')) + 1)) AS t(i)
  WHERE trim(string_split_regex(query, '[.\\n]+')[i], ' ') <> ''
)"""

NAMES = """
name_queries AS (
  SELECT 'n' || n_nationkey AS query_id, n_name AS query FROM nation
  UNION ALL SELECT 'r' || r_regionkey, r_name FROM region
)"""

# Positions of the simple analyzer: words from 1.
POSTINGS = """
post AS (
  SELECT id, unnest(ws) AS lexeme, unnest(range(1, len(ws) + 1)) AS pos
  FROM (SELECT id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS ws FROM chunks)
)"""


def plain_terms(queries: str) -> str:
    """Every query as one clause of its words."""
    return f"""
terms AS (
  SELECT DISTINCT query_id, 0 AS clause, unnest(regexp_extract_all(lower(query), '[\\p{{L}}\\p{{N}}]+')) AS lexeme
  FROM {queries}
)"""


def web_terms(queries: str) -> str:
    """Clauses between ``or``; for queries without quotes or exclusions."""
    return f"""
parted AS (
  SELECT query_id, string_split_regex(query, '(?i)\\s+or\\s+') AS parts FROM {queries}
),
terms AS (
  SELECT DISTINCT query_id, i AS clause,
         unnest(regexp_extract_all(lower(parts[i]), '[\\p{{L}}\\p{{N}}]+')) AS lexeme
  FROM parted, unnest(range(1, len(parts) + 1)) AS t(i)
)"""


# (query_id, id, raw_rank) of all matches, from ``terms`` and ``post``.
MATCHES = """
wanted AS (SELECT query_id, clause, count(*) AS n FROM terms GROUP BY ALL),
held AS (SELECT DISTINCT id, lexeme FROM post),
matched AS (
  SELECT DISTINCT query_id, id FROM (
    SELECT t.query_id, t.clause, h.id, count(*) AS n
    FROM terms t JOIN held h USING (lexeme) GROUP BY ALL
  ) JOIN wanted USING (query_id, clause, n)
),
all_terms AS (SELECT DISTINCT query_id, lexeme FROM terms),
shape AS (
  SELECT query_id, max(n_terms) AS n_terms, count(*) = 1 AND max(n_terms) > 1 AS conjunction
  FROM (SELECT DISTINCT query_id, clause FROM terms) JOIN
       (SELECT query_id, count(*) AS n_terms FROM all_terms GROUP BY ALL) USING (query_id)
  GROUP BY query_id
),
spots AS (
  SELECT m.query_id, m.id, p.lexeme, p.pos,
         row_number() OVER (PARTITION BY m.query_id, m.id, p.lexeme ORDER BY p.pos) AS j
  FROM matched m JOIN all_terms t USING (query_id) JOIN post p ON p.id = m.id AND p.lexeme = t.lexeme
),
near AS (
  SELECT a.query_id, a.id, a.pos, count(*) AS n,
         list_reduce(list(1 - sqrt(0.1::DOUBLE * 0.1::DOUBLE * (1 / (1.005::DOUBLE + 0.05::DOUBLE * exp((b.pos - a.pos) / 1.5::DOUBLE - 2))))
           ORDER BY b.pos), lambda x, y: x * y) AS left_over
  FROM spots a JOIN spots b ON a.query_id = b.query_id AND a.id = b.id AND a.lexeme <> b.lexeme
   AND b.pos > a.pos AND b.pos <= a.pos + 100
  GROUP BY ALL
),
met AS (
  SELECT query_id, id, list_reduce(list(left_over ORDER BY pos), lambda x, y: x * y) AS left_over, sum(n) AS near
  FROM near GROUP BY query_id, id
),
sizes AS (SELECT query_id, id, lexeme, count(*) AS n FROM spots GROUP BY ALL),
pairs AS (SELECT query_id, id, (sum(n) * sum(n) - sum(n * n)) / 2 AS pairs FROM sizes GROUP BY query_id, id),
apart AS (
  SELECT query_id, id, 1 - coalesce(left_over, 1::DOUBLE) * (1 - (pairs - coalesce(near, 0)) * 1.1102230246251565e-16::DOUBLE) AS raw_rank
  FROM pairs LEFT JOIN met USING (query_id, id) WHERE pairs > 0
),
per_lexeme AS (
  SELECT query_id, id, lexeme, list_reduce(list(0.1::DOUBLE / (j * j) ORDER BY j), lambda x, y: x + y) AS part
  FROM spots GROUP BY ALL
),
alone AS (
  SELECT query_id, id,
         list_reduce(list(part ORDER BY lexeme), lambda x, y: x + y) / 1.64493406685::DOUBLE / any_value(n_terms) AS raw_rank
  FROM per_lexeme JOIN shape USING (query_id) GROUP BY query_id, id
),
matches AS (
  SELECT m.query_id, m.id,
         CASE WHEN s.conjunction THEN coalesce(a.raw_rank, 1e-20) ELSE o.raw_rank END AS raw_rank
  FROM matched m JOIN shape s USING (query_id)
  LEFT JOIN apart a USING (query_id, id) LEFT JOIN alone o USING (query_id, id)
)"""

# (query_id, id, score): per chunk the closest token of each query in ``asked``.
def fuzzy_matches(queries: str) -> str:
    return f"""
q_grams AS (
  SELECT query_id, list_distinct(flatten(list_transform(
           regexp_extract_all(lower(query), '[\\p{{L}}\\p{{N}}]+'),
           lambda w: list_transform(range(1, length(w) + 2), lambda i: substring('  ' || w || ' ', i, 3))))) AS grams
  FROM {queries}
),
held_tokens AS (
  SELECT DISTINCT id, unnest(string_split_regex(
           regexp_replace(lower(coalesce(text, '')), '[^a-z0-9\\s]', '', 'g'), '\\s+')) AS word
  FROM chunks
),
w_grams AS (
  SELECT word, list_distinct(list_transform(range(1, length(word) + 2),
           lambda i: substring('  ' || word || ' ', i, 3))) AS grams
  FROM (SELECT DISTINCT word FROM held_tokens WHERE word <> '')
),
shared AS (
  SELECT query_id, word, count(*) AS n, any_value(nq) AS nq, any_value(nw) AS nw
  FROM (SELECT query_id, len(grams) AS nq, unnest(grams) AS gram FROM q_grams)
  JOIN (SELECT word, len(grams) AS nw, unnest(grams) AS gram FROM w_grams) USING (gram)
  GROUP BY query_id, word
),
close AS (
  SELECT query_id, word, CAST(n / (nq + nw - n) AS FLOAT) AS similarity
  FROM shared WHERE CAST(CAST(n / (nq + nw - n) AS FLOAT) AS DOUBLE) > CAST(0.2 AS DOUBLE)
),
fuzzy_matches AS (
  SELECT query_id, id, max(CAST(similarity AS DOUBLE)) AS score
  FROM close JOIN held_tokens USING (word) GROUP BY ALL
)"""


def top_k(matches: str, score: str, k: int = 10) -> str:
    """Rank on the score as it is, ties to the smaller id; rounded for show."""
    return f"""
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY {score} DESC, id) AS rank
  FROM (SELECT *, round({score}, 6) AS rounded FROM {matches})
  QUALIFY rank <= {k}
)"""


# --- English ------------------------------------------------------------------
# The stemmer once more, as regular expressions over whole vocabularies.

REGION = "^[^aeiouy]*[aeiouy]+[^aeiouy]"
SHORT = "CASE WHEN length({0}) = 2 THEN regexp_matches({0}, '^[aeiouy][^aeiouy]$') ELSE regexp_matches({0}, '[^aeiouy][aeiouy][^aeiouywxY]$') END"


def _by_ending(changes: dict[str, str], region: str, further: dict[str, str]) -> str:
    """CASE over endings, longest first: within ``region``, and where its
    ``further`` condition on the base holds, an ending is exchanged."""
    cases = []
    for end in sorted(changes, key=len, reverse=True):
        base = f"left(w, -{len(end)})"
        holds = f"length(w) - {len(end)} >= {region} AND " + further.get(end, "true").format(base)
        cases.append(f"WHEN ends_with(w, '{end}') THEN CASE WHEN {holds} THEN {base} || '{changes[end]}' ELSE w END")
    return f"CASE {' '.join(cases)} ELSE w END"


def stems(vocabulary: str) -> str:
    """CTE ``stemmed`` (word, stem) for the column ``word``; stop words are left out."""
    stops = ", ".join(f"'{w}'" for w in STOP_WORDS)
    whole = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in WHOLE_WORDS.items())
    kept = ", ".join(f"'{w}'" for w in sorted(KEPT_AFTER_PLURAL))
    second = _by_ending(
        STEP_2, "r1", {"li": "regexp_matches({0}, '[cdeghkmnrt]$')", "ogi": "ends_with({0}, 'l')"}
    )
    third = _by_ending(STEP_3, "r1", {"ative": "length({0}) >= r2"})
    fourth = _by_ending(dict.fromkeys(STEP_4, ""), "r2", {"ion": "regexp_matches({0}, '[st]$')"})
    return f"""
marked AS (
  SELECT word,
         CASE WHEN length(word) <= 2 OR regexp_matches(word, '\\p{{N}}') THEN word ELSE CASE word {whole} END END AS fixed,
         array_to_string(list_transform(range(1, length(word) + 1), lambda i:
           CASE WHEN word[i] = 'y' AND (i = 1 OR regexp_matches(word[i - 1], '[aeiouy]')) THEN 'Y' ELSE word[i] END), '') AS w
  FROM {vocabulary} WHERE word NOT IN ({stops})
),
first_region AS (
  SELECT *, CASE WHEN regexp_matches(w, '^(gener|commun|arsen)') THEN length(regexp_extract(w, '^(gener|commun|arsen)'))
                 ELSE coalesce(nullif(length(regexp_extract(w, '{REGION}')), 0), length(w)) END AS r1
  FROM marked
),
regions AS (
  SELECT *, r1 + coalesce(nullif(length(regexp_extract(substr(w, r1 + 1), '{REGION}')), 0), length(w) - r1) AS r2
  FROM first_region
),
singular AS (
  SELECT * REPLACE (CASE
           WHEN ends_with(w, 'sses') THEN left(w, -2)
           WHEN regexp_matches(w, 'ie[ds]$') THEN CASE WHEN length(w) > 4 THEN left(w, -2) ELSE left(w, -1) END
           WHEN regexp_matches(w, '[us]s$') THEN w
           WHEN ends_with(w, 's') AND regexp_matches(left(w, -2), '[aeiouy]') THEN left(w, -1) ELSE w END AS w)
  FROM regions
),
settled AS (SELECT * REPLACE (CASE WHEN w IN ({kept}) THEN coalesce(fixed, w) ELSE fixed END AS fixed) FROM singular),
parted_past AS (
  SELECT *, regexp_extract(w, '(eedly|ingly|edly|eed|ing|ed)$') AS gone,
         regexp_replace(w, '(eedly|ingly|edly|eed|ing|ed)$', '') AS base
  FROM settled
),
present AS (
  SELECT * EXCLUDE (gone, base) REPLACE (CASE
           WHEN gone = '' THEN w
           WHEN gone IN ('eed', 'eedly') THEN CASE WHEN length(base) >= r1 THEN base || 'ee' ELSE w END
           WHEN NOT regexp_matches(base, '[aeiouy]') THEN w
           WHEN regexp_matches(base, '(at|bl|iz)$') THEN base || 'e'
           WHEN regexp_matches(base, '(bb|dd|ff|gg|mm|nn|pp|rr|tt)$') THEN left(base, -1)
           WHEN length(base) <= r1 AND {SHORT.format('base')} THEN base || 'e' ELSE base END AS w)
  FROM parted_past
),
ended_y AS (
  SELECT * REPLACE (CASE WHEN length(w) > 2 AND regexp_matches(w, '[^aeiouy][yY]$') THEN left(w, -1) || 'i' ELSE w END AS w)
  FROM present
),
second_step AS (SELECT * REPLACE ({second} AS w) FROM ended_y),
third_step AS (SELECT * REPLACE ({third} AS w) FROM second_step),
fourth_step AS (SELECT * REPLACE ({fourth} AS w) FROM third_step),
stemmed AS (
  SELECT word, coalesce(fixed, replace(CASE
           WHEN ends_with(w, 'e') AND (length(w) - 1 >= r2 OR length(w) - 1 >= r1 AND NOT {SHORT.format('left(w, -1)')}) THEN left(w, -1)
           WHEN ends_with(w, 'll') AND length(w) - 1 >= r2 THEN left(w, -1) ELSE w END, 'Y', 'y')) AS stem
  FROM fourth_step
)"""


def english(queries: str | None = None) -> str:
    """CTEs ``post`` and, for the web syntax over ``queries``, ``terms``."""
    asked = "" if queries is None else f"""
parted AS (SELECT query_id, string_split_regex(query, '(?i)\\s+or\\s+') AS parts FROM {queries}),
asked AS (
  SELECT DISTINCT query_id, i AS clause, unnest(regexp_extract_all(lower(parts[i]), '[\\p{{L}}\\p{{N}}]+')) AS word
  FROM parted, unnest(range(1, len(parts) + 1)) AS t(i)
),"""
    more = "" if queries is None else "UNION SELECT word FROM asked"
    terms = "" if queries is None else """,
terms AS (SELECT DISTINCT query_id, clause, stem AS lexeme FROM asked JOIN stemmed USING (word))"""
    return f"""
placed AS (
  SELECT id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos
  FROM (SELECT id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS ws FROM chunks)
),{asked}
vocabulary AS (SELECT word FROM placed {more}),
distinct_words AS (SELECT DISTINCT word FROM vocabulary),
{stems("distinct_words").strip()},
post AS (SELECT id, stem AS lexeme, pos FROM placed JOIN stemmed USING (word)){terms}"""


def term_vectors(table: str, key: str, text: str) -> str:
    """CTE ``<table>_vectors`` (key, embedding): hashed words, weighed over the chunks."""
    weights = """
buckets AS (
  SELECT bucket, count(*) AS texts FROM (
    SELECT unnest(list_distinct([CAST('0x' || substring(md5(w), 1, 4) AS INTEGER)
                                 FOR w IN regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')])) AS bucket FROM chunks
  ) GROUP BY bucket
),
size AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM chunks),""" if table == "chunks" else ""
    return f"""{weights}
{table}_words AS (SELECT {key}, md5(unnest(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+'))) AS h FROM {table}),
{table}_signed AS (
  SELECT {key}, CAST('0x' || substring(h, 1, 4) AS INTEGER) AS bucket,
         CASE WHEN substring(h, 5, 1) < '8' THEN 1 ELSE -1 END AS sign FROM {table}_words
),
{table}_sums AS (
  SELECT {key}, bucket % 64 AS slot, sum(sign * (ln((1 + n) / (1 + CAST(coalesce(texts, 0) AS DOUBLE))) + 1)) AS value
  FROM {table}_signed LEFT JOIN buckets USING (bucket), size GROUP BY ALL
),
{table}_vectors AS (
  SELECT {key}, list(coalesce(value, 0) ORDER BY slot) AS embedding
  FROM (SELECT DISTINCT {key} FROM {table}_sums) CROSS JOIN (SELECT unnest(range(64)) AS slot) LEFT JOIN {table}_sums USING ({key}, slot)
  GROUP BY {key}
)"""


def word_kinds(text: str) -> str:
    """The words of a text with addresses, urls, decimals and hyphenated words whole."""
    found = (
        "regexp_extract_all(lower(" + text + "), "
        "'[\\p{L}\\p{N}][\\p{L}\\p{N}._%+-]{0,63}@[\\p{L}\\p{N}-]+(?:\\.[\\p{L}\\p{N}-]+)+"
        "|[a-z][a-z0-9+.-]{0,15}://[^\\x00-\\x20<>\"]*[\\p{L}\\p{N}/]"
        "|v?\\p{N}+(?:[.,]\\p{N}+)+"
        "|[\\p{L}\\p{N}]+(?:-[\\p{L}\\p{N}]+)*')"
    )
    return f"""flatten([
      CASE WHEN contains(w, '://') THEN [w, regexp_extract(w, '://([^/?#]*)', 1)]
           WHEN regexp_matches(w, '^[\\p{{L}}\\p{{N}}]+(-[\\p{{L}}\\p{{N}}]+)+$') THEN list_concat([w], string_split(w, '-'))
           ELSE [w] END FOR w IN {found}])"""
