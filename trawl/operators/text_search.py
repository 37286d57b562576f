"""Full-text search of a query table over chunks.

Hits of the query lexemes are gathered per chunk (one row per chunk with a map
from lexeme to positions).  A clause meets a chunk through one *driver* lexeme
only; the rest of the match and the rank are evaluated in that row, so nothing
but finished (query, chunk, rank) rows reach the top-k shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.functions.filters import Filter, combine
from trawl.functions.ranking import clause_matches, text_rank, text_score
from trawl.operators.lexicon import Analyzer, matching_positions
from trawl.operators.query_terms import query_forms, query_terms
from trawl.operators.vector_search import is_chunk
from trawl.plans.lineage import materialize
from trawl.plans.sizing import BROADCAST_ROWS, at_most, join_checked
from trawl.plans.topk import bounded_rows, cut, top_k, with_payload

# Up to this many lexemes reach an index scan as a pushed-down IN list.
PUSHED_LEXEMES = 200


def _within(found: DataFrame, chunks: DataFrame) -> DataFrame:
    """The hits that lie in ``chunks``.  Few hits pick their chunks out of the
    scan; with many both sides are shuffled on the id."""
    found = materialize(found)
    if at_most(found, BROADCAST_ROWS):
        chunks = chunks.join(F.broadcast(found.select("id").distinct()), "id", "left_semi")
        return found.join(F.broadcast(chunks.select("id")), "id", "left_semi")
    return found.join(chunks.select("id"), "id", "left_semi")


def hits_by_chunk(positions: DataFrame) -> DataFrame:
    """(id, hits): per chunk a map from lexeme to positions."""
    return positions.groupBy("id").agg(
        F.map_from_entries(F.collect_list(F.struct("lexeme", "positions"))).alias("hits")
    )


def text_matches(
    queries: DataFrame,
    chunks: DataFrame,
    *,
    syntax: str = "web",
    kind: str | Analyzer = "english",
    index: DataFrame | None = None,
    frequencies: DataFrame | None = None,
    index_covers_all: bool = False,
) -> DataFrame:
    """(query_id, id, raw_rank) of every chunk that matches a query.

    ``chunks`` are searchable rows (id, text).  With ``index``, a stored
    postings table, the texts are not read again, and hits outside of
    ``chunks`` are left out.  Say ``index_covers_all`` where the chunks are all
    that the index holds: then their ids are not read either.
    """
    forms = materialize(query_forms(query_terms(queries, syntax, kind), frequencies))
    wanted = forms.select(F.explode("lexemes").alias("lexeme")).distinct()
    if index is None:
        positions = matching_positions(chunks, wanted, kind)
    else:
        # lexemes first: they cut the index down before anything is shuffled
        few = [r.lexeme for r in wanted.limit(PUSHED_LEXEMES + 1).collect()]
        if len(few) <= PUSHED_LEXEMES:
            found = index.where(F.col("lexeme").isin(few))
        else:
            found = join_checked(index, wanted, "lexeme", spread="id")
        found = found.select("id", "lexeme", "positions")
        positions = (found if index_covers_all else _within(found, chunks)).repartition("id")
    by_chunk = hits_by_chunk(positions)

    # queries that ask the same, as single words often do, are matched and ranked once
    alike = forms.groupBy("clauses", "lexemes", "conjunction").agg(F.collect_list("query_id").alias("query_ids"))
    clauses = alike.select(
        "query_ids", "clauses", "lexemes", "conjunction", F.posexplode("clauses").alias("at", "clause")
    ).select("query_ids", "clauses", "lexemes", "conjunction", "at", F.col("clause.driver").alias("driver"))
    driven = clauses.where(F.col("driver").isNotNull())
    candidates = join_checked(
        by_chunk.select("id", "hits", F.explode(F.map_keys("hits")).alias("driver")), driven, "driver", spread="id"
    )
    undriven = clauses.where(F.col("driver").isNull())
    if not undriven.isEmpty():
        # clauses that only exclude start from every chunk, under one shared key
        everything = (
            chunks.select("id")
            .join(by_chunk, "id", "left")
            .withColumn("hits", F.coalesce("hits", F.create_map().cast("map<string,array<int>>")))
            .withColumn("driver", F.lit(""))
        )
        rest = join_checked(everything, undriven.withColumn("driver", F.lit("")), "driver", spread="id")
        candidates = candidates.unionByName(rest)

    hits = F.col("hits")
    first_match = clause_matches(hits, F.col("clauses")[F.col("at")]) & ~F.exists(
        F.slice("clauses", F.lit(1), F.col("at")), lambda earlier: clause_matches(hits, earlier)
    )
    ranked = candidates.where(first_match).select(
        "query_ids", "id", text_rank(hits, F.col("lexemes"), F.col("conjunction")).alias("raw_rank")
    )
    return ranked.select(F.explode("query_ids").alias("query_id"), "id", "raw_rank")


def text_search(
    queries: DataFrame,
    elements: DataFrame,
    k: int = 10,
    threshold: float = 0.0,
    *,
    ceiling: float | None = 0.5,
    syntax: str = "web",
    kind: str | Analyzer = "english",
    metadata_filter: Filter | None = None,
    entity_filter: Filter | None = None,
    index: DataFrame | None = None,
    frequencies: DataFrame | None = None,
    index_covers_all: bool = False,
    payload: bool = True,
) -> DataFrame:
    """Best ``k`` matching chunks per query, score ``min(1, 3 x rank)``.

    The filtered form of the search is ``syntax='plain', ceiling=None`` with
    filters; they narrow the chunks ahead of the top-k.
    """
    chunks = elements.where(is_chunk() & combine(metadata_filter, entity_filter))
    matches = text_matches(
        queries, chunks.select("id", "text"), syntax=syntax, kind=kind, index=index, frequencies=frequencies,
        index_covers_all=index_covers_all and metadata_filter is None and entity_filter is None,
    )
    ranked = top_k(matches, k, score="raw_rank").withColumn("score", text_score(F.col("raw_rank")))
    results = cut(ranked, threshold, ceiling)
    return with_payload(results, elements, bounded_rows(queries, k)) if payload else results


def prefix_matches(prefixes: DataFrame, chunks: DataFrame, *, index: DataFrame | None = None) -> DataFrame:
    """(query_id, id, words) of chunks with a word that starts with a prefix.

    Prefixes meet words through an equal key, the leading part of the word at
    each prefix length in use, so no pair without a match is formed.
    """
    wanted = prefixes.select(
        F.col("query_id").cast("string").alias("query_id"), F.lower(F.trim("query")).alias("start")
    ).where("start != ''")
    lengths = [r[0] for r in wanted.select(F.length("start")).distinct().collect()]
    if index is None:
        from trawl.functions.text import words

        held = chunks.select("id", F.explode(F.array_distinct(words(F.col("text")))).alias("lexeme"))
    else:
        held = index.select("id", "lexeme")
    starts = F.array(*[F.when(F.length("lexeme") >= n, F.left("lexeme", F.lit(n))) for n in sorted(lengths)])
    keyed = held.select("id", "lexeme", F.explode(F.array_compact(starts.cast("array<string>"))).alias("start"))
    met = join_checked(keyed, wanted, "start", spread="id")
    if index is not None:
        met = met.join(chunks.select("id"), "id", "left_semi")
    return (
        met.groupBy("query_id", "id")
        .agg(F.count("*").alias("words"))
    )
