"""Text match first, then cosine on the matches, with a fuzzy fallback."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.functions.ranking import share_of_one
from trawl.functions.vectors import cosine_similarity
from trawl.operators.fuzzy_search import FUZZY_THRESHOLD, WordTable, best_fuzzy, check_threshold
from trawl.operators.lexicon import Analyzer
from trawl.operators.text_search import text_matches
from trawl.operators.vector_search import Embedder, embedded, is_chunk
from trawl.plans.lineage import materialize
from trawl.plans.sizing import join_checked
from trawl.plans.topk import bounded_rows, cut, top_k, with_payload

VECTOR_WEIGHT = 0.7
TEXT_WEIGHT = 0.3


def check_weight(weight: float) -> float:
    if not 0.0 <= weight <= 1.0:
        raise ValueError("weights must be within 0..1")
    return weight


def hybrid_scores(
    queries: DataFrame,
    chunks: DataFrame,
    *,
    vector_weight: float = VECTOR_WEIGHT,
    text_weight: float = TEXT_WEIGHT,
    syntax: str = "web",
    kind: str | Analyzer = "english",
    index: DataFrame | None = None,
    frequencies: DataFrame | None = None,
    index_covers_all: bool = False,
) -> DataFrame:
    """(query_id, id, vec_score, text_score, score) of every text match.

    A match without a vector keeps its text part.  ``vec_score`` stays NULL.
    """
    check_weight(vector_weight)
    check_weight(text_weight)
    matches = materialize(
        text_matches(
            queries, chunks.select("id", "text"), syntax=syntax, kind=kind, index=index, frequencies=frequencies,
            index_covers_all=index_covers_all,
        )
    )
    asked = queries.select(
        F.col("query_id").cast("string").alias("query_id"), F.col("embedding").alias("query_embedding")
    )
    # ids and vectors only: the text is not part of this join
    vectors = chunks.where(F.col("embedding").isNotNull()).select("id", "embedding")
    # the matches pick their vectors out of the scan; with many of them both
    # sides are shuffled on the chunk, which is unique among the vectors
    paired = join_checked(join_checked(vectors, matches.select("query_id", "id"), "id"), asked, "query_id", spread="id")
    cosine = cosine_similarity(F.col("embedding"), F.col("query_embedding"))
    compared = paired.select("query_id", "id", cosine.alias("vec_score"))
    return matches.join(compared, ["query_id", "id"], "left").select(
        "query_id", "id", "vec_score", share_of_one(F.col("raw_rank")).alias("text_score")
    ).withColumn(
        "score",
        F.coalesce("vec_score", F.lit(0.0)) * F.lit(float(vector_weight))
        + F.col("text_score") * F.lit(float(text_weight)),
    )


def hybrid_search(
    queries: DataFrame,
    elements: DataFrame,
    k: int = 10,
    threshold: float = 0.0,
    *,
    vector_weight: float = VECTOR_WEIGHT,
    text_weight: float = TEXT_WEIGHT,
    fuzzy_threshold: float = FUZZY_THRESHOLD,
    syntax: str = "web",
    kind: str | Analyzer = "english",
    index: DataFrame | None = None,
    frequencies: DataFrame | None = None,
    index_covers_all: bool = False,
    words: WordTable | None = None,
    payload: bool = True,
    embed: Embedder | None = None,
) -> DataFrame:
    """Weighted vector and text score of the text matches, best ``k`` first.

    A query left without a result after the threshold is answered by fuzzy
    search; ``strategy`` tells which of the two answered.  ``words`` is a
    stored word table of the chunks for the latter.  ``embed`` (DataFrame ->
    DataFrame) fills the queries' vectors from their texts.
    """
    queries = embedded(queries, embed)
    check_threshold(fuzzy_threshold)
    chunks = elements.where(is_chunk())
    scored = hybrid_scores(
        queries, chunks,
        vector_weight=vector_weight, text_weight=text_weight,
        syntax=syntax, kind=kind, index=index, frequencies=frequencies, index_covers_all=index_covers_all,
    )
    answered = materialize(cut(top_k(scored, k), threshold).withColumn("strategy", F.lit("hybrid")))
    open_queries = queries.select(F.col("query_id").cast("string").alias("query_id"), "query").join(
        answered.select("query_id").distinct(), "query_id", "left_anti"
    )
    results = answered
    if not open_queries.isEmpty():
        fuzzy = best_fuzzy(open_queries, chunks, k, fuzzy_threshold, words=words)
        results = answered.unionByName(fuzzy.withColumn("strategy", F.lit("fuzzy")), allowMissingColumns=True)
    return with_payload(results, elements, bounded_rows(queries, k)) if payload else results
