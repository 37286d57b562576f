"""Typo-tolerant search: trigram similarity of tokens to a whole query.

A set-similarity join with prefix filtering.  Each distinct token is scored
once, as the sorted numbers of its trigrams, rarest first.  Two sets of n and m
members that are similar enough share at least ``needed`` of them, so their
first common trigram stands so early that as many can still follow on both
sides: only such beginnings of the sets meet, a pair is taken at its first
common trigram alone, and sizes and places rule it out before the sets are
compared.  All of it is exact.

Of each token only the ``k`` smallest chunk ids can enter a ranking: further
chunks with the token stand behind these, whatever else they hold.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trawl.functions.text import clean_text, tokens
from trawl.functions.trigrams import trigram_set, word_trigrams
from trawl.operators.vector_search import is_chunk
from trawl.plans.lineage import materialize
from trawl.plans.sizing import join_checked, shuffled
from trawl.plans.topk import WINDOW_LIMIT_ROWS, bounded_rows, check_k, top_k, with_payload

FUZZY_THRESHOLD = 0.2
#: Similarities are held in single precision, which may lift one by less than this.
ROUNDING = 1e-6


def check_threshold(threshold: float) -> float:
    if not 0.0 <= threshold <= 1.0:
        raise ValueError("the fuzzy threshold must be within 0..1")
    return threshold


def chunk_tokens(chunks: DataFrame) -> DataFrame:
    """(id, word): the distinct tokens of each chunk, from the stored column or
    from the text where it is not filled."""
    from_text = tokens(clean_text(F.col("text")))
    held = F.coalesce("tokens", from_text) if "tokens" in chunks.columns else from_text
    return chunks.select("id", F.explode(F.array_distinct(held)).alias("word")).where("word != ''")


@dataclass(frozen=True)
class WordTable:
    """The tokens of a corpus, made once and used by any number of searches.

    ``held`` has (id, word), ``words`` (word, size, codes), ``codes`` (gram,
    code): codes number the trigrams from the rarest on.
    """

    held: DataFrame
    words: DataFrame
    codes: DataFrame


def word_table(chunks: DataFrame) -> WordTable:
    """The word table of all chunks, kept under the checkpoint folder."""
    held = materialize(chunk_tokens(chunks))
    # combined on the map side first; the second step fixes how many tasks share
    # the scoring, which weighs far more than the size of the words suggests
    tasks = max(int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    # written first: the filter that comes with an explode would be worked out for all occurrences
    distinct = materialize(held.select("word").distinct().repartition(tasks, "word"))
    cut = distinct.select("word", F.array_distinct(word_trigrams(F.col("word"))).alias("grams"))
    spread = materialize(cut.select("word", F.size("grams").alias("size"), F.explode("grams").alias("gram")))
    # tokens are made of a-z, 0-9 and the blanks around them: 37 ** 3 trigrams at most
    rarest_first = Window.orderBy("words", "gram")
    codes = materialize(
        spread.groupBy("gram").agg(F.count("*").alias("words"))
        .select("gram", (F.row_number().over(rarest_first) - 1).alias("code"))
    )
    coded = spread.join(F.broadcast(codes), "gram").groupBy("word", "size").agg(F.collect_list("code").alias("codes"))
    sorted_codes = coded.withColumn("codes", F.sort_array("codes")).repartition(tasks, "word")
    return WordTable(held, materialize(sorted_codes), codes)


def needed(threshold: float, a: Column, b: Column) -> Column:
    """The least number of shared members of two sets of these sizes."""
    share = max(threshold - ROUNDING, 0.0)
    return F.greatest(F.ceil((a + b) * F.lit(share / (1 + share))), F.lit(1)).cast("int")


def _beginnings(sets: DataFrame, key: str, size: str, codes: str, at: str, threshold: float, smallest: int) -> DataFrame:
    """One row for each code of the sets that can be the first one shared.

    ``missing`` members of a set stand in no set of the other side; rarer than
    all others, they come first.
    """
    # the least that must be shared, with the smallest set that is similar at all
    other = F.greatest(F.lit(smallest), F.ceil(F.col(size) * F.lit(max(threshold - ROUNDING, 0.0))).cast("int"))
    most = F.col(size) - needed(threshold, F.col(size), other) + 1 - F.col("missing")
    return sets.where(most > 0).select(
        key, size, codes, "missing", F.posexplode(F.slice(codes, F.lit(1), most)).alias(at, "code")
    ).withColumn(at, F.col(at) + F.col("missing")).drop("missing")


def token_similarities(queries: DataFrame, table: WordTable, threshold: float) -> DataFrame:
    """(query_id, word, similarity) of distinct words above the threshold."""
    grams = queries.select(
        F.col("query_id").cast("string").alias("query_id"), trigram_set(F.col("query")).alias("grams")
    ).where(F.size("grams") > 0)
    coded = grams.select("query_id", F.size("grams").alias("nq"), F.explode("grams").alias("gram")).join(
        F.broadcast(table.codes), "gram"
    )
    asked = coded.groupBy("query_id", "nq").agg(F.sort_array(F.collect_list("code")).alias("asked_codes"))
    asked = materialize(asked.withColumn("missing", F.col("nq") - F.size("asked_codes")))
    offered = table.words.select("word", F.col("size").alias("nw"), "codes", F.lit(0).alias("missing"))
    low, high = asked.agg(F.min("nq"), F.max("nq")).first()
    shortest, longest = offered.agg(F.min("nw"), F.max("nw")).first()
    if threshold > 0:
        # sets whose sizes are further apart than the threshold cannot be similar,
        # so whole sentences never meet words, nor the words far from any query
        asked = asked.where(F.col("nq").between((shortest or 0) * threshold, (longest or 0) / threshold))
        offered = offered.where(F.col("nw").between((low or 0) * threshold, (high or 0) / threshold))
    left = _beginnings(offered, "word", "nw", "codes", "at", threshold, low or 1)
    right = _beginnings(asked, "query_id", "nq", "asked_codes", "asked_at", threshold, shortest or 1)
    must = needed(threshold, F.col("nq"), F.col("nw"))
    shared = F.size("common")
    similarity = (shared / (F.col("nq") + F.col("nw") - shared)).cast("float")
    return (
        join_checked(left, right, "code", spread="word")
        # enough members can still follow on both sides
        .where((F.col("nw") - F.col("at") >= must) & (F.col("nq") - F.col("asked_at") >= must))
        # as a generator's output: filters on it cannot move into the join, ahead of the cheap ones
        .select("query_id", "word", "nq", "nw", "code",
                F.explode(F.array(F.array_intersect("codes", "asked_codes"))).alias("common"))
        # both are sorted, so this is their first common one and the pair comes up once
        .where(F.get("common", F.lit(0)) == F.col("code"))
        .select("query_id", "word", similarity.alias("similarity"))
        .where(F.col("similarity") > F.lit(float(threshold)))
    )


def fuzzy_matches(
    queries: DataFrame, chunks: DataFrame, threshold: float = FUZZY_THRESHOLD, *, words: WordTable | None = None
) -> DataFrame:
    """(query_id, id, score): per chunk its closest token, above the threshold."""
    check_threshold(threshold)
    table = words or word_table(chunks)
    close = materialize(token_similarities(queries, table, threshold))
    return (
        join_checked(table.held, close, "word", spread="id")
        .groupBy("query_id", "id")
        .agg(F.max("similarity").cast("double").alias("score"))
    )


def best_fuzzy(
    queries: DataFrame, chunks: DataFrame, k: int, threshold: float = FUZZY_THRESHOLD, *, words: WordTable | None = None
) -> DataFrame:
    """The ``k`` best of ``fuzzy_matches``, without forming all of them.

    A ranking takes the smallest ids of a token only, and no token that is
    less similar than one which fills the ranking by itself.  With a word table
    all of its chunks are searched, so it has to be one of these ``chunks``.
    """
    check_threshold(check_k(k) and threshold)
    table = words or word_table(chunks)
    close = materialize(token_similarities(queries, table, threshold))
    met = join_checked(table.held, close.select("word").distinct(), "word", spread="id")
    if k < WINDOW_LIMIT_ROWS:
        # the limit is applied by each task ahead of the shuffle
        smallest = Window.partitionBy("word").orderBy("id")
        met = met.withColumn("place", F.row_number().over(smallest)).where(F.col("place") <= k)
    else:
        met = met.withColumn("place", F.lit(0))
    first = materialize(met)
    full = first.where(F.col("place") == k).select("word", F.lit(True).alias("full"))
    fills = F.max(F.when(F.col("full"), F.col("similarity"))).over(Window.partitionBy("query_id"))
    able = close.join(shuffled(full), "word", "left").withColumn("fills", fills).where(
        F.col("fills").isNull() | (F.col("similarity") >= F.col("fills"))
    ).select("query_id", "word", "similarity")
    found = first.select("word", "id").join(shuffled(able), "word").groupBy("query_id", "id").agg(
        F.max("similarity").cast("double").alias("score")
    )
    return top_k(found, k)


def fuzzy_search(
    queries: DataFrame,
    elements: DataFrame,
    k: int = 10,
    threshold: float = FUZZY_THRESHOLD,
    *,
    words: WordTable | None = None,
    payload: bool = True,
) -> DataFrame:
    """Chunks with a token similar to the query, best ``k`` first.

    ``words`` is a stored word table of these elements' chunks; without one
    their texts are cut up anew.
    """
    found = best_fuzzy(queries, elements.where(is_chunk()), k, threshold, words=words)
    return with_payload(found, elements, bounded_rows(queries, k)) if payload else found
