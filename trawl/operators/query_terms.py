"""Query texts as a table of terms.

``plain`` takes the words of a query as one conjunction.  ``web`` adds ``or``
between alternatives, a leading ``-`` for exclusion and double quotes for
phrases.  Alternatives become *clauses*; within a clause every word or quoted
part is a *group* that must match, or must not when it is negated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.operators.lexicon import Analyzer, analyzer

# Fixed values: "or" outside quotes, and one unit of a query (a quoted part or
# a run without blanks, either with a leading minus).
ALTERNATIVE = r'(?i)\s+or\s+(?=(?:[^"]*"[^"]*")*[^"]*$)'
UNIT = r'-?"[^"]*"?|[^\s"]+'


def query_terms(queries: DataFrame, syntax: str = "web", kind: str | Analyzer = "english") -> DataFrame:
    """(query_id, clause, group_no, negated, ordered, offset, lexeme) rows."""
    if syntax not in ("web", "plain"):
        raise ValueError("syntax is 'web' or 'plain'")
    a = analyzer(kind)
    base = queries.select(F.col("query_id").cast("string").alias("query_id"), F.trim("query").alias("query"))
    if syntax == "web":
        units = (
            base.select("query_id", F.posexplode(F.split("query", ALTERNATIVE)).alias("clause", "part"))
            .select(
                "query_id", "clause",
                F.posexplode(F.regexp_extract_all("part", F.lit(UNIT), F.lit(0))).alias("unit_no", "unit"),
            )
            .withColumn("negated", F.col("unit").startswith("-"))
            .withColumn("ordered", F.col("unit").contains('"'))
        )
    else:
        units = base.select(
            "query_id", F.lit(0).alias("clause"), F.lit(0).alias("unit_no"), F.col("query").alias("unit"),
            F.lit(False).alias("negated"), F.lit(False).alias("ordered"),
        )
    spelled = units.select(
        "query_id", "clause", "unit_no", "negated", "ordered",
        F.posexplode(a.words(F.col("unit"))).alias("offset", "word"),
    )
    known = a.lexemes(spelled.select("word").distinct()) if a.stems or a.stop_words else None
    terms = spelled.withColumnRenamed("word", "lexeme") if known is None else spelled.join(known, "word").drop("word")
    together = F.col("negated") | F.col("ordered")
    return terms.select(
        "query_id", "clause",
        # a positive unquoted word stands alone; other units stay together
        F.when(together, F.format_string("%05d", "unit_no"))
        .otherwise(F.format_string("%05d.%05d", "unit_no", "offset")).alias("group_no"),
        "negated", "ordered", "offset", "lexeme",
    )


def query_forms(terms: DataFrame, frequencies: DataFrame | None = None) -> DataFrame:
    """One row per query: its clauses, all its lexemes and the shape of its rank.

    Each clause names the ``driver``, the lexeme through which its candidates
    are found: the rarest required one when frequencies are known, else the
    longest.  A clause that only excludes has none.
    """
    if frequencies is not None:
        terms = terms.join(frequencies, "lexeme", "left")
    else:
        terms = terms.withColumn("texts", F.lit(0).cast("bigint"))
    rarity = F.struct(F.coalesce("texts", F.lit(0)), -F.length("lexeme"), "lexeme")
    groups = terms.groupBy("query_id", "clause", "group_no").agg(
        F.first("negated").alias("negated"),
        F.first("ordered").alias("ordered"),
        F.sort_array(F.collect_list(F.struct("offset", "lexeme"))).alias("words"),
        F.min(F.when(~F.col("negated"), rarity)).alias("rarest"),
        F.collect_set("lexeme").alias("lexemes"),
    )
    clauses = groups.groupBy("query_id", "clause").agg(
        F.collect_list(F.struct("negated", "ordered", "words")).alias("groups"),
        F.min("rarest")["lexeme"].alias("driver"),
        F.flatten(F.collect_list("lexemes")).alias("lexemes"),
    )
    only = F.col("clauses")[0]["groups"]
    all_required = (F.size("clauses") == 1) & (
        (F.size(only) > 1) | (~only[0]["negated"])
    )
    return (
        clauses.groupBy("query_id")
        .agg(
            F.sort_array(F.collect_list(F.struct("clause", "groups", "driver"))).alias("clauses"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("lexemes")))).alias("lexemes"),
        )
        .withColumn("conjunction", all_required & (F.size("lexemes") > 1))
    )
