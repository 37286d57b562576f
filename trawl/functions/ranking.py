"""Matching and ranking expressions over the hits of one text.

``hits`` is a map from lexeme to its sorted positions in the text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the rank: the weight of a word, the limit of the sum of
# 1/n^2, the distance terms, and the rank of a conjunction without any pair.
WEIGHT = 0.1
SQUARES_LIMIT = 1.64493406685
NEAR_OFFSET, NEAR_SCALE, NEAR_STRETCH, NEAR_SHIFT = 1.005, 0.05, 1.5, 2.0
FAR = 100
NO_PAIR = 1e-20
# What a pair of words further apart than FAR takes from one in double precision.
FAR_CLOSENESS = 2.0 ** -53
# Fixed value: the factor from a raw rank to a text score, capped at 1.
TEXT_SCALE = 3.0


def _positions(hits: Column, lexeme: Column) -> Column:
    return F.coalesce(F.try_element_at(hits, lexeme), F.array().cast("array<int>"))


def _group_matches(hits: Column, group: Column) -> Column:
    """All words of a group are present, in sequence when it is ordered."""
    words = group["words"]
    present = F.forall(words, lambda w: F.map_contains_key(hits, w["lexeme"]))

    def starts(w: Column) -> Column:
        return F.transform(_positions(hits, w["lexeme"]), lambda p: p - w["offset"])

    in_line = F.aggregate(words, starts(words[0]), lambda at, w: F.array_intersect(at, starts(w)))
    return present & (~group["ordered"] | (F.size(in_line) > 0))


def clause_matches(hits: Column, clause: Column) -> Column:
    return F.forall(clause["groups"], lambda g: g["negated"] != _group_matches(hits, g))


def _independent_rank(spots: Column) -> Column:
    per_term = F.transform(
        spots,
        lambda ps: F.aggregate(
            F.transform(ps, lambda p, i: F.lit(WEIGHT) / ((i + 1) * (i + 1))), F.lit(0.0), lambda s, x: s + x
        ),
    )
    return F.aggregate(per_term, F.lit(0.0), lambda s, x: s + x) / SQUARES_LIMIT / F.size(spots)


def _nearness(distance: Column) -> Column:
    near = 1 / (NEAR_OFFSET + NEAR_SCALE * F.exp(distance / NEAR_STRETCH - NEAR_SHIFT))
    return F.sqrt(WEIGHT * WEIGHT * near)


def _all_pairs(spots: Column) -> Column:
    """How many pairs of hits of different terms there are."""
    sizes = F.transform(spots, lambda ps: F.size(ps).cast("double"))
    total = F.aggregate(sizes, F.lit(0.0), lambda s, n: s + n)
    return (total * total - F.aggregate(sizes, F.lit(0.0), lambda s, n: s + n * n)) / 2


def _pairwise_rank(spots: Column) -> Column:
    """1 - product over all pairs of hits of different terms of (1 - closeness).

    A position has one word, so at most ``FAR`` hits are near behind another
    one: each hit meets these, in order.  All far pairs are equally far, so
    their number is enough.
    """
    placed = F.array_sort(F.flatten(
        F.transform(spots, lambda ps, i: F.transform(ps, lambda p: F.struct(p.alias("at"), i.alias("term"))))
    ))
    start = F.struct(F.lit(1.0).alias("left"), F.lit(0).cast("bigint").alias("near"))

    def product(hits: Column) -> Column:
        def against(a: Column, i: Column) -> Column:
            last = F.least(i + FAR, F.size(hits) - 1)
            behind = F.when(i < last, F.sequence(i + 1, last)).otherwise(F.array().cast("array<int>"))

            def meet(s: Column, j: Column) -> Column:
                b = F.get(hits, j)
                closeness = _nearness((b["at"] - a["at"]).cast("double"))
                both = F.struct((s["left"] * (1 - closeness)).alias("left"), (s["near"] + 1).alias("near"))
                return F.when((b["term"] != a["term"]) & (b["at"] - a["at"] <= FAR), both).otherwise(s)

            return F.aggregate(behind, start, meet)

        return F.aggregate(
            F.transform(hits, against), start,
            lambda s, x: F.struct((s["left"] * x["left"]).alias("left"), (s["near"] + x["near"]).alias("near")),
        )

    # a lambda's variable is worked out once; an expression within a lambda, for each of its calls
    met = F.transform(F.array(placed), product)[0]
    pairs = _all_pairs(spots)
    far = lambda near: 1 - (pairs - near) * FAR_CLOSENESS
    rank = F.transform(F.array(met), lambda m: 1 - m["left"] * far(m["near"]))[0]
    return F.when(pairs > 0, rank).otherwise(F.lit(NO_PAIR))


def text_rank(hits: Column, lexemes: Column, conjunction: Column) -> Column:
    """Raw rank of a text for a query with these distinct lexemes."""
    spots = F.transform(lexemes, lambda lexeme: _positions(hits, lexeme))
    return F.when(conjunction, _pairwise_rank(spots)).otherwise(_independent_rank(spots))


def text_score(raw: Column) -> Column:
    return F.least(F.lit(1.0), raw * TEXT_SCALE)


def share_of_one(raw: Column) -> Column:
    """Raw rank brought below one for mixing with a cosine."""
    return raw / (1 + raw)
