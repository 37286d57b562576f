"""Benchmark passages in training texts, found by spaced seeds.

Words are runs of letters and digits, lower-cased.  A mask such as 101111
hashes the words under its ones and ignores those under its zeros.  Both masks
are laid at every word of benchmark items and of texts, and equal hashes are
hits.  A hit puts an item's word against a text's word; around it, stretches
of ``WINDOW`` words (whole items where they are shorter) are compared word by
word, and one with ``SIMILAR`` of its words equal is an overlap.

The two masks together miss nothing: for every length from ``SHORTEST`` to
``WINDOW`` words, whichever fifth of a stretch is substituted, one of them
fits in between.  Items of fewer words have masks of their own length: their
words fall into parts, more than twice as many as words may be substituted, and
each mask ignores as many parts as that.

All hashes of the benchmark are also held in a small bit table, a constant of
the plan, that lets nearly all places of a text go before anything is
exploded or joined; whatever its size, it drops no hit.

Texts are read whole, whatever their length; a very long one takes its
task memory in proportion.  Null and empty texts and items have no words and no hits.  Repeated rows are
reported once each text: equal (id, text) rows count as one.  An empty table
on either side gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from itertools import combinations
from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.llm.batches import free_prefix
from trawl.llm.once import with_once
from trawl.plans.lineage import materialize

# Found by trying all substitutions of up to a fifth of 12 to 20 words.
MASKS = ("101111", "1110011")
SHORTEST = 12
WINDOW = 20
SIMILAR = 0.8
#: Bits of the table in the plan: at most this many (2 MB).
MOST_BITS = 1 << 24
#: Where in a hash the places of its bits are read.
SHIFTS = (0, 20, 40)
#: Benchmark hashes up to this number (16 bytes each) may be broadcast.
BROADCAST_HASHES = 500_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def hashed(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _seed(words: Column, at: Column, mask: str) -> Column:
    """The hash of the words under a mask laid at word ``at`` (from 0)."""
    return F.xxhash64(F.lit(mask), *[F.get(words, at + i) for i, one in enumerate(mask) if one == "1"])


def short_masks(n: int) -> list[str]:
    """Masks of n words, one of which ignores any fifth that is substituted."""
    gone = int(n * (1 - SIMILAR) + 1e-9)
    parts = 2 * gone + 1
    return ["".join("0" if i * parts // n in out else "1" for i in range(n)) for out in combinations(range(parts), gone)]


def _places(words: Column, span: int) -> Column:
    last = F.size(words) - span
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _seeds(words: Column, masks: list[str]) -> Column:
    """Every (at, seed) of all masks."""
    def under(mask: str) -> Column:
        return F.transform(_places(words, len(mask)), lambda at: F.struct(at.alias("at"), _seed(words, at, mask).alias("seed")))

    laid = [under(m) for m in masks]
    return F.concat(*laid) if len(laid) > 1 else laid[0]


class BitTable:
    """Which hashes may be among some given ones, as a constant: each sets
    ``len(SHIFTS)`` bits of a table of 2^k."""

    def __init__(self, hashes: DataFrame, count: int):
        self.bits = min(MOST_BITS, 1 << max(10, ceil(log2(count + 1)) + 7))
        spots = hashes.select(F.explode(F.array(*[self._spot(F.col("seed"), s) for s in SHIFTS])).alias("spot"))
        words = spots.groupBy(F.expr("int(spot div 64)").alias("word"))
        found = dict(words.agg(F.expr("bit_or(shiftleft(1L, int(spot % 64)))")).collect())
        packed = ",".join(str(found.get(i, 0)) for i in range(self.bits // 64))
        self.words = F.split(F.lit(packed), ",").cast("array<bigint>")

    def _spot(self, seed: Column, shift: int) -> Column:
        return F.shiftrightunsigned(seed, shift).bitwiseAND(F.lit(self.bits - 1).cast("long"))

    def may_hold(self, seed: Column) -> Column:
        found = None
        for shift in SHIFTS:
            spot = self._spot(seed, shift)
            word = F.get(self.words, F.shiftright(spot, 6).cast("int"))
            bit = F.call_function("getbit", word, spot.bitwiseAND(F.lit(63)).cast("int")) == 1
            found = bit if found is None else found & bit
        return found


def _best_stretch(equal: Column, first: Column, length: Column) -> Column:
    """The best stretch of ``length`` aligned words as struct(same, minus_first):
    how many are equal, and the item's word where it begins, negated."""
    windows = F.transform(
        F.sequence(F.lit(0), F.size(equal) - length),
        lambda a: F.struct(
            F.aggregate(F.slice(equal, a + 1, length), F.lit(0), lambda n, x: n + x).alias("same"),
            (-a - first).alias("minus_first"),
        ),
    )
    return F.when(F.size(equal) >= length, F.array_max(windows))


def overlaps(
    texts: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text_column: str = "text",
) -> DataFrame:
    """(id, tag, item, start, stop, item_start, length, same): per text and item the
    best overlap, in words from 0; ties go to the earliest in the text.
    ``tag`` is the text's hash."""
    given = benchmark.select(benchmark[item_column].cast("long").alias("item"), benchmark[item_text_column].alias("own_text"))
    item_words = hashed(words_of(F.coalesce("own_text", F.lit(""))))
    items = materialize(with_once(given, "item_words", item_words).drop("own_text").where("size(item_words) > 0").distinct())
    short = [n for (n,) in items.where(F.size("item_words") < SHORTEST).select(F.size("item_words")).distinct().collect()]
    masks = [*MASKS, *(m for n in sorted(short) for m in short_masks(n))]
    # short items are hashed under masks of their length, others under the spaced ones
    laid = F.when(F.size("item_words") >= SHORTEST, _seeds(F.col("item_words"), list(MASKS)))
    for n in sorted(short):
        laid = laid.when(F.size("item_words") == n, _seeds(F.col("item_words"), short_masks(n)))
    seeds = materialize(items.select("item", F.explode(laid).alias("s")).select("item", F.col("s.at").alias("item_at"), "s.seed"))
    count = seeds.count()
    if not count:
        return texts.sparkSession.createDataFrame(
            [], "id long, tag long, item long, start int, stop int, item_start int, length int, same int"
        )
    table = BitTable(seeds, count)

    own = texts[text_column].cast("string")
    narrow = texts.select(texts[id_column].cast("long").alias("id"), F.xxhash64(own).alias("tag"), own.alias("own_text"))
    hashes = with_once(narrow, "words", hashed(words_of(F.coalesce("own_text", F.lit(""))))).drop("own_text")
    candidates = with_once(hashes, "hits", F.filter(_seeds(F.col("words"), masks), lambda s: table.may_hold(s["seed"])))
    # texts without a hit end here; the others are few and are kept with their words
    kept = materialize(candidates.where(F.size("hits") > 0).withColumn("row", F.xxhash64("id", "tag")))
    hits = kept.select("id", "row", F.explode("hits").alias("s")).select("id", "row", F.col("s.at").alias("at"), "s.seed")
    side = F.broadcast(seeds) if count <= BROADCAST_HASHES else seeds
    met = hits.join(side, "seed").select("id", "row", "item", (F.col("at") - F.col("item_at")).alias("diagonal")).distinct()
    aligned = met.join(kept.select("row", "tag", "words").dropDuplicates(["row"]), "row")
    aligned = aligned.join(F.broadcast(items) if count <= BROADCAST_HASHES else items, "item")
    aligned = aligned.withColumns({
        "length": F.least(F.size("item_words"), F.lit(WINDOW)),
        "first": F.greatest(F.lit(0), -F.col("diagonal")),
        "last": F.least(F.size("item_words"), F.size("words") - F.col("diagonal")) - 1,
    })
    # pairs run where both sides have words
    pairs = F.transform(
        F.sequence("first", "last"),
        lambda k: F.when(F.get(F.col("item_words"), k) == F.get(F.col("words"), k + F.col("diagonal")), 1).otherwise(0),
    )
    compared = with_once(aligned, "equal", pairs)
    checked = with_once(compared, "best", _best_stretch(F.col("equal"), F.col("first"), F.col("length")))
    found = checked.where(F.col("best.same") >= SIMILAR * F.col("length"))
    start = F.col("diagonal") - F.col("best.minus_first")
    ranked = found.groupBy("id", "row", "tag", "item").agg(
        F.max(
            F.struct(F.col("best.same").alias("same"), (-start).alias("minus_start"), F.col("best.minus_first").alias("minus_first"), "length")
        ).alias("b")
    )
    return ranked.select(
        "id", "tag", "item", (-F.col("b.minus_start")).alias("start"), (F.col("b.length") - F.col("b.minus_start")).alias("stop"),
        (-F.col("b.minus_first")).alias("item_start"), F.col("b.length").alias("length"), F.col("b.same").alias("same"),
    )


def without_overlaps(
    rows: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text_column: str = "text",
) -> DataFrame:
    """The rows, all columns kept, whose text overlaps with no benchmark item."""
    own = free_prefix("_leak_", rows.columns)
    found = overlaps(rows, benchmark, id_column, text_column, item_column, item_text_column)
    found = found.select(F.col("id").alias(own + "id"), F.col("tag").alias(own + "tag")).distinct()
    same = rows[id_column].cast("long").eqNullSafe(F.col(own + "id"))
    return rows.join(found, same & (F.xxhash64(rows[text_column].cast("string")) == F.col(own + "tag")), "left_anti")
