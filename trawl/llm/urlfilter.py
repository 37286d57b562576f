"""URL filter rules held in Bloom filter cascades.

A rule is a host and the beginning of a path in one string, like
``example.net/en/``.  It fits its host and all subdomains where the url's path
begins with the rule's.  The keys a url can match are its host's suffixes,
label by label, each with every rule length of its path's beginning; all keys
of all urls are the universe.

The cascade's first filter holds the listed keys, the second those keys of the
universe that pass the first though unlisted, the third the listed keys that
pass the second, and so on until a filter lets nothing false through.  Within
the universe, membership is then exact: the first filter that a key fails
tells on which side it is.  Filters are constants of the query plan, so urls
are judged where they are read, without a join.  Together they hold a few bits
a listed key; beyond ``MOST_BITS`` the listed keys are joined instead.

A url without ``://`` and a null one have empty host and path and match
nothing.  Rules that are null or have no host are ignored; a rule listed both
ways blocks.  Of fitting rules the longest wins, of equally long ones the last
in the alphabet; without one the verdict is ``default``.  Repeated rows are
judged each for itself, an empty table gives an empty result, and further
columns are ignored.
"""

from __future__ import annotations

from math import ceil, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.llm.once import with_once
from trawl.plans.lineage import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bits of all filters of a cascade that may stand in a plan (512 kB).
MOST_BITS = 1 << 22
WORD_BITS = 64
#: Share of false keys that later filters let through.
LATER_RATE = 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    begins = F.locate("://", url)
    rest = F.when(begins > 0, F.substring(url, begins + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def keys_of(host: Column, path: Column, lengths: list[int]) -> Column:
    """All keys under which a rule could fit."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    beginnings = F.array_compact(
        F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths] or [F.lit(None).cast("string")])
    )
    return F.flatten(F.transform(suffixes, lambda s: F.transform(beginnings, lambda b: F.concat(s, b))))


class Filter:
    """One Bloom filter, as a constant."""

    def __init__(self, keys: DataFrame, count: int, rate: float, level: int):
        self.level = level
        self.bits = WORD_BITS * ceil(max(count, 1) * -log(rate) / log(2) ** 2 / WORD_BITS)
        self.hashes = max(1, round(self.bits / max(count, 1) * log(2)))
        spots = F.explode(F.array(*[self._spot(F.col("key"), i) for i in range(self.hashes)]))
        words = keys.select(spots.alias("spot")).groupBy(F.expr(f"int(spot div {WORD_BITS})").alias("word"))
        # at most bits / 64 rows
        found = dict(words.agg(F.expr(f"bit_or(shiftleft(1L, int(spot % {WORD_BITS})))")).collect())
        self.words = F.split(
            F.lit(",".join(str(found.get(i, 0)) for i in range(self.bits // WORD_BITS))), ","
        ).cast("array<bigint>")

    def _spot(self, key: Column, i: int) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(self.level), F.lit(i)), F.lit(self.bits).cast("long"))

    def passes(self, key: Column) -> Column:
        """False for no key that was put in."""
        found = None
        for i in range(self.hashes):
            spot = self._spot(key, i)
            word = F.get(self.words, F.floor(spot / WORD_BITS).cast("int"))
            bit = F.call_function("getbit", word, F.pmod(spot, F.lit(WORD_BITS)).cast("int")) == 1
            found = bit if found is None else found & bit
        return found


def size_of(listed: int, universe: int) -> tuple[float, int]:
    """The first filter's rate that keeps all filters together smallest, and their bits."""
    rate = min(LATER_RATE, max(1e-9, LATER_RATE**0.5 * listed / max(universe, 1)))
    return rate, ceil(listed * (-log(rate) / log(2) ** 2 + 6) + 4 * WORD_BITS)


class Cascade:
    """Exact membership of ``listed`` (key) among the keys of ``universe`` (key).

    ``universe`` may hold keys again and again; it is read once for its size
    and once for the keys that pass the first filter.
    """

    def __init__(self, listed: DataFrame, universe: DataFrame):
        self.listed = materialize(listed.select("key").where("key IS NOT NULL").distinct())
        self.filters: list[Filter] = []
        count = self.listed.count()
        rate, bits = size_of(count, universe.agg(F.approx_count_distinct("key")).first()[0])
        self.joined = bits > MOST_BITS
        if self.joined or not count:
            return
        inside, outside = self.listed, universe
        while count:
            added = Filter(inside, count, rate, len(self.filters))
            self.filters.append(added)
            passing = outside.where(added.passes(F.col("key"))).distinct()
            if len(self.filters) == 1:
                passing = passing.join(self.listed, "key", "left_anti")
            inside, outside = materialize(passing), inside
            count, rate = inside.count(), LATER_RATE

    def holds(self, key: Column) -> Column:
        """True for listed keys, for a key of the universe."""
        answer = F.lit(len(self.filters) % 2 == 1)
        for level in range(len(self.filters) - 1, -1, -1):
            answer = F.when(self.filters[level].passes(key), answer).otherwise(F.lit(level % 2 == 1))
        return answer


def _longest(keys: Column) -> Column:
    return F.array_max(F.transform(keys, lambda k: F.struct(F.length(k).alias("n"), k.alias("rule")))).getField("rule")


def judge_urls(
    rows: DataFrame, rules: DataFrame, id_column: str = "page_id", url_column: str = "url", default: str = "allow"
) -> DataFrame:
    """(id, host, path, rule, verdict) per row; ``rules`` has rule and verdict (allow or block)."""
    listed = rules.where("rule IS NOT NULL AND verdict IN ('allow', 'block') AND rule NOT LIKE '/%' AND rule <> ''")
    listed = materialize(listed.groupBy(F.col("rule").alias("key")).agg(F.max(F.col("verdict") == "block").alias("blocks")))
    slash = F.locate("/", F.col("key"))
    beginning = F.when(slash > 0, F.length("key") - slash + 1).otherwise(0)
    lengths = sorted(n for (n,) in listed.select(beginning.cast("int")).distinct().collect())
    host, path = host_and_path(rows[url_column])
    urls = rows.select(rows[id_column].alias("id"), host.alias("host"), path.alias("path"))
    keyed = with_once(urls, "keys", keys_of(F.col("host"), F.col("path"), lengths))
    rule_cascade = Cascade(listed, keyed.select(F.explode("keys").alias("key")))
    block_cascade = Cascade(listed.where("blocks"), listed)
    if rule_cascade.joined or block_cascade.joined:
        return _joined(keyed, listed, default)
    found = with_once(keyed, "rule", _longest(F.filter("keys", rule_cascade.holds)))
    blocked = F.when(F.col("rule").isNull(), F.lit(default)).when(block_cascade.holds(F.col("rule")), "block")
    return found.select("id", "host", "path", "rule", blocked.otherwise("allow").alias("verdict"))


def _joined(keyed: DataFrame, listed: DataFrame, default: str) -> DataFrame:
    """The same where the list is too long for constants: listed keys of the
    universe are found by one join on distinct keys, then again by url."""
    keys = keyed.select(F.explode("keys").alias("key")).distinct().join(listed, "key")
    numbered = keyed.withColumn("url_keys", F.array_distinct("keys")).withColumn("at", F.xxhash64("host", "path"))
    sides = numbered.select("host", "path", F.explode("url_keys").alias("key")).distinct().join(keys, "key")
    best = sides.groupBy("host", "path").agg(
        F.max(F.struct(F.length("key").alias("n"), F.col("key").alias("rule"), "blocks")).alias("best")
    )
    found = keyed.join(best, ["host", "path"], "left")
    verdict = F.when(F.col("best").isNull(), F.lit(default)).when(F.col("best.blocks"), "block").otherwise("allow")
    return found.select("id", "host", "path", F.col("best.rule").alias("rule"), verdict.alias("verdict"))
