"""A training mix: sources at target weights, documents drawn by quality.

Each source gets a target number of words.  Whole epochs that fit into the
target take every document; what is left is an Efraimidis-Spirakis draw
without replacement: a document gets the exponential key -ln(u) / weight,
documents are ordered by it within their source, and the running total of
their sizes is cut at the budget.  The document at the cut is taken when that
brings the source nearer to its target.

u comes from a digest of the seed, the id and the size, so reruns agree.  No
source is sorted whole: keys fall into buckets of rising order, one sum per
source and bucket gives the running total at each bucket's ends, and only the
one bucket per source that holds the cut is sorted, over as many tasks as it
needs (``running_total``).

Awkward rows: a null text has size 0 and a document without words is taken
with 0 words; a null source is a source of its own, last in order; null ids
are drawn like others; repeated rows are documents of their own; a null weight
counts as 1, one of zero or less (or no number) goes behind all others.  Equal
keys go by id, size and place in the input.  Texts are counted whole, whatever
their length.  Further columns are only carried along if asked for.  An empty
table gives an empty mix; without any word all targets are 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trawl.llm.batches import free_name
from trawl.plans.lineage import materialize

WORD = r"[^\x20\x09-\x0D]+"
BUCKETS = 4096
#: Digits of the digest that make u: 13 hex digits are 52 bits.
DIGITS = 13
ROWS_A_TASK = 1 << 18


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def running_total(rows: DataFrame, group: str, order: list[str], value: str, name: str) -> DataFrame:
    """The rows with the sum of ``value`` over all rows before them in their group.

    Rows are dealt by ranges of (group, order), so a group may be spread over
    any number of tasks; sums per task and group give each its offset.  The
    order must tell all rows apart for a result that reruns repeat.
    """
    spark = rows.sparkSession
    keys = [group, *order]
    count = rows.count()
    tasks = max(-(-count // ROWS_A_TASK), min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // 256)), 1)
    dealt = materialize(
        rows.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys).withColumn("part", F.spark_partition_id())
    )
    before = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy(group, "part").agg(F.sum(value).alias("of_part"))
    offsets = sums.select(
        F.col(group).alias("offset_group"), F.col("part").alias("offset_part"),
        F.coalesce(F.sum("of_part").over(before(group).orderBy("part")), F.lit(0)).alias("offset"),
    )
    within = F.coalesce(F.sum(value).over(before("part", group).orderBy(*order)), F.lit(0))
    here = (F.col("part") == F.col("offset_part")) & (F.col(group) == F.col("offset_group"))
    return (
        dealt.withColumn("within", within).join(offsets, here)
        .withColumn(name, F.col("within") + F.col("offset"))
        .drop("part", "within", "offset", "offset_part", "offset_group")
    )


def targets(sources: DataFrame, weights: tuple[int, ...], share_percent: int, most_epochs: int) -> DataFrame:
    """(key, source_size, draw_weight) -> the same and ``target``.

    The weights repeat over the sources in order of their keys.  A target
    stops at ``most_epochs`` times its source; the excess goes to the others
    by weight until none is above.  Each round is one aggregate over the
    sources, and only its sums reach the driver.  All comparisons are of whole
    numbers; the target is one division.
    """
    spark = sources.sparkSession
    ranked = running_total(sources.withColumns({"all": F.lit(0), "one": F.lit(1)}), "all", ["key"], "one", "rank")
    listed = F.array(*[F.lit(w).cast("long") for w in weights])
    ranked = materialize(
        ranked.withColumn("weight", F.element_at(listed, (F.col("rank") % len(weights) + 1).cast("int")))
        .select("key", "source_size", "draw_weight", "weight")
    )
    wide = lambda c: c.cast("decimal(38,0)")
    exact = lambda n: F.lit(str(n)).cast("decimal(38,0)")
    total = int(ranked.agg(F.sum(wide(F.col("source_size")))).first()[0] or 0)
    capped, level = F.lit(False), None
    while True:
        full, weight = ranked.agg(
            F.sum(F.when(capped, wide(F.col("source_size")))), F.sum(F.when(~capped, wide(F.col("weight"))))
        ).first()
        # the others get (words that the capped ones leave) / (their weights), each times its weight
        now = share_percent * total - 100 * most_epochs * int(full or 0), 100 * int(weight or 0)
        if now[1] == 0 or now == level:
            break
        level = now
        capped = wide(F.col("weight")) * exact(level[0]) > wide(F.col("source_size")) * exact(most_epochs * level[1])
    cap = (F.col("source_size") * most_epochs).cast("double")
    if now[1] == 0:
        return ranked.withColumn("target", cap)
    share = F.col("weight").cast("double") * F.lit(float(level[0])) / F.lit(float(level[1]))
    return ranked.withColumn("target", F.when(capped, cap).otherwise(share))


def mix(
    rows: DataFrame, *, weights: tuple[int, ...] = (3, 1, 2), share_percent: int = 150, most_epochs: int = 2,
    seed: str = "", id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
    quality: DataFrame | None = None, keep: tuple[str, ...] = (),
) -> DataFrame:
    """(id, source, size, source_size, target, copies, taken), one row a document.

    ``copies`` is how often the mix takes the document, ``taken`` its words
    with repeats.  ``quality`` is a table (id, weight); several weights of an
    id count as their mean.  ``keep`` names columns to carry along; one whose
    name is taken gets underscores in front.
    """
    if not weights or min(weights) < 1 or share_percent > 100 * most_epochs:
        raise ValueError("weights of 1 or more, and a share that the epochs can fill")
    kept = [f"kept_{i}" for i in range(len(keep))]
    narrow = rows.select(
        rows[id_column].cast("long").alias("id"), rows[source_column].cast("string").alias("source"),
        n_words(rows[text_column].cast("string")).alias("size"),
        *[rows[c].alias(k) for c, k in zip(keep, kept)],
    )
    if quality is None:
        narrow = narrow.withColumn("draw_weight", F.lit(1.0))
    else:
        given = quality.select(F.col("id").cast("long").alias("id"), F.col("weight").cast("double").alias("weight"))
        given = given.where("id IS NOT NULL").groupBy("id").agg(F.avg("weight").alias("weight"))
        narrow = narrow.join(given, "id", "left").withColumn("draw_weight", F.coalesce("weight", F.lit(1.0)))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.col("size")))
    u = (F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("long") + 1).cast("double") / float(1 << 4 * DIGITS)
    sound = (F.col("draw_weight") > 0) & ~F.isnan("draw_weight") & (F.col("draw_weight") < float("inf"))
    docs = materialize(narrow.select(
        "id", "source", "size", *kept, F.when(sound, F.col("draw_weight")).alias("draw_weight"),
        # null sources last, in order of the code points
        F.concat(F.when(F.col("source").isNull(), "1").otherwise("0"), F.coalesce("source", F.lit(""))).alias("key"),
        F.when(sound, -F.ln(u) / F.col("draw_weight")).otherwise(F.lit(float("inf"))).alias("arrival"),
        F.monotonically_increasing_id().alias("place"),
    ))
    sources = docs.groupBy("key").agg(F.sum("size").alias("source_size"), F.avg("draw_weight").alias("draw_weight"))
    size, target = F.col("source_size"), F.col("target")
    epochs = F.when(size > 0, F.floor(target / size)).otherwise(F.lit(0)).cast("long")
    plans = materialize(
        targets(sources, weights, share_percent, most_epochs)
        .select("key", "source_size", "target", F.coalesce("draw_weight", F.lit(1.0)).alias("rate"), epochs.alias("epochs"))
        .withColumn("budget", target - (F.col("epochs") * size).cast("double"))
    )
    # of keys with the source's mean weight, each bucket would hold the same share
    share = F.lit(1.0) - F.exp(-F.col("arrival") * F.col("rate"))
    bucket = F.least(F.floor(share * BUCKETS), F.lit(BUCKETS)).cast("int")
    placed = docs.drop("draw_weight").join(plans, "key").withColumn("bucket", bucket)
    sums = placed.groupBy("key", "bucket").agg(F.sum("size").alias("of_bucket"), F.first("budget").alias("budget"))
    ends = F.sum("of_bucket").over(Window.partitionBy("key").orderBy("bucket"))
    # all of the buckets before the cut, none of those behind it
    cuts = materialize(
        sums.withColumn("ends", ends).where("ends > budget AND budget > 0")
        .groupBy("key").agg(F.min(F.struct("bucket", (F.col("ends") - F.col("of_bucket")).alias("starts"))).alias("first"))
        .select("key", F.col("first.bucket").alias("cut"), F.col("first.starts").alias("starts"))
    )
    told = placed.join(cuts, "key", "left")
    at_cut = F.col("bucket") == F.col("cut")
    before_cut = (F.col("budget") > 0) & (F.col("cut").isNull() | (F.col("bucket") < F.col("cut")))
    settled = told.where(F.coalesce(~at_cut, F.lit(True))).withColumn("drawn", before_cut)
    counted = running_total(told.where(at_cut), "key", ["arrival", "id", "size", "place"], "size", "before")
    left = F.col("budget") - (F.col("starts") + F.col("before")).cast("double")
    at_end = counted.withColumn("drawn", (left > 0) & (left * 2 >= F.col("size")))
    columns = ["id", "source", "size", "source_size", "target", "epochs", "drawn", *kept]
    drawn = settled.select(*columns).unionByName(at_end.select(*columns))
    copies = F.col("epochs") + F.col("drawn").cast("long")
    out = ["id", "source", "size", "source_size", "target"]
    names: list[str] = [*out, "copies", "taken"]
    shown = []
    for column, inner in zip(keep, kept):
        names.append(free_name(column, names))
        shown.append(F.col(inner).alias(names[-1]))
    return drawn.select(*out, copies.alias("copies"), (copies * F.col("size")).alias("taken"), *shown)


def mixture(rows: DataFrame, text_column: str = "text", **options) -> DataFrame:
    """The mix itself: one row for each time a document is taken, with its text and epoch."""
    drawn = mix(rows, text_column=text_column, keep=(text_column,), **options)
    text = drawn.columns[-1]
    return drawn.where("copies > 0").select(
        "id", "source", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("epoch"), F.col(text).alias("text")
    )
