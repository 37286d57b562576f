"""Repeated lines removed: every unit of text stays where it stands first.

Units are of two levels.  A whole line, of any length and at any place, is
one; as passages are often pasted within a line, its sentences are units too.
A unit is normalised (lower case, single blanks) and hashed to 128 bits.  Of
all units with one digest, in the whole corpus, the first stays, by the order
of ids and places; the rest are removed.  What a digest's group sends on is its
first place, combined ahead of the shuffle, so that no task gathers a group.

Short sentences ("Of it.") repeat by chance.  One of fewer than ``MIN_WORDS``
words is hashed together with as many units before it as make up that number,
so it goes only where these stand again too.  Where its own line does not
reach back that far, it is hashed with its whole line as well.  So a line that
stands again goes with all its sentences, blanks between them aside.

Texts are read whole, whatever their length; a very long one takes its
task memory in proportion.  Null and empty texts have no units.  Null ids come last in the order.  Rows
with one id and equal texts count as one text and share their removals.  An
empty table gives an empty result.  ``remove_spans`` keeps all columns of its
input, whatever their names.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.batches import filled, free_name, free_prefix, narrowed, quoted, slices
from trawl.plans.lineage import materialize

CUT = re.compile(r"[.!?…][\"'”’»)\]]*\s+|\n+")
#: A character that is no white space, by Python's rule for the cut units.
INK = r"(?U)[^\s\x1c-\x1f]"
MIN_WORDS = 8
UNITS = "id long, tag long, start int, stop int, high long, low long"


def units_of(text: str, min_words: int = MIN_WORDS) -> list[tuple[int, int, bytes]]:
    """(start, stop, digest) of the units that may be removed; offsets in
    characters.  A sentence may stand twice, by its line and by what is before it."""
    out = []
    first = 0
    line: list[tuple[int, int, int, str]] = []  # start, stop, words and text of the line's sentences
    before: list[tuple[int, str]] = []  # words and text of earlier units, as many as short ones need
    digest = xxhash.xxh3_128_digest
    for cut in [*(m.end() for m in CUT.finditer(text)), len(text)]:
        piece = text[first:cut]
        words = piece.lower().split()
        if words:
            start = first + len(piece) - len(piece.lstrip())
            line.append((start, first + len(piece.rstrip()), len(words), " ".join(words)))
        first = cut
        if not line or cut < len(text) and "\n" not in piece:
            continue
        whole = " ".join(unit for *_, unit in line)
        reach = 0
        for place, (start, stop, count, unit) in enumerate(line):
            reach += count
            if reach < min_words:
                # no other key has an empty line in it
                out.append((start, stop, digest(f"{whole}\n\n{place}" if len(line) > 1 else whole)))
            key, total = unit, count
            if total < min_words:
                for more, earlier in reversed(before):
                    key, total = f"{earlier}\n{key}", total + more
                    if total >= min_words:
                        break
            if total >= min_words:
                out.append((start, stop, digest(key)))
            before = [*before[-min_words:], (count, unit)]
        line = []
    return out


def repeated_units(rows: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(id, tag, start, stop, high, low, kept_id, kept_start): a row per unit to
    remove, with the place of the one that stays.  ``tag`` is the text's hash.
    Of a sentence that stood before by its line and by what is ahead of it, the
    earlier place is shown."""
    kept = F.struct(F.col("kept.no_id").alias("no_id"), "kept_id", F.col("kept.tag").alias("kept_tag"), "kept_start", "high", "low")
    spans = _repeats(rows, id_column, text_column, min_words).groupBy("id", "tag", "start", "stop").agg(F.min(kept).alias("first"))
    return spans.select("id", "tag", "start", "stop", "first.high", "first.low", "first.kept_id", "first.kept_start")


def _repeats(rows: DataFrame, id_column: str, text_column: str, min_words: int = MIN_WORDS) -> DataFrame:
    """A row per digest that stood before; a span may have two."""

    def run(batches):
        for piece in slices(batches):
            found = [units_of(t, min_words) for t in filled(piece.column("text"))]
            counts = list(map(len, found))
            flat = [u for units in found for u in units]
            digests = np.frombuffer(b"".join(u[2] for u in flat), dtype="<i8").reshape(-1, 2)
            take = pa.array(np.repeat(np.arange(len(counts)), counts))
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("id").take(take), piece.column("tag").take(take),
                    pa.array([u[0] for u in flat], pa.int32()), pa.array([u[1] for u in flat], pa.int32()),
                    pa.array(digests[:, 0]), pa.array(digests[:, 1]),
                ],
                ["id", "tag", "start", "stop", "high", "low"],
            )

    tagged = narrowed(rows, id_column, text_column).withColumn("tag", F.xxhash64("text"))
    units = materialize(tagged.mapInArrow(run, UNITS))
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "tag", "start")
    firsts = units.groupBy("high", "low").agg(F.min(place).alias("kept"), F.count("*").alias("times"))
    firsts = materialize(firsts.where("times > 1").drop("times"))
    return (
        units.join(firsts, ["high", "low"])
        .where(~place.eqNullSafe(F.col("kept")))
        .select("id", "tag", "start", "stop", "high", "low", "kept", F.col("kept.id").alias("kept_id"), F.col("kept.start").alias("kept_start"))
    )


def _cut(rows: DataFrame, spans: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``remove_spans``, with a last column that tells whether anything was cut."""
    own = free_prefix("_units_", rows.columns)
    gone = spans.groupBy(F.col("id").alias(own + "id"), F.col("tag").alias(own + "tag")).agg(
        F.array_sort(F.collect_set(F.struct("start", "stop"))).alias(own + "gone")
    )
    text = rows[text_column]
    joined = rows.join(
        gone, rows[id_column].cast("long").eqNullSafe(F.col(own + "id")) & (F.xxhash64(text.cast("string")) == F.col(own + "tag")), "left"
    )
    spots = F.col(own + "gone")
    # a stretch runs from one removed span's stop to the next one's start
    stretches = F.transform(
        F.sequence(F.lit(0), F.size(spots)),
        lambda i: F.struct(
            F.when(i == 0, 0).otherwise(F.get(spots, i - 1)["stop"]).alias("start"),
            F.coalesce(F.get(spots, i)["start"], F.length(text)).alias("stop"),
        ),
    )
    kept = F.filter(stretches, lambda s: s["start"] < s["stop"])
    whole = F.when(F.length(text) > 0, F.array(F.struct(F.lit(0).alias("start"), F.length(text).alias("stop"))))
    left = F.array_join(F.transform(kept, lambda s: F.substring(text, s["start"] + 1, s["stop"] - s["start"])), "")
    cut = F.when(spots.isNull(), text).otherwise(left).alias(text_column)
    columns = [cut if c == text_column else quoted(rows, c) for c in rows.columns]
    added = free_name("kept_spans", rows.columns)
    touched = free_name(own + "touched", rows.columns)
    return joined.select(*columns, F.when(spots.isNull(), whole).otherwise(kept).alias(added), spots.isNotNull().alias(touched))


def remove_spans(rows: DataFrame, spans: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows with the spans (id, tag, start, stop) cut out of their text, and
    ``kept_spans``: where in the original each remaining stretch stood (with
    underscores in front where the name is taken)."""
    cut = _cut(rows, spans, id_column, text_column)
    return cut.drop(cut.columns[-1])


def without_repeats(rows: DataFrame, id_column: str = "doc_id", text_column: str = "text", size_column: str | None = None) -> DataFrame:
    """The rows, all columns kept, without their repeated units; texts that were
    cut and have nothing but white space left go.  ``size_column`` is set to the new length."""
    cut = _cut(rows, _repeats(rows, id_column, text_column), id_column, text_column)
    spots, touched = cut.columns[-2:]
    text = F.col(text_column)
    changed = cut.where(~F.col(touched) | text.rlike(INK)).drop(spots, touched)
    if size_column in rows.columns:
        kind = rows.schema[size_column].dataType
        changed = changed.withColumn(size_column, F.when(text.isNull(), F.col(size_column)).otherwise(F.length(text)).cast(kind))
    return changed
