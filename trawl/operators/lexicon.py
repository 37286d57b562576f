"""From texts to lexemes with positions.

Two analyzers: ``simple`` takes lower-case words as they are, ``english`` drops
stop words (their positions stay counted) and stems.  All words of a text are
in one row, so postings are made where the text is read: each Arrow batch stems
its distinct words once and groups positions, and nothing is shuffled.
``simple_kinds`` and ``english_kinds`` keep addresses, urls, decimals and
hyphenated words whole, the latter with their parts behind them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.functions.stemming import STOP_WORDS, english_stem, stem_word
from trawl.functions.text import WHOLE_MARKS, word_kinds, words
from trawl.plans.sizing import join_checked

#: Words that a task's Python works on at a time; a batch of long texts has many more.
SLICE_WORDS = 1 << 18


@dataclass(frozen=True)
class Analyzer:
    name: str
    stop_words: tuple[str, ...] = ()
    stems: bool = False
    kinds: bool = False

    def words(self, text: Column) -> Column:
        """The words of a text in order, those of other kinds kept whole if asked for."""
        return word_kinds(text) if self.kinds else words(text)

    def lexemes(self, vocabulary: DataFrame) -> DataFrame:
        """(word, lexeme) for a one-column table of distinct ``word``s."""
        kept = vocabulary.where(~F.col("word").isin(*self.stop_words)) if self.stop_words else vocabulary
        if not self.stems:
            return kept.withColumn("lexeme", F.col("word"))
        # of a hyphenated word the last part is stemmed; other kinds stay as they are
        last = F.substring_index("word", "-", -1)
        head = F.col("word").substr(F.lit(1), F.length("word") - F.length(last))
        return kept.withColumn(
            "lexeme", F.when(F.col("word").rlike(WHOLE_MARKS), F.col("word")).otherwise(F.concat(head, english_stem(last)))
        )

    def lexeme(self, word: str) -> str | None:
        """The lexeme of one word, None for a stop word."""
        if word in self.stop_words:
            return None
        if not self.stems or re.search(WHOLE_MARKS, word):
            return word
        head, hyphen, last = word.rpartition("-")
        return head + hyphen + stem_word(last)


SIMPLE = Analyzer("simple")
ENGLISH = Analyzer("english", STOP_WORDS, stems=True)
SIMPLE_KINDS = Analyzer("simple_kinds", kinds=True)
ENGLISH_KINDS = Analyzer("english_kinds", STOP_WORDS, stems=True, kinds=True)
ANALYZERS = {a.name: a for a in (SIMPLE, ENGLISH, SIMPLE_KINDS, ENGLISH_KINDS)}


def analyzer(name: str | Analyzer) -> Analyzer:
    if isinstance(name, Analyzer):
        return name
    if name not in ANALYZERS:
        raise ValueError(f"unknown analyzer {name!r}; choose from {sorted(ANALYZERS)}")
    return ANALYZERS[name]


def occurrences(texts: DataFrame, text: str = "text", key: str = "id", kind: str | Analyzer = SIMPLE) -> DataFrame:
    """(key, pos, word) for every word of every text; positions from 1."""
    held = F.posexplode(analyzer(kind).words(F.col(text))).alias("pos", "word")
    return texts.select(key, held).withColumn("pos", F.col("pos") + 1)


def slices(batches: Iterator[pa.RecordBatch], words: int = SLICE_WORDS) -> Iterator[pa.RecordBatch]:
    """Batches of (key, words) cut after at most so many words, or after one row."""
    for batch in batches:
        ends = batch.column(1).offsets.to_numpy()
        start = 0
        while start < batch.num_rows:
            stop = max(int(np.searchsorted(ends, ends[start] + words, side="right")) - 1, start + 1)
            yield batch.slice(start, stop - start)
            start = stop


def _stable_order(codes: np.ndarray) -> np.ndarray:
    """A stable argsort of numbers below 2 ** 32 by their halves, which numpy sorts by radix."""
    order = np.argsort((codes & 0xFFFF).astype(np.uint16), kind="stable")
    high = (codes >> 16).astype(np.uint16)
    return order[np.argsort(high[order], kind="stable")] if high.any() else order


def _ranked(found: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct values in order, and of each value its place there, -1 for NULL.

    Strings go by their UTF-8 bytes, as they do in the tables.
    """
    coded = found.dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    known = coded.indices.is_valid().to_numpy(zero_copy_only=False)
    at = coded.indices.fill_null(0).to_numpy(zero_copy_only=False)
    return coded.dictionary.take(order), np.where(known, rank[at] if len(rank) else -1, -1)


def _grouped(kind: Analyzer, by_lexeme: bool = False):
    """An Arrow kernel from (id, words) to (id, lexeme, positions), row by row.

    ``by_lexeme`` each slice comes out in the order of its lexemes: a table that
    is sorted by them afterwards has a few long runs to merge.
    """
    as_they_are = not (kind.stop_words or kind.stems)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            held = batch.column(1)
            flat = held.flatten().dictionary_encode()
            spelled = flat.dictionary
            found = spelled if as_they_are else pa.array([kind.lexeme(w) for w in spelled.to_pylist()], pa.string())
            names, of_word = _ranked(found)
            lexeme = of_word[flat.indices.to_numpy(zero_copy_only=False)]
            sizes = np.diff(held.offsets.to_numpy())
            row = np.repeat(np.arange(len(sizes)), sizes)
            pos = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1
            kept = lexeme >= 0
            lexeme, row, pos = lexeme[kept], row[kept], pos[kept]
            # stable: the rows of a lexeme, and its positions in a row, stay in order
            order = _stable_order(lexeme) if by_lexeme else np.argsort(row * len(names) + lexeme, kind="stable")
            lexeme, row, pos = lexeme[order], row[order], pos[order]
            first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (lexeme[1:] != lexeme[:-1])][: len(row)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row[first])),
                    names.take(pa.array(lexeme[first])),
                    pa.ListArray.from_arrays(pa.array(np.r_[first, len(row)], pa.int32()), pa.array(pos, pa.int32())),
                ],
                names=["id", "lexeme", "positions"],
            )

    return kernel


def postings(texts: DataFrame, kind: str | Analyzer = "english", *, by_lexeme: bool = False) -> DataFrame:
    """(id, lexeme, positions): the inverted table of all texts, in one scan.

    ``by_lexeme`` suits a table that is to be sorted by lexeme.
    """
    a = analyzer(kind)
    held = texts.select(F.col("id").cast("string").alias("id"), a.words(F.col("text")).alias("words"))
    return held.mapInArrow(_grouped(a, by_lexeme), "id string, lexeme string, positions array<int>")


def matching_positions(texts: DataFrame, wanted: DataFrame, kind: str | Analyzer = "english") -> DataFrame:
    """``postings`` of the ``wanted`` lexemes only, one ``lexeme`` per row.

    Lexemes that cannot match are dropped where they are made, so only hits
    are ever shuffled.
    """
    a = analyzer(kind)
    if a.stems:
        return join_checked(postings(texts, a), wanted, "lexeme", spread="id")
    spelled = a.lexemes(wanted.select(F.col("lexeme").alias("word")))
    hits = join_checked(occurrences(texts, kind=a), spelled, "word", spread="id")
    return (
        hits.repartition("id").groupBy("id", "lexeme").agg(F.sort_array(F.collect_set("pos")).alias("positions"))
    )


def document_frequencies(table: DataFrame) -> DataFrame:
    """(lexeme, texts): in how many texts each lexeme of a postings table is."""
    return table.groupBy("lexeme").agg(F.count("*").alias("texts"))
