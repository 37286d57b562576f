"""Token ids in files compressed by Re-Pair grammars.

Texts go to tasks by ranges of their id, in order.  A task encodes its texts
with a tokenizer of the tokenizers library, appends the end id to each and
cuts the ids into shards of whole documents.  In each shard, frequent pairs of
neighbouring symbols are replaced by new symbols again and again, the most
frequent pairs first, until no pair stands twice.  A round replaces pairs that
stand about equally often; where they overlap the more frequent one wins, and
one that stands less often by that waits for a later round.  Places and numbers
of all pairs are kept, and a round changes them beside replaced places only.
A shard is a row of a Parquet table: the rules, the length that every rule
expands to, the remaining symbols, and where each document begins.  Symbols
have the bits they need.  With the lengths any stretch of ids is decoded alone.

Texts are read whole, whatever their length; a very long one takes its
task memory in proportion.  Null and empty texts have the end id only.  Null ids come first; rows with one
id are ordered by a hash of their text, and equal rows stand side by side.  An
empty table writes files without rows.  Further columns are ignored.
"""

from __future__ import annotations

import os
import re
import string
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trawl.llm.batches import WordMemo, narrowed, no_collection, ragged, slices

SHARD_IDS = 1 << 20
#: Bytes of text encoded at a time.
ENCODED_BYTES = 6 << 20
MIN_PAIRS = 2
#: A round replaces all pairs that stand at least this share of the most frequent one's times.
ROUND_SHARE = 0.9
#: Runs of marks whose ids are remembered.
MARKS_KEPT = 10_000
#: Words without their marks whose ids are remembered.
BODIES_KEPT = 200_000
MAGIC = b"RPG2"
#: Magic, alphabet, rules, symbols, bits a symbol.
HEAD = "<4sIQQB"
#: Lengths from here on have eight bytes behind the others, which have one.
LONG_RULE = 255

FILES = (
    "part int, shard int, start_in_part long, n_ids long, doc_ids array<long>, doc_sizes array<int>, grammar binary"
)

# -- grammar ------------------------------------------------------------------


def _grouped(left: np.ndarray, right: np.ndarray, n_symbols: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order that puts equal pairs side by side, earlier ones first, and
    where groups begin and how many they have."""
    bits, place = int(n_symbols).bit_length(), len(left).bit_length()
    keys = left.astype(np.uint64) << np.uint64(bits) | right.astype(np.uint64)
    if 2 * bits + place <= 64:
        # sorting the numbers themselves is several times as fast as sorting their places
        keys = np.sort(keys << np.uint64(place) | np.arange(len(keys), dtype=np.uint64))
        order = (keys & np.uint64((1 << place) - 1)).astype(np.int64)
        keys >>= np.uint64(place)
    else:
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, dtype=np.int64)
    return order, first, np.diff(np.r_[first, len(keys)])


def _apart(again: np.ndarray) -> np.ndarray:
    """Which places count, where ``again`` tells that a place's pair overlaps
    with an equal one before it: every other one of a run, from the left."""
    alone = np.ones(len(again), dtype=bool)
    at = np.flatnonzero(again)
    if len(at):
        begin = np.r_[True, np.diff(at) != 1]
        run = np.maximum.accumulate(np.where(begin, np.arange(len(at)), 0))
        alone[at[(np.arange(len(at)) - run) % 2 == 0]] = False
    return alone


def _settled(touch: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Which hits are replaced: of overlapping ones the more frequent pair's.
    ``touch`` tells of each hit but the last whether it overlaps with the next."""
    taken = np.zeros(len(rank), dtype=bool)
    left = np.arange(len(rank))
    while len(left):
        r = rank[left]
        meets = (np.diff(left) == 1) & touch[left[:-1]]
        wins = np.r_[True, ~meets | (r[1:] < r[:-1])] & np.r_[~meets | (r[:-1] <= r[1:]), True]
        taken[left[wins]] = True
        out = wins.copy()
        out[1:] |= meets & wins[:-1]
        out[:-1] |= meets & wins[1:]
        left = left[~out]
    return taken


class _Pairs:
    """The pairs of a chain of symbols that stand twice or more: how often each
    stands, and where.

    A new pair has a symbol of the round that made it, so all its places are
    made in that round: they are kept side by side, and a pair that stands once
    never comes to stand twice.  A place that went is told by ``at``, the number
    of the pair that begins at a place now.
    """

    def __init__(self, length: int):
        self.at = np.full(length + 1, -1, dtype=np.int32)
        self.n = self.held = 0
        self.times, self.first, self.given = (np.zeros(1024, dtype=np.int32) for _ in range(3))
        self.places = np.zeros(1024, dtype=np.int32)

    @staticmethod
    def _room(array: np.ndarray, size: int) -> np.ndarray:
        if size <= len(array):
            return array
        return np.concatenate([array, np.zeros(max(size, 2 * len(array)) - len(array), dtype=array.dtype)])

    def add(self, places: np.ndarray, left: np.ndarray, right: np.ndarray, n_symbols: int) -> None:
        order, first, times = _grouped(left, right, n_symbols)
        often = times >= MIN_PAIRS
        first, times = first[often], times[often]
        found = places[order[ragged(first, times)]]
        n, held = self.n + len(times), self.held + len(found)
        self.times, self.first, self.given = (self._room(x, n) for x in (self.times, self.first, self.given))
        self.places = self._room(self.places, held)
        self.times[self.n : n] = self.given[self.n : n] = times
        self.first[self.n : n] = self.held + np.cumsum(times) - times
        self.places[self.held : held] = found
        self.at[found] = np.repeat(np.arange(self.n, n, dtype=np.int32), times)
        self.n, self.held = n, held

    def replace(self, chosen: np.ndarray, rank: np.ndarray, hits: np.ndarray, second: np.ndarray, ahead: np.ndarray) -> None:
        """The pairs at hits go, and those that begin within them or ahead of them."""
        self.times[chosen] -= np.bincount(rank, minlength=len(chosen)).astype(np.int32)
        beside = np.concatenate([second, ahead])
        gone = self.at[beside]
        gone = gone[gone >= 0]
        if 8 * len(gone) > self.n:
            self.times[: self.n] -= np.bincount(gone, minlength=self.n).astype(np.int32)
        else:
            np.subtract.at(self.times, gone, 1)
        self.at[beside] = self.at[hits] = -1

    def frequent(self) -> tuple[np.ndarray, float]:
        """The pairs to replace in this round, most frequent first, and the times each must stand."""
        times = self.times[: self.n]
        least = max(MIN_PAIRS, ROUND_SHARE * times.max(initial=0))
        chosen = np.flatnonzero(times >= least)
        return chosen[np.argsort(-times[chosen], kind="stable")], least

    def hits(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, rank in ``chosen``) of all places of the chosen pairs, from the left."""
        if len(chosen) == 1:
            first = self.first[chosen[0]]
            places = self.places[first : first + self.given[chosen[0]]].astype(np.int64)
            places = places[self.at[places] == chosen[0]]
            return places, np.zeros(len(places), dtype=np.int64)
        given = self.given[chosen].astype(np.int64)
        places = self.places[ragged(self.first[chosen].astype(np.int64), given)].astype(np.int64)
        there = self.at[places] == np.repeat(chosen.astype(np.int32), given)
        rank = np.repeat(np.arange(len(chosen)), given)
        both = np.sort(places[there] << 32 | rank[there])
        return both >> 32, both & 0xFFFFFFFF


def _replaced(symbols: np.ndarray, n_symbols: int, lefts: list[np.ndarray], rights: list[np.ndarray]) -> np.ndarray:
    """The symbols when all pairs that stand twice are replaced; their rules are
    added to ``lefts`` and ``rights``.  After the first count, work goes in
    proportion to the places that are replaced."""
    length = len(symbols)
    if length < 2:
        return symbols
    # a chain with one place beyond its end, which stands before its beginning too
    after = np.arange(1, length + 2, dtype=np.int32)
    before = np.arange(-1, length, dtype=np.int32)
    before[0] = length
    symbols = np.r_[symbols, 0].astype(np.uint32)
    pairs = _Pairs(length)
    places = np.arange(length - 1, dtype=np.int32)
    left, right = symbols[: length - 1], symbols[1:length]
    alone = _apart(np.r_[False, (left[1:] == left[:-1]) & (right[1:] == right[:-1])])
    pairs.add(places[alone], left[alone], right[alone], n_symbols)
    while True:
        chosen, least = pairs.frequent()
        if not len(chosen):
            return symbols[:-1][after[:-1] >= 0].astype(np.int64)
        hits, rank = pairs.hits(chosen)
        taken = _settled(after[hits[:-1]] == hits[1:], rank)
        # a pair that others took places from waits until it is counted again
        held = np.bincount(rank[taken], minlength=len(chosen)) >= least
        taken &= held[rank]
        hits, rank = hits[taken], rank[taken]
        second = after[hits].astype(np.int64)
        one = np.zeros(len(chosen), dtype=np.int64)
        one[rank] = np.arange(len(rank))
        one = one[held]
        lefts.append(symbols[hits[one]].astype(np.int64))
        rights.append(symbols[second[one]].astype(np.int64))
        numbers = (n_symbols + np.cumsum(held) - 1).astype(np.uint32)
        n_symbols += len(one)
        ahead, behind = before[hits].astype(np.int64), after[second].astype(np.int64)
        # hits stand from the left on, so what is ahead of one may be the end of the last
        lone = np.r_[True, ahead[1:] != second[:-1]]
        pairs.replace(chosen, rank, hits, second, ahead[lone])
        after[hits], before[behind], after[second] = behind, hits, -1
        symbols[hits] = fresh = numbers[rank]
        # pairs that begin ahead of a hit and at it, from the left
        lone[0] &= ahead[0] != length
        inside = np.stack([lone, behind != length], axis=1).ravel()
        places = np.stack([ahead, hits], axis=1).ravel()[inside]
        left = np.stack([symbols[ahead], fresh], axis=1).ravel()[inside]
        right = np.stack([fresh, symbols[behind]], axis=1).ravel()[inside]
        touch = np.stack([hits, behind], axis=1).ravel()[inside][:-1] == places[1:]
        if len(places):
            alone = _apart(np.r_[False, touch & (left[1:] == left[:-1]) & (right[1:] == right[:-1])])
            pairs.add(places[alone], left[alone], right[alone], n_symbols)


def _run_left(symbols: np.ndarray) -> bool:
    """Whether a pair of one symbol with itself stands twice.  In a run of a
    symbol every other pair counts, so a run that lost its beginning to a
    neighbour may hold pairs that were not counted."""
    same = np.flatnonzero(symbols[1:] == symbols[:-1])
    same = same[_apart(np.r_[False, np.diff(same) == 1])] if len(same) else same
    return len(np.unique(symbols[same])) < len(same)


def _packed(values: np.ndarray, bits: int) -> bytes:
    """Numbers below 2 ** bits: their whole bytes one after the other, lowest
    first, each of all numbers, then their highest bits in a row."""
    planes = [(values >> 8 * i).astype(np.uint8).tobytes() for i in range(bits // 8)]
    rest = values >> bits // 8 * 8
    high = (rest[:, None] >> np.arange(bits % 8)).astype(np.uint8) & 1
    return b"".join(planes) + np.packbits(high).tobytes()


def _unpacked(raw: bytes, at: int, count: int, bits: int) -> tuple[np.ndarray, int]:
    """``count`` numbers from ``raw`` at byte ``at``, and where they end."""
    values = np.zeros(count, dtype=np.int64)
    for i in range(bits // 8):
        values |= np.frombuffer(raw, np.uint8, count, at).astype(np.int64) << 8 * i
        at += count
    n_bytes = -(-count * (bits % 8) // 8)
    high = np.unpackbits(np.frombuffer(raw, np.uint8, n_bytes, at), count=count * (bits % 8)).reshape(count, bits % 8)
    for i in range(bits % 8):
        values |= high[:, i].astype(np.int64) << bits // 8 * 8 + i
    return values, at + n_bytes


def compress(ids: np.ndarray, alphabet: int) -> bytes:
    """The grammar of ``ids``, all of them below ``alphabet``."""
    symbols = ids.astype(np.int64)
    lefts, rights = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    while True:
        symbols = _replaced(symbols, alphabet + sum(map(len, lefts)), lefts, rights)
        if not _run_left(symbols):
            break
    left, right = np.concatenate(lefts), np.concatenate(rights)
    # a round's rules are made of the symbols of earlier ones
    lengths, n = np.ones(alphabet + len(left), dtype=np.int64), alphabet
    for a, b in zip(lefts, rights):
        lengths[n : n + len(a)] = lengths[a] + lengths[b]
        n += len(a)
    lengths = lengths[alphabet:]
    bits = max(1, (alphabet + len(left) - 1).bit_length())
    head = struct.pack(HEAD, MAGIC, alphabet, len(left), len(symbols), bits)
    long = lengths[lengths >= LONG_RULE].astype("<u8")
    return head + b"".join([
        _packed(left, bits), _packed(right, bits), np.minimum(lengths, LONG_RULE).astype(np.uint8).tobytes(), long.tobytes(),
        _packed(symbols, bits),
    ])


class Grammar:
    """A shard's grammar, for reading."""

    def __init__(self, raw: bytes):
        magic, self.alphabet, rules, count, bits = struct.unpack_from(HEAD, raw)
        if magic != MAGIC:
            raise ValueError("not a grammar shard")
        self.left, at = _unpacked(raw, struct.calcsize(HEAD), rules, bits)
        self.right, at = _unpacked(raw, at, rules, bits)
        self.lengths = np.frombuffer(raw, np.uint8, rules, at).astype(np.int64)
        at += rules
        long = np.flatnonzero(self.lengths == LONG_RULE)
        self.lengths[long] = np.frombuffer(raw, "<u8", len(long), at)
        self.symbols, _ = _unpacked(raw, at + 8 * len(long), count, bits)
        # of every symbol: how many ids it stands for; an id stands for itself
        self.sizes = np.concatenate([np.ones(self.alphabet, dtype=np.int64), self.lengths])
        self.ends = np.cumsum(self.sizes[self.symbols])

    def ids(self, first: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids first .. stop - 1.  Only the symbols that cover them are looked
        up, and of their rules only the sides that reach into the stretch."""
        total = int(self.ends[-1]) if len(self.ends) else 0
        stop = total if stop is None else min(stop, total)
        if first >= stop:
            return np.zeros(0, dtype="<u4")
        a, b = np.searchsorted(self.ends, [first, stop - 1], side="right")
        symbols = self.symbols[a : b + 1]
        starts = self.ends[a : b + 1] - self.sizes[symbols] - first
        out = np.zeros(stop - first, dtype="<u4")
        while len(symbols):
            plain = symbols < self.alphabet
            out[starts[plain]] = symbols[plain]
            rules, starts = symbols[~plain] - self.alphabet, starts[~plain]
            left = self.left[rules]
            symbols = np.concatenate([left, self.right[rules]])
            starts = np.concatenate([starts, starts + self.sizes[left]])
            if first > 0 or stop < total:
                inside = (starts < stop - first) & (starts + self.sizes[symbols] > 0)
                symbols, starts = symbols[inside], starts[inside]
        return out


# -- encoding -----------------------------------------------------------------


def byte_letters() -> dict[int, str]:
    """Byte -> the printable character that stands for it in byte-level
    vocabularies: itself where it prints, else the next one from U+0100 on."""
    prints = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder:
    """A tokenizer that drops white space and case, with a memory of words.

    Words are what stands between ASCII blanks, A-Z lower-cased.  Words of
    small Latin letters, with ASCII marks behind them at most, go to the
    tokenizer's model one by one, and such marks are encoded once; the others
    go through the whole tokenizer, many in one string, told apart by offsets.
    """

    PLAIN = re.compile("[a-zß-öø-ÿ]+")
    # without the apostrophe, which the tokenizer may cut elsewhere
    MARKS = string.punctuation.replace("'", "")
    TOGETHER = 2000

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        #: For texts that hold one of the tokenizer's own marks, which are ids of their own.
        self.whole = Tokenizer.from_file(path)
        self.own_marks = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.alphabet = self.tokenizer.get_vocab_size()
        self.letters = byte_letters()
        self.model = self.tokenizer.model
        self.marks: dict[str, list[int]] = {}
        self.bodies: dict[str, list[int]] = {}
        sample = "Élan, vital. Été ab"
        if [i for w in sample.lower().split() for i in self._plain(w)] != self.tokenizer.encode(sample, add_special_tokens=False).ids:
            raise ValueError("a byte-level tokenizer with word ends, without case and white space is needed")
        self.memo = WordMemo(self._bulk)

    def _plain(self, word: str) -> list[int] | None:
        """The ids of a plain word, None for others."""
        if not word:
            return []
        body = word.rstrip(self.MARKS)
        if not (body.isascii() and body.isalpha()) and self.PLAIN.fullmatch(body) is None:
            return None
        marks = word[len(body) :]
        ids = self.bodies.get(body)
        if ids is None:
            letters = body if body.isascii() else body.encode().decode("latin-1").translate(self.letters)
            ids = [t.id for t in self.model.tokenize(letters)]
            if len(self.bodies) < BODIES_KEPT:
                self.bodies[body] = ids
        if not marks:
            return ids
        behind = self.marks.get(marks)
        if behind is None:
            behind = self.tokenizer.encode(marks, add_special_tokens=False).ids
            if len(self.marks) < MARKS_KEPT:
                self.marks[marks] = behind
        return ids + behind

    def _bulk(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.bodies) >= BODIES_KEPT:
            self.bodies.clear()
        ids = list(map(self._plain, words))
        plain = np.fromiter((x is not None for x in ids), dtype=bool, count=len(ids))
        others = [w for w, x in zip(words, ids) if x is None]
        ids = [x for x in ids if x is not None]
        flats = [np.fromiter(chain.from_iterable(ids), dtype=np.uint32)]
        counts = [np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))]
        for first in range(0, len(others), self.TOGETHER):
            some = others[first : first + self.TOGETHER]
            coded = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            ends = np.cumsum(np.fromiter(map(len, some), dtype=np.int64, count=len(some)) + 1)
            begins = np.fromiter((a for a, _ in coded.offsets), dtype=np.int64, count=len(coded.ids))
            flats.append(np.array(coded.ids, dtype=np.uint32))
            counts.append(np.bincount(np.searchsorted(ends, begins, side="right"), minlength=len(some)))
        # back from plain words first to the order given
        count, order = np.concatenate(counts), np.argsort(~plain, kind="stable")
        starts, given = np.empty(len(words), dtype=np.int64), np.empty(len(words), dtype=np.int64)
        starts[order], given[order] = np.cumsum(count) - count, count
        return np.concatenate(flats)[ragged(starts, given)], given

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has; null as empty.

        Lower-casing and cutting are Arrow's, so that only distinct words reach
        Python.  Texts with one of the tokenizer's marks go through it whole."""
        with no_collection():
            return self._encoded(pc.fill_null(texts, ""))

    def _encoded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        marked = np.zeros(len(texts), dtype=bool)
        for mark in self.own_marks:
            marked |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(~marked), texts, "") if marked.any() else texts
        cut = pc.ascii_split_whitespace(pc.ascii_lower(plain))
        flat, counts = self.memo.column_ids(cut.flatten(), np.diff(cut.offsets.to_numpy()).astype(np.int64))
        if not marked.any():
            return flat, counts
        parts = np.split(flat, np.cumsum(counts)[:-1])
        for at in np.flatnonzero(marked).tolist():
            parts[at] = np.array(self.whole.encode(texts[at].as_py(), add_special_tokens=False).ids, dtype=np.uint32)
        return np.concatenate(parts), np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per Python worker, kept between tasks."""
    return Encoder(path)


def write_ids(
    rows: DataFrame, tokenizer: str, folder: str, end_id: int, id_column: str = "doc_id", text_column: str = "text",
    shard_ids: int = SHARD_IDS,
) -> None:
    """Write all texts' ids below ``folder``; ``tokenizer`` is a path that every executor has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        coder = encoder(tokenizer)
        shard = start = held = 0
        docs: list[int | None] = []
        sizes: list[np.ndarray] = []
        flats: list[np.ndarray] = []

        def row() -> pa.RecordBatch:
            ids, size = np.concatenate(flats), np.concatenate(sizes)
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "shard": pa.array([shard], pa.int32()),
                "start_in_part": pa.array([start], pa.int64()), "n_ids": pa.array([len(ids)], pa.int64()),
                "doc_ids": pa.array([docs], pa.list_(pa.int64())), "doc_sizes": pa.array([size.astype(np.int32)], pa.list_(pa.int32())),
                "grammar": pa.array([compress(ids, coder.alphabet)], pa.binary()),
            })

        for piece in slices(batches, most=ENCODED_BYTES):
            flat, counts = coder.encode(piece.column("text"))
            flat, counts = np.insert(flat, np.cumsum(counts), end_id), counts + 1
            ids, ends = piece.column("id").to_pylist(), np.cumsum(counts)
            done = 0
            while done < len(ids):
                # as many documents as fill the shard
                begin = int(ends[done] - counts[done])
                stop = min(int(np.searchsorted(ends, begin + shard_ids - held)) + 1, len(ids))
                docs += ids[done:stop]
                sizes.append(counts[done:stop])
                flats.append(flat[begin : int(ends[stop - 1])])
                held += len(flats[-1])
                done = stop
                if held >= shard_ids:
                    yield row()
                    shard, start, held = shard + 1, start + held, 0
                    docs, sizes, flats = [], [], []
        if docs:
            yield row()

    ordered = narrowed(rows, id_column, text_column).withColumn("tie", F.xxhash64("text"))
    ordered = ordered.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie")
    ordered.select("id", "text").mapInArrow(run, FILES).write.parquet(folder)


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """(id, start, ids) of every document in the files."""
    return _decoded(spark, folder, "id long, start long, ids array<long>", lambda ids: {"ids": ids.astype(np.int64)})


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """(id, start, n_ids, crc32) of every document; the ids stay in the task that decodes them."""
    return _decoded(
        spark, folder, "id long, start long, n_ids long, crc32 long",
        lambda ids: {"n_ids": len(ids), "crc32": zlib.crc32(ids.tobytes())},
    )


def _decoded(spark: SparkSession, folder: str, schema: str, show) -> DataFrame:
    files = spark.read.schema(FILES).parquet(folder)
    # one row per task of the writing job, so the sums and their broadcast are bounded by its tasks
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = parts.select("part", before.alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard = {name: batch.column(name)[row] for name in batch.schema.names}
                ids = Grammar(shard["grammar"].as_py()).ids()
                sizes = shard["doc_sizes"].values.to_numpy().astype(np.int64)
                ends = np.cumsum(sizes)
                shown = [show(ids[a:b]) for a, b in zip((ends - sizes).tolist(), ends.tolist())]
                columns = {
                    "part": pa.array([shard["part"].as_py()] * len(sizes), pa.int32()),
                    "id": shard["doc_ids"].values,
                    "start": pa.array(ends - sizes + shard["start_in_part"].as_py()),
                }
                yield pa.RecordBatch.from_pydict(columns | {k: [x[k] for x in shown] for k in shown[0]})

    docs = files.select("part", "start_in_part", "doc_ids", "doc_sizes", "grammar").mapInArrow(run, "part int, " + schema)
    names = [f.split()[0] for f in schema.split(", ")]
    based = docs.join(F.broadcast(bases), "part").withColumn("start", F.col("start") + F.col("base"))
    return based.select(*names)
