"""Arrow helpers for the operators that work text by text inside Spark tasks.

Tables are narrowed to an id and a text column under fixed inner names before
any Python runs, so further columns, whatever their names, never reach a task.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts of one working slice, in bytes; a longer text is a slice of its own.
SLICE_BYTES = 2 << 20
#: After so many slices, and at a task's end, freed memory goes back to the system.
SLICES_KEPT = 16


def narrowed(rows: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``id`` (long) and ``text`` (string) alone."""
    return rows.select(rows[id_column].cast("long").alias("id"), rows[text_column].cast("string").alias("text"))


def give_back() -> None:
    """Python workers outlive their tasks and share an executor's memory with
    it, so what they have freed must not stay with them."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


@contextmanager
def no_collection() -> Iterator[None]:
    """Python looks for circles among objects whenever many are made; where
    many lists without circles are, that takes a third of the time."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in record batches of about ``most`` bytes of text each."""
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        block = np.cumsum(sizes.astype(np.int64)) // most
        cuts = np.flatnonzero(np.diff(block)) + 1
        bounds = [0, *cuts.tolist(), batch.num_rows]
        for first, last in zip(bounds, bounds[1:]):
            yield batch.slice(first, last - first)
            count += 1
            if count % SLICES_KEPT == 0:
                give_back()
    give_back()


def filled(column: pa.Array) -> list[str]:
    """The texts as Python strings, null as empty."""
    return ["" if x is None else x for x in column.to_pylist()]


def per_text(rows: DataFrame, work: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """Apply ``work`` to slices of (id, text); it returns the named columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            yield pa.RecordBatch.from_pydict(work(piece))

    return rows.mapInArrow(run, schema)


def free_name(name: str, taken: list[str]) -> str:
    """``name`` with underscores in front until it is none of ``taken``."""
    while name.lower() in {c.lower() for c in taken}:
        name = f"_{name}"
    return name


def free_prefix(prefix: str, taken: list[str]) -> str:
    """``prefix`` with underscores in front until none of ``taken`` begins with it."""
    while any(c.lower().startswith(prefix.lower()) for c in taken):
        prefix = f"_{prefix}"
    return prefix


def quoted(rows: DataFrame, name: str) -> Column:
    """A column by its whole name, dots and backticks included."""
    return rows["`" + name.replace("`", "``") + "`"]


def appended(rows: DataFrame, text_column: str, work: Callable[[list[str]], dict], extra: str) -> DataFrame:
    """All columns of the rows, and what ``work`` makes of their texts.

    ``extra`` is the schema of the new columns; one whose name is taken gets
    underscores in front until it is free.
    """
    fields = []
    for field in T._parse_datatype_string(extra).fields:
        fields.append(T.StructField(free_name(field.name, rows.columns), field.dataType))
    place = rows.columns.index(text_column)
    names = [f.name for f in T._parse_datatype_string(extra).fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices([batch], f"c{place}"):
                made = work(filled(piece.column(place)))
                columns = [made[n] if isinstance(made[n], pa.Array) else pa.array(made[n]) for n in names]
                yield pa.RecordBatch.from_arrays([*piece.columns, *columns], shown)

    # Spark looks columns up by name here, and dots or backticks in a name would be syntax
    shown = [*rows.schema.names, *(f.name for f in fields)]
    plain = rows.toDF(*[f"c{i}" for i in range(len(rows.columns))])
    return plain.mapInArrow(run, T.StructType([*rows.schema.fields, *fields]))


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions starts[i] .. starts[i] + counts[i] - 1 for all i, in a row."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    shift = np.cumsum(counts) - counts
    return np.repeat(starts - shift, counts) + np.arange(total, dtype=np.int64)


class _Numbered(dict):
    """Gives every new key the next number and notes it."""

    def __init__(self):
        super().__init__()
        self.new: list = []

    def __missing__(self, key):
        self.new.append(key)
        number = self[key] = len(self)
        return number


class WordMemo:
    """Bounded memory of the ids of words, filled by ``encode`` in bulk.

    ``encode(words)`` gives the ids of all words in a row and their number per
    word.  Beyond ``most`` words the memory starts anew, which changes no result.
    """

    def __init__(self, encode: Callable[[list], tuple[np.ndarray, np.ndarray]], most: int = 1_000_000):
        self.encode, self.most = encode, most
        self.clear()

    def clear(self) -> None:
        self.index = _Numbered()
        self.flat = np.zeros(0, dtype=np.uint32)
        self.starts = np.zeros(0, dtype=np.int64)
        self.counts = np.zeros(0, dtype=np.int64)

    def places(self, words: list) -> np.ndarray:
        """The place of each word; new words are encoded first."""
        if len(self.index) > self.most:
            self.clear()
        place = np.fromiter(map(self.index.__getitem__, words), dtype=np.int64, count=len(words))
        new, self.index.new = self.index.new, []
        if new:
            flat, counts = self.encode(new)
            starts = np.cumsum(counts) - counts + len(self.flat)
            self.flat = np.concatenate([self.flat, flat.astype(np.uint32)])
            self.starts = np.concatenate([self.starts, starts])
            self.counts = np.concatenate([self.counts, counts])
        return place

    def ids(self, words: list, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and how many belong to each text when the
        texts have ``per_text`` words each."""
        return self._spread(self.places(words), per_text)

    def column_ids(self, words: pa.Array, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for an Arrow column of words; only distinct ones become Python strings."""
        coded = words.dictionary_encode()
        place = self.places(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        return self._spread(place[coded.indices.to_numpy(zero_copy_only=False)], per_text)

    def _spread(self, place: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts = self.counts[place]
        sums = np.concatenate([[0], np.cumsum(counts)])
        ends = np.cumsum(per_text)
        return self.flat[ragged(self.starts[place], counts)], sums[ends] - sums[ends - per_text]
