"""Language labels for mixed text: scripts, then Viterbi over words.

Words are runs of letters with their marks, lower-cased.  The script of a word (by the range of
its first letter) narrows the languages to those seen in that script while
learning; where none was, all stay.  Each word scores every language by the
log odds of its character n-grams, and the best path through the words pays
``penalty`` for each change of language.  The path's runs are the spans; the
text's language is the one with most letters, its score their share.

Learning counts n-grams of every labelled row given, in Spark; a model holds
``BUCKETS`` numbers a language, whatever the size of the corpus.

Null, empty and letterless texts are ``und`` with score 0 and no spans.  Rows
without a label teach nothing.  With no labelled row at all every text is
``und``.  Numbers of any kind are no letters.  Texts are read whole, whatever
their length.  Ties go to the language first in the alphabet.  Repeated rows are
labelled each for itself; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.batches import appended, filled, narrowed, slices

#: A letter, and the letters and marks (such as vowel signs) behind it.
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*+")
#: The same for texts without marks, letters beyond the first blocks, or numbers that are no digits.
PLAIN_WORD = re.compile(r"[^\W\d_]+")
NOT_PLAIN = re.compile("[\u00b2\u00b3\u00b9\u00bc-\u00be\u0300-\u1fff\u2070-\U0010ffff]")
BUCKETS = 1 << 16
LONGEST = 4
#: Weight of overlapping n-grams against independent ones.
DAMPING = 0.25
PENALTY = 12.0
#: A language counts as written in a script from this share of its letters on.
IN_SCRIPT = 0.01
EXCLUDED = -1e4
UNKNOWN = "und"

# First code points of blocks and the script they begin.
SCRIPT_STARTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "other"),
    (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"),
    (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"),
    (0xFB00, "latin"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFF21, "latin"),
    (0xFF66, "kana"), (0xFFA0, "other"), (0x20000, "han"),
)
SCRIPTS = tuple(sorted({name for _, name in SCRIPT_STARTS}))
_BOUNDS = np.array([start for start, _ in SCRIPT_STARTS])
_SCRIPT_AT = np.array([SCRIPTS.index(name) for _, name in SCRIPT_STARTS])


@dataclass
class Model:
    languages: tuple[str, ...]
    #: Log probability per language and n-gram bucket.
    weights: np.ndarray
    #: Whether a language is written in a script.
    scripts: np.ndarray


def words_of(text: str) -> list[str]:
    lowered = text.lower()
    return (WORD if NOT_PLAIN.search(lowered) else PLAIN_WORD).findall(lowered)


class Vocabulary:
    """Distinct words of some texts, and the texts as numbers of words."""

    def __init__(self, texts: list[str]):
        number: dict[str, int] = defaultdict()
        number.default_factory = number.__len__
        found = list(map(words_of, texts))
        self.per_text = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        self.codes = np.fromiter((number[w] for words in found for w in words), dtype=np.int64, count=int(self.per_text.sum()))
        self.words = list(number)
        self.letters = np.fromiter(map(len, self.words), dtype=np.int64, count=len(self.words))
        # \x02 and \x03 stand for the beginning and end of a word
        points = np.frombuffer("".join(f"\x02{w}\x03" for w in self.words).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        self.points = points.astype(np.uint64)
        self.owner = np.repeat(np.arange(len(self.words)), self.letters + 2)
        begin = np.cumsum(self.letters + 2) - (self.letters + 2)
        first = points[begin + 1] if len(points) else points
        self.scripts = _SCRIPT_AT[np.searchsorted(_BOUNDS, first, side="right") - 1]

    def grams(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(word, bucket) of all n-grams, one length after another."""
        mixed = self.points
        for n in range(1, LONGEST + 1):
            if n > 1:
                mixed = mixed[: len(self.points) - n + 1] * np.uint64(1_000_003) + self.points[n - 1 :]
            inside = self.owner[: len(mixed)] == self.owner[n - 1 :]
            hashed = (mixed ^ np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            yield self.owner[: len(mixed)][inside], (hashed >> np.uint64(48)).astype(np.int64)[inside]
            if len(mixed) < 2:
                break


def fit(rows: DataFrame, text_column: str = "text", label_column: str = "lang") -> Model:
    """Learn from all labelled rows; what reaches the driver is bounded by
    languages x (buckets + scripts)."""
    labelled = rows.select(
        rows[text_column].cast("string").alias("text"), rows[label_column].cast("string").alias("label")
    ).where("label IS NOT NULL AND text IS NOT NULL")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for piece in slices(batches):
            texts, labels = filled(piece.column("text")), piece.column("label").to_pylist()
            for label in sorted(set(labels)):
                known = Vocabulary([t for t, own in zip(texts, labels) if own == label])
                total = totals.setdefault(label, np.zeros(BUCKETS + len(SCRIPTS)))
                times = np.bincount(known.codes, minlength=len(known.words)).astype(float)
                for word, bucket in known.grams():
                    total[:BUCKETS] += np.bincount(bucket, weights=times[word], minlength=BUCKETS)
                total[BUCKETS:] += np.bincount(known.scripts, weights=times * known.letters, minlength=len(SCRIPTS))
        for label, total in totals.items():
            cells = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({
                "label": pa.array([label] * len(cells), pa.string()), "cell": pa.array(cells), "n": pa.array(total[cells])
            })

    sums: dict[str, np.ndarray] = {}
    counted = labelled.mapInArrow(count, "label string, cell long, n double").groupBy("label", "cell").agg(F.sum("n"))
    for label, cell, n in counted.collect():
        sums.setdefault(label, np.zeros(BUCKETS + len(SCRIPTS)))[cell] = n
    languages = tuple(sorted(sums))
    table = np.array([sums[x] for x in languages]).reshape(len(languages), BUCKETS + len(SCRIPTS))
    grams, scripts = table[:, :BUCKETS] + 0.5, table[:, BUCKETS:]
    weights = np.log(grams / grams.sum(axis=1, keepdims=True))
    share = scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1)
    return Model(languages, weights, share >= IN_SCRIPT)


def word_scores(known: Vocabulary, model: Model) -> np.ndarray:
    """(distinct words, languages)."""
    out = np.zeros((len(known.words), len(model.languages)))
    for word, bucket in known.grams():
        for at in range(len(model.languages)):
            out[:, at] += np.bincount(word, weights=model.weights[at][bucket], minlength=len(out))
    out *= DAMPING
    allowed = model.scripts[:, known.scripts].T
    allowed |= ~allowed.any(axis=1, keepdims=True)
    return np.where(allowed, out, EXCLUDED)


def best_paths(scores: np.ndarray, per_text: np.ndarray, penalty: float) -> np.ndarray:
    """The language of every word on the best path through its text.

    One language throughout is best where even the best word-by-word choice
    gains less than one change costs; the other texts go through the full
    recursion side by side, longest first.
    """
    n_words, n_languages = scores.shape
    path = np.zeros(n_words, dtype=np.int64)
    if not n_words:
        return path
    starts = np.cumsum(per_text) - per_text
    full = np.flatnonzero(per_text)
    total = np.add.reduceat(scores, starts[full], axis=0)
    ceiling = np.add.reduceat(scores.max(axis=1), starts[full])
    single = total.argmax(axis=1)
    path[:] = np.repeat(single, per_text[full])
    hard = full[ceiling - total.max(axis=1) > penalty]
    hard = hard[np.argsort(-per_text[hard], kind="stable")]
    if not len(hard):
        return path
    lengths, begins = per_text[hard], starts[hard]
    # texts still running at each step
    running = len(hard) - np.searchsorted(lengths[::-1], np.arange(lengths[0]), side="right")
    value = scores[begins].copy()
    kind = np.min_scalar_type(n_languages)
    came = [np.zeros((0, n_languages), dtype=kind)]
    same = np.arange(n_languages)
    for step in range(1, int(lengths[0])):
        k = running[step]
        now = value[:k]
        top = now.argmax(axis=1)
        changed = now[np.arange(k), top] - penalty
        switch = changed[:, None] > now
        came.append(np.where(switch, top[:, None], same).astype(kind))
        value[:k] = np.where(switch, changed[:, None], now) + scores[begins[:k] + step]
    state = value.argmax(axis=1)
    for step in range(int(lengths[0]) - 1, -1, -1):
        k = running[step]
        path[begins[:k] + step] = state[:k]
        if step:
            state[:k] = came[step][np.arange(k), state[:k]]
    return path


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("lang", pa.string())]))


def _label(texts: list[str], model: Model, penalty: float) -> dict:
    known = Vocabulary(texts)
    n_languages = len(model.languages)
    if not n_languages or not len(known.codes):
        return {"lang": [UNKNOWN] * len(texts), "score": [0.0] * len(texts), "spans": pa.array([[]] * len(texts), SPANS)}
    scores = word_scores(known, model)[known.codes]
    path = best_paths(scores, known.per_text, penalty)
    text_of = np.repeat(np.arange(len(texts)), known.per_text)
    letters = np.bincount(
        text_of * n_languages + path, weights=known.letters[known.codes], minlength=len(texts) * n_languages
    ).reshape(len(texts), n_languages)
    best, whole = letters.argmax(axis=1), letters.sum(axis=1)
    share = letters[np.arange(len(texts)), best] / np.maximum(whole, 1)
    new = np.flatnonzero(np.r_[True, (text_of[1:] != text_of[:-1]) | (path[1:] != path[:-1])])
    offset = (np.cumsum(known.per_text) - known.per_text)[text_of]
    place = np.arange(len(path)) - offset
    stop = np.r_[new[1:], len(path)] - 1
    spans: list[list[dict]] = [[] for _ in texts]
    for owner, a, b, at in zip(text_of[new].tolist(), place[new].tolist(), place[stop].tolist(), path[new].tolist()):
        spans[owner].append({"start": a, "stop": b + 1, "lang": model.languages[at]})
    return {
        "lang": [model.languages[at] if n else UNKNOWN for at, n in zip(best.tolist(), whole.tolist())],
        "score": share.tolist(),
        "spans": pa.array(spans, SPANS),
    }


def label(
    rows: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text", penalty: float = PENALTY
) -> DataFrame:
    """(id, lang, score, spans); a span counts the text's words from 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            found = _label(filled(piece.column("text")), model, penalty)
            yield pa.RecordBatch.from_pydict({"id": piece.column("id")} | found)

    return narrowed(rows, id_column, text_column).mapInArrow(
        run, "id long, lang string, score double, spans array<struct<start: int, stop: int, lang: string>>"
    )


def in_one_language(
    rows: DataFrame, model: Model, text_column: str = "text", min_share: float = 0.5, penalty: float = PENALTY
) -> DataFrame:
    """The rows, all columns kept, whose text has letters and one language with
    at least ``min_share`` of them."""

    def work(texts: list[str]) -> dict:
        found = _label(texts, model, penalty)
        return {"held": [lang != UNKNOWN and s >= min_share for lang, s in zip(found["lang"], found["score"])]}

    judged = appended(rows, text_column, work, "held boolean")
    verdict = judged.columns[-1]
    return judged.where(F.col(verdict)).drop(verdict)
