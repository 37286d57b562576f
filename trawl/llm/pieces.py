"""SentencePiece encoding and decoding for merge-type vocabularies.

A text's symbols start as its characters.  An agenda of adjacent symbol pairs
that form a vocabulary piece is worked off by score, ties from the left, until
no pair is left; symbols that are no piece become byte pieces.  Agendas of
independent stretches do not meet: no piece holds a blank mark after another
character, nor a character that only occurs as a piece of its own, so texts
are cut there, and the agendas of all new stretches of an Arrow batch are
worked side by side, one merge per stretch and step.  A long stretch, such as
a megabyte without blanks, has a heap for its agenda.

The stretches of every batch are also encoded by the sentencepiece library.
Should a text hold a stretch on which the two differ, the library's ids are
taken for the whole text and ``agrees`` is false for it.

Null and empty texts have begin and end ids only and decode to the empty
text.  Texts are encoded whole, whatever their length.  Repeated rows are encoded each for itself; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2

from trawl.llm.batches import WordMemo, appended, filled, narrowed, per_text, ragged

BLANK = "▁"
#: Symbols of stretches merged side by side, at most; a longer one goes alone.
SIDE_BY_SIDE = 1 << 20
#: Symbols of a stretch from which on its agenda is a heap of its own.
LONG_STRETCH = 4096
#: Stretches remembered between batches.
MEMO = 400_000
NO_MERGE = np.iinfo(np.int64).max


class Merger:
    """The vocabulary as a table of merges."""

    def __init__(self, path: str):
        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        if proto.trainer_spec.model_type != proto.trainer_spec.BPE or not proto.trainer_spec.byte_fallback:
            raise ValueError("a merge-type vocabulary with byte pieces is needed")
        spec = proto.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix:
            raise ValueError("only texts taken as they are, with a leading blank, are supported")
        kind = sentencepiece_model_pb2.ModelProto.SentencePiece
        normal, byte = kind.NORMAL, kind.BYTE
        if any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in proto.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        pieces = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == normal}
        self.bytes = np.zeros(256, dtype=np.uint32)
        for i, p in enumerate(proto.pieces):
            if p.type == byte:
                self.bytes[int(p.piece[3:5], 16)] = i
        self.begin, self.end = proto.trainer_spec.bos_id, proto.trainer_spec.eos_id
        # symbols: all pieces, and characters that only occur within pieces
        symbols = dict(pieces)
        self.n_ids = len(proto.pieces)
        for piece in pieces:
            for c in piece:
                symbols.setdefault(c, self.n_ids + len(symbols))
        self.symbols = symbols
        merging = {c for p in pieces if len(p) > 1 for c in p}
        if any(re.search(f"[^{BLANK}]{BLANK}", p) for p in pieces):
            raise ValueError("a piece goes on after a blank")
        if "\n" in merging:
            raise ValueError("a piece goes across a line end")
        alone = "".join(re.escape(c) for c in "\n\t\r" if c not in merging)
        self.stretch = re.compile(f"[{alone}]|{BLANK}*[^{BLANK}{alone}]+|{BLANK}+")
        # the agenda goes by score; equal scores share an order, and the left pair is first
        scores = sorted({proto.pieces[i].score for i in pieces.values()}, reverse=True)
        place = {score: at for at, score in enumerate(scores)}
        left, right, order, merged = [], [], [], []
        for p, i in pieces.items():
            for cut in range(1, len(p)):
                if p[:cut] in symbols and p[cut:] in symbols:
                    left.append(symbols[p[:cut]])
                    right.append(symbols[p[cut:]])
                    order.append(place[proto.pieces[i].score])
                    merged.append(i)
        self._table(np.array(left), np.array(right), np.array(order), np.array(merged))

    def _table(self, left: np.ndarray, right: np.ndarray, order: np.ndarray, merged: np.ndarray) -> None:
        """An open table: pair -> order and merged piece, with linear probing."""
        self._known: dict[int, tuple[int, int]] | None = None
        self.bits = max(4, int(np.ceil(np.log2(4 * len(left) + 1))))
        size = 1 << self.bits
        self.keys = np.full(size + 1, -1, dtype=np.int64)
        self.orders = np.full(size + 1, NO_MERGE, dtype=np.int64)
        self.merged = np.zeros(size + 1, dtype=np.int64)
        self.probes = 1
        wanted = left << 32 | right
        for key, at, o, m in zip(wanted.tolist(), self._slot(wanted).tolist(), order.tolist(), merged.tolist()):
            tried = 1
            while self.keys[at] >= 0:
                at, tried = (at + 1) & (size - 1), tried + 1
            self.keys[at], self.orders[at], self.merged[at] = key, o, m
            self.probes = max(self.probes, tried)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The slot of each pair; slot -1 is always free and merges nothing."""
        keys = left << 32 | right
        slot = self._slot(keys)
        there = self.keys[slot]
        found = np.where(there == keys, slot, -1)
        open_at = np.flatnonzero((there != keys) & (there >= 0))
        for step in range(1, self.probes):
            if not len(open_at):
                break
            at = (slot[open_at] + step) & ((1 << self.bits) - 1)
            hit = self.keys[at] == keys[open_at]
            found[open_at[hit]] = at[hit]
            open_at = open_at[~hit & (self.keys[at] >= 0)]
        return found

    # -- the agenda ---------------------------------------------------------

    def encode(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all stretches in a row, and how many each has."""
        lengths = np.fromiter(map(len, stretches), dtype=np.int64, count=len(stretches))
        order = np.argsort(lengths, kind="stable")
        flats, counts = [np.zeros(0, dtype=np.uint32)], np.zeros(len(stretches), dtype=np.int64)
        first = 0
        while first < len(order) and lengths[order[first]] <= LONG_STRETCH:
            # stretches of like length, so that rows hold little padding
            width = int(lengths[order[first]])
            width += width // 4
            last = int(np.searchsorted(lengths[order], width, side="right"))
            last = max(first + 1, min(last, first + SIDE_BY_SIDE // max(width, 1)))
            last = min(last, int(np.searchsorted(lengths[order], LONG_STRETCH, side="right")))
            chosen = order[first:last]
            flat, counts[chosen] = self._side_by_side([stretches[i] for i in chosen.tolist()])
            flats.append(flat)
            first = last
        for at in order[first:].tolist():
            flat, counts[at] = self._by_heap(stretches[at])
            flats.append(flat)
        starts = np.zeros(len(stretches), dtype=np.int64)
        starts[order] = np.cumsum(counts[order]) - counts[order]
        return np.concatenate(flats)[ragged(starts, counts)], counts

    def _side_by_side(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        n = np.fromiter(map(len, stretches), dtype=np.int64, count=len(stretches))
        rows, width = len(stretches), int(n.max())
        text = "".join(stretches)
        distinct, place = np.unique(np.frombuffer(text.encode("utf-32-le"), dtype="<u4"), return_inverse=True)
        beyond = max(self.symbols.values()) + 1
        code = np.array([self.symbols.get(chr(c), beyond + i) for i, c in enumerate(distinct.tolist())], dtype=np.int64)
        inside = np.arange(width) < n[:, None]
        symbol = np.full((rows, width), -1, dtype=np.int64)
        symbol[inside] = code[place]
        agenda = np.full((rows, width), NO_MERGE, dtype=np.int64)
        becomes = np.zeros((rows, width), dtype=np.int64)

        def put(row: np.ndarray, at: np.ndarray, nxt: np.ndarray) -> None:
            slot = self.look_up(symbol[row, at], symbol[row, nxt])
            agenda[row, at] = self.orders[slot]
            becomes[row, at] = self.merged[slot]

        row, at = np.nonzero(inside[:, 1:])
        put(row, at, at + 1)
        after = np.tile(np.arange(1, width + 1), (rows, 1))
        before = after - 2
        after[np.arange(rows), n - 1] = width
        live = np.arange(rows)
        while True:
            at = agenda[live].argmin(axis=1)
            going = agenda[live, at] < NO_MERGE
            live, at = live[going], at[going]
            if not len(live):
                break
            gone = after[live, at]
            nxt = after[live, gone]
            prior = before[live, at]
            symbol[live, at] = becomes[live, at]
            symbol[live, gone] = -1
            agenda[live, gone] = agenda[live, at] = NO_MERGE
            after[live, at] = nxt
            more, has = nxt < width, prior >= 0
            before[live[more], nxt[more]] = at[more]
            put(live[more], at[more], nxt[more])
            put(live[has], prior[has], at[has])
        left = symbol >= 0
        flat, counts = symbol[left], left.sum(axis=1)
        unknown = np.flatnonzero(flat >= self.n_ids)
        if not len(unknown):
            return flat.astype(np.uint32), counts
        names = {i: s for s, i in self.symbols.items() if i >= self.n_ids}
        names |= {beyond + i: chr(c) for i, c in enumerate(distinct.tolist())}
        raw = [names[i].encode("utf-8", "surrogatepass") for i in flat[unknown].tolist()]
        size = np.ones(len(flat), dtype=np.int64)
        size[unknown] = list(map(len, raw))
        out = np.repeat(flat, size).astype(np.uint32)
        begins = (np.cumsum(size) - size)[unknown]
        for at, octets in zip(begins.tolist(), raw):
            out[at : at + len(octets)] = self.bytes[list(octets)]
        owner = np.repeat(np.arange(rows), counts)
        return out, np.bincount(owner, weights=size, minlength=rows).astype(np.int64)

    def _by_heap(self, stretch: str) -> tuple[np.ndarray, int]:
        """One long stretch: the agenda is a heap of (order, place), a pair that
        has changed since it was put there is passed over."""
        beyond = max(self.symbols.values()) + 1
        distinct, place = np.unique(np.frombuffer(stretch.encode("utf-32-le", "surrogatepass"), dtype="<u4"), return_inverse=True)
        code = np.array([self.symbols.get(chr(c), beyond + i) for i, c in enumerate(distinct.tolist())], dtype=np.int64)
        codes = code[place]
        slot = self.look_up(codes[:-1], codes[1:])
        some = np.flatnonzero(slot >= 0)
        symbol, n = codes.tolist(), len(codes)
        heap = list(zip(self.orders[slot[some]].tolist(), some.tolist(), codes[some].tolist(), codes[some + 1].tolist()))
        heapq.heapify(heap)
        pairs = self._pairs()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(at: int, nxt: int) -> None:
            left, right = symbol[at], symbol[nxt]
            found = pairs.get(left << 32 | right)
            if found is not None:
                heapq.heappush(heap, (found[0], at, left, right))

        while heap:
            _, at, left, right = heapq.heappop(heap)
            gone = after[at]
            if symbol[at] != left or gone >= n or symbol[gone] != right:
                continue
            symbol[at], symbol[gone] = pairs[left << 32 | right][1], -1
            nxt = after[at] = after[gone]
            if nxt < n:
                before[nxt] = at
                put(at, nxt)
            if before[at] >= 0:
                put(before[at], at)
        ids = []
        for s in symbol:
            if s >= self.n_ids:
                name = self.names.get(s) or chr(int(distinct[s - beyond]))
                ids.extend(self.bytes[list(name.encode("utf-8", "surrogatepass"))].tolist())
            elif s >= 0:
                ids.append(s)
        return np.array(ids, dtype=np.uint32), len(ids)

    def _pairs(self) -> dict[int, tuple[int, int]]:
        """The pair table as a dictionary, made when the first long stretch comes."""
        if self._known is None:
            full = np.flatnonzero(self.keys >= 0)
            made = zip(self.orders[full].tolist(), self.merged[full].tolist())
            self._known = dict(zip(self.keys[full].tolist(), made))
            self.names = {i: c for c, i in self.symbols.items() if i >= self.n_ids}
        return self._known

    def stretches(self, text: str) -> list[str]:
        """The text cut where no merge can reach across."""
        return self.stretch.findall(BLANK + text.replace(" ", BLANK)) if text else []


class Checked:
    """Stretches encoded by the agenda and, batch by batch, by the library."""

    def __init__(self, path: str):
        self.merger = Merger(path)
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.memo = WordMemo(self._encode, most=MEMO)
        self.differing: set[str] = set()

    def _encode(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        flat, counts = self.merger.encode(stretches)
        # the library puts a blank before each text; where none stands, a line end keeps it off
        told = self.library.encode(
            [s[1:].replace(BLANK, " ") if s[0] == BLANK < s else "\n" + s.replace(BLANK, " ") for s in stretches],
            num_threads=1,
        )
        lead = self.library.encode("\n")
        ends = np.cumsum(counts).tolist()
        ours = flat.tolist()
        first = 0
        for s, ids, last in zip(stretches, told, ends):
            if ids != (ours[first:last] if s[0] == BLANK < s else lead + ours[first:last]):
                self.differing.add(s)
            first = last
        return flat, counts

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[bool]]:
        """Ids of each text with begin and end, and whether both ways agree."""
        cut = [self.merger.stretches(t) for t in texts]
        flat, counts = self.memo.ids(
            list(chain.from_iterable(cut)), np.fromiter(map(len, cut), dtype=np.int64, count=len(cut))
        )
        ends = np.cumsum(counts)
        out, agrees = [], []
        for text, stretches, a, b in zip(texts, cut, (ends - counts).tolist(), ends.tolist()):
            same = not self.differing or self.differing.isdisjoint(stretches)
            ids = flat[a:b] if same else np.array(self.library.encode(text), dtype=np.uint32)
            out.append(np.concatenate([[self.merger.begin], ids, [self.merger.end]]).astype("<u4"))
            agrees.append(same)
        return out, agrees


@lru_cache(maxsize=2)
def checked(path: str) -> Checked:
    """One per Python worker, kept between tasks."""
    return Checked(path)


def encode_texts(rows: DataFrame, model: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, ids, decoded, agrees); ``model`` is a path that every executor has."""

    def work(batch: pa.RecordBatch) -> dict:
        coder = checked(model)
        ids, agrees = coder.encode(filled(batch.column("text")))
        decoded = [coder.library.decode(x.tolist()) for x in ids]
        return {"id": batch.column("id"), "ids": pa.array(ids, pa.list_(pa.int32())), "decoded": decoded, "agrees": agrees}

    return per_text(narrowed(rows, id_column, text_column), work, "id long, ids array<int>, decoded string, agrees boolean")


def digest_texts(rows: DataFrame, model: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256, agrees): the same without the ids leaving the task."""

    def work(batch: pa.RecordBatch) -> dict:
        coder = checked(model)
        ids, agrees = coder.encode(filled(batch.column("text")))
        sha = hashlib.sha256
        return {
            "id": batch.column("id"),
            "n_tokens": list(map(len, ids)),
            "ids_sha256": [sha(x.tobytes()).hexdigest() for x in ids],
            "decoded_sha256": [sha(coder.library.decode(x.tolist()).encode()).hexdigest() for x in ids],
            "agrees": agrees,
        }

    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string, agrees boolean"
    return per_text(narrowed(rows, id_column, text_column), work, schema)


def with_ids(rows: DataFrame, model: str, text_column: str = "text") -> DataFrame:
    """The rows, all columns kept, with n_tokens, ids, and whether decoding
    gives the text back (``round_trip``)."""

    def work(texts: list[str]) -> dict:
        coder = checked(model)
        ids, _ = coder.encode(texts)
        back = [coder.library.decode(x.tolist()) == t for x, t in zip(ids, texts)]
        return {
            "n_tokens": pa.array(list(map(len, ids)), pa.int64()), "ids": pa.array(ids, pa.list_(pa.int32())),
            "round_trip": pa.array(back, pa.bool_()),
        }

    return appended(rows, text_column, work, "n_tokens long, ids array<int>, round_trip boolean")
