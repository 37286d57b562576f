"""SimHash near-duplicates found by the generalised pigeonhole principle.

Two 64-bit fingerprints that differ in at most ``bits`` bits must, for any
split of the bits into parts with thresholds t_i where the sum of (t_i + 1)
exceeds ``bits``, agree up to t_i bits on some part.  Parts and thresholds
follow the corpus: pair counts of bits over all fingerprints tell which bits
differ together; those share a part, and a dynamic programme gives each part
the threshold (none at all included) with the least estimated work.

A fingerprint probes with its part under every choice of t_i masked bits, so
close ones meet in a group, where distances are verified.  A group sends on a
spanning forest of its links, never its pairs.  A group beyond ``group`` rows
is not verified in one task but dealt anew by further bits, again by
pigeonhole, until it is small.

One lane of 64 bits is the usual fingerprint.  With more lanes, hashed anew
from the same shingles, fingerprints estimate similarity more sharply: ``bits``
then bounds the difference over all lanes, some lane differs in at most its
share of them, and each lane is probed with that.

Texts are read whole, whatever their length; a very long one takes its
task memory in proportion.  Null and empty texts have fingerprint zero.  Repeated rows each get a row.  A
null id never becomes a component id unless the whole component lacks ids.  An
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb, lgamma

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.batches import filled, free_prefix, narrowed, per_text, quoted
from trawl.llm.components import components
from trawl.plans.lineage import materialize

WIDTH = 64
SEED = 42
#: Distinct fingerprints that one task verifies as a group.
GROUP = 65_536
#: Groups up to this size are compared by shifting, larger ones by search.
SHIFTED = 256
#: Seconds for a probe (made, shuffled, sorted) and for a verified pair.
PROBE_COST = 1e-6
PAIR_COST = 4e-9


# -- fingerprints -----------------------------------------------------------


def shingle_hashes(text: str, words: int) -> list[int]:
    """Hashes of all ``words``-word shingles, repeats included; of the whole
    sequence where it is shorter."""
    tokens = text.encode().lower().split()
    if not tokens:
        return []
    joined = b" ".join(tokens)
    digest = xxhash.xxh64_intdigest
    if len(tokens) <= words:
        return [digest(joined, SEED)]
    ends = np.cumsum(np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens)) + 1)
    starts = [0, *ends[: len(tokens) - words].tolist()]
    return [digest(joined[a:b], SEED) for a, b in zip(starts, (ends[words - 1 :] - 1).tolist())]


def _mixed(hashes: np.ndarray, lane: int) -> np.ndarray:
    """Lane 0 takes the hashes as they are, each further one mixes them anew."""
    if lane:
        hashes = hashes + np.uint64((0x9E3779B97F4A7C15 * lane) & (1 << WIDTH) - 1)
        hashes = (hashes ^ (hashes >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        hashes = (hashes ^ (hashes >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        hashes = hashes ^ (hashes >> np.uint64(31))
    return hashes


def fingerprint(text: str, words: int = 4, lanes: int = 1) -> list[int]:
    """Majority bits of the shingles' hashes, a number for each lane."""
    hashes = np.array(shingle_hashes(text, words), dtype="<u8")
    ones = np.zeros((lanes, WIDTH), dtype=np.int64)
    for first in range(0, len(hashes), 1 << 16):
        for lane in range(lanes):
            octets = _mixed(hashes[first : first + (1 << 16)], lane).view(np.uint8).reshape(-1, 8)
            ones[lane] += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes), axis=1, bitorder="little").view("<u8").ravel().tolist()


def lane_names(lanes: int) -> list[str]:
    return ["fp", *(f"fp{i}" for i in range(1, lanes))]


def marks_of(texts: list[str], words: int, lanes: int) -> dict[str, pa.Array]:
    marks = np.array([fingerprint(t, words, lanes) for t in texts], dtype=np.uint64).reshape(-1, lanes)
    return {name: pa.array(np.ascontiguousarray(marks[:, i]).view(np.int64)) for i, name in enumerate(lane_names(lanes))}


def fingerprints(
    rows: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = 4, lanes: int = 1
) -> DataFrame:
    """(id, tag, fp, fp1 ..) per row; a lane holds 64 bits as a signed long, tag is the text's hash."""

    def work(batch: pa.RecordBatch) -> dict:
        return {"id": batch.column("id"), "tag": batch.column("tag")} | marks_of(filled(batch.column("text")), words, lanes)

    tagged = narrowed(rows, id_column, text_column).withColumn("tag", F.xxhash64("text"))
    return per_text(tagged, work, "id long, tag long, " + ", ".join(f"{name} long" for name in lane_names(lanes)))


# -- parts and thresholds ---------------------------------------------------


def bit_counts(marks: DataFrame, lanes: int = 1) -> np.ndarray:
    """How many of all fingerprints have bits i and j set, as a 64 x 64 table for each lane."""
    names = lane_names(lanes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((lanes, WIDTH, WIDTH), dtype=np.int64)
        for batch in batches:
            for lane in range(lanes):
                octets = np.ascontiguousarray(batch.column(lane).to_numpy(zero_copy_only=False)).view(np.uint8).reshape(-1, 8)
                for first in range(0, len(octets), 1 << 16):
                    bits = np.unpackbits(octets[first : first + (1 << 16)], axis=1, bitorder="little").astype(np.float32)
                    total[lane] += (bits.T @ bits).astype(np.int64)
        yield pa.RecordBatch.from_pydict({"cell": pa.array(np.arange(total.size)), "n": pa.array(total.ravel())})

    table = np.zeros(lanes * WIDTH * WIDTH)
    for cell, n in marks.select(*names).mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n")).collect():
        table[cell] = n
    return table.reshape(lanes, WIDTH, WIDTH)


def _differences(table: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """For a random pair: chance that bit i differs, and covariance of bits i and j differing."""
    both = table / max(count, 1)
    one = np.diag(both)
    apart = 2 * one * (1 - one)
    only = one[:, None] - both
    neither = 1 - one[:, None] - one[None, :] + both
    joint = 2 * (both * neither + only * only.T)
    return apart, joint - np.outer(apart, apart)


def _within(apart: np.ndarray, covariance: np.ndarray, most: int) -> list[float]:
    """Chance of exactly 0..most differing bits in a part: a beta-binomial with
    the part's mean and variance."""
    n, mean = len(apart), float(apart.sum())
    rate = min(max(mean / n, 1e-9), 1 - 1e-9)
    binomial = n * rate * (1 - rate)
    spread = float(covariance.sum()) / binomial if n > 1 else 1.0
    rho = min(max((spread - 1) / (n - 1) if n > 1 else 0.0, 1e-6), 0.99)
    a, b = rate * (1 / rho - 1), (1 - rate) * (1 / rho - 1)
    beta = lambda x, y: lgamma(x) + lgamma(y) - lgamma(x + y)
    return [comb(n, d) * float(np.exp(beta(d + a, n - d + b) - beta(a, b))) for d in range(most + 1)]


def _grouped(covariance: np.ndarray, parts: int) -> list[list[int]]:
    """Bits dealt to equal parts: each part starts with a free bit and takes
    the free bits that differ most together with what it has."""
    sizes = [WIDTH // parts + (i < WIDTH % parts) for i in range(parts)]
    strength = np.abs(covariance)
    free, out = set(range(WIDTH)), []
    for size in sizes:
        first = max(sorted(free), key=lambda i: strength[i].sum() - strength[i, i])
        part = [first]
        free.remove(first)
        while len(part) < size:
            nearest = max(sorted(free), key=lambda i: strength[i, part].sum())
            part.append(nearest)
            free.remove(nearest)
        out.append(sorted(part))
    return out


def allocate(table: np.ndarray, count: int, bits: int) -> list[tuple[list[int], int]]:
    """Parts with their thresholds; a part that is not probed is left out.

    For every number of parts, a dynamic programme over the parts spreads
    bits + 1 units, a part with threshold t taking t + 1 of them, so that
    probes and estimated candidate pairs cost least.
    """
    apart, covariance = _differences(table, count)
    best: tuple[float, list] = (float("inf"), [])
    for parts in range(1, min(WIDTH, bits + 3) + 1):
        split = _grouped(covariance, parts)
        plan: dict[int, tuple[float, list]] = {0: (0.0, [])}
        for part in split:
            chance = _within(apart[part], covariance[np.ix_(part, part)], min(bits, len(part)))
            nxt: dict[int, tuple[float, list]] = {}
            for used, (cost, chosen) in plan.items():
                for units in range(0, bits + 2 - used):
                    t = units - 1
                    if t > len(part):
                        break
                    extra = 0.0
                    if units:
                        met = sum(chance[d] * comb(len(part) - d, t - d) for d in range(t + 1))
                        extra = PROBE_COST * count * comb(len(part), t) + PAIR_COST * count * count / 2 * met
                    found = (cost + extra, chosen + [(part, t)] * (units > 0))
                    if units + used not in nxt or found[0] < nxt[units + used][0]:
                        nxt[units + used] = found
            plan = nxt
        if bits + 1 in plan and plan[bits + 1][0] < best[0]:
            best = plan[bits + 1]
    return best[1]


def _signed(mask: int) -> int:
    return mask - (1 << WIDTH) if mask >> (WIDTH - 1) else mask


def masks_of(parts: list[tuple[list[int], int]]) -> list[int]:
    """The probes: each part's bits without every choice of t of them."""
    out = []
    for part, t in parts:
        whole = sum(1 << i for i in part)
        out += [whole ^ sum(1 << i for i in gone) for gone in combinations(part, t)]
    return out


# -- groups -----------------------------------------------------------------


def _forest(a: np.ndarray, b: np.ndarray, nodes: int) -> np.ndarray:
    """The root of every node under the links a[i] - b[i]."""
    root = np.arange(nodes)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while True:
            nxt = root[root]
            if np.array_equal(nxt, root):
                break
            root = nxt
        open_links = root[a] != root[b]
        a, b = a[open_links], b[open_links]
    return root


def _apart(marks: np.ndarray, a, b) -> np.ndarray:
    """Differing bits over all lanes; marks is (lanes, rows)."""
    return np.bitwise_count(marks[:, a] ^ marks[:, b]).sum(axis=0, dtype=np.int16)


def _searched(marks: np.ndarray, bits: int) -> np.ndarray:
    """Roots within one large group: a search that takes found ones out."""
    root = np.arange(marks.shape[1])
    left = np.arange(marks.shape[1])
    while len(left):
        first, left = left[0], left[1:]
        queue = [first]
        while queue and len(left):
            at = queue.pop()
            near = _apart(marks, left, [at]) <= bits
            found = left[near]
            root[found] = first
            queue.extend(found.tolist())
            left = left[~near]
    return root


def _linked(group: np.ndarray, marks: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of consecutive groups, as positions."""
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, len(group)])
    ends = np.repeat(starts + sizes, sizes)
    small = np.repeat(sizes <= SHIFTED, sizes)
    a, b = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    at, shift = np.flatnonzero(small), 1
    while len(at):
        at = at[at + shift < ends[at]]
        near = at[_apart(marks, at, at + shift) <= bits]
        a.append(near)
        b.append(near + shift)
        shift += 1
    root = _forest(np.concatenate(a), np.concatenate(b), len(group))
    for first, size in zip(starts[sizes > SHIFTED].tolist(), sizes[sizes > SHIFTED].tolist()):
        root[first : first + size] = first + _searched(marks[:, first : first + size], bits)
    linked = np.flatnonzero(root != np.arange(len(root)))
    return linked, root[linked]


def _verify(bits: int, share: int, group_rows: int, lanes: int):
    """Sorted (lane, mask, value, node, fp ..) rows -> spanning links of nodes,
    and probes of groups that are too large, dealt anew by further bits.

    ``share`` is how many bits the probed lane may differ in, ``bits`` all lanes."""
    names = ["kind", "x", "y", "lane", *lane_names(lanes)]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * lanes]

    def out(kind: str, x: np.ndarray, y: np.ndarray, lane: int | None = None, marks: np.ndarray | None = None) -> pa.RecordBatch:
        n = len(x)
        held = [pa.nulls(n, pa.int64())] * lanes if marks is None else [pa.array(m.view(np.int64)) for m in marks]
        return pa.RecordBatch.from_arrays(
            [pa.array([kind] * n, kinds[0]), pa.array(x, kinds[1]), pa.array(y, kinds[2]), pa.array([lane] * n, kinds[3]), *held], names
        )

    def dealt_anew(key: np.ndarray, node: np.ndarray, marks: np.ndarray) -> Iterator[pa.RecordBatch]:
        lane, mask = int(key[0]), int(key[1]) & (1 << WIDTH) - 1
        rest = [i for i in range(WIDTH) if not mask >> i & 1]
        for piece in np.array_split(np.array(rest, dtype=np.int64), min(share + 1, len(rest))):
            wider = _signed(mask | sum(1 << int(i) for i in piece))
            yield out("probe", np.full(len(node), wider, dtype=np.int64), node, lane, marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, dtype=np.int64)] * (4 + lanes)
        large = None  # the key that is being dealt anew

        def links(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            keys = rows[:3]
            if len(keys[0]) > 1:
                change = np.r_[False, np.any([k[1:] != k[:-1] for k in keys], axis=0)]
                a, b = _linked(np.cumsum(change), np.stack(rows[4:]).view(np.uint64), bits)
                if len(a):
                    yield out("link", rows[3][a], rows[3][b])

        for batch in batches:
            new = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4 + lanes)]
            rows = [np.concatenate([k, n]) for k, n in zip(held, new)]
            if large is not None and len(rows[0]):
                same = np.all([r == k for r, k in zip(rows, large)], axis=0)
                if same.any():
                    yield from dealt_anew(large, rows[3][same], np.stack([r[same] for r in rows[4:]]))
                    rows = [r[~same] for r in rows]
                if len(rows[0]):
                    large = None
            if len(rows[0]):
                last = [r[-1] for r in rows[:3]]
                tail = int(np.argmax(np.all([r == k for r, k in zip(rows, last)], axis=0)))
                yield from links([r[:tail] for r in rows])
                rows = [r[tail:] for r in rows]
                if len(rows[0]) > group_rows and int(last[1]) != -1:
                    large = np.array(last)
                    yield from dealt_anew(large, rows[3], np.stack(rows[4:]))
                    rows = [r[:0] for r in rows]
            held = rows
        yield from links(held)

    return run, ", ".join(f"{n} {k}" for n, k in zip(names, ["string", "long", "long", "int", *["long"] * lanes]))


def links(marks: DataFrame, bits: int = 4, group: int = GROUP, lanes: int = 1) -> DataFrame:
    """Distinct (node, fp ..) -> (a, b): links that join all nodes whose
    fingerprints differ in ``bits`` bits or fewer."""
    names = lane_names(lanes)
    count = marks.count()
    if count < 2:
        return marks.sparkSession.createDataFrame([], "a long, b long")
    share = bits // lanes
    tables = bit_counts(marks, lanes)
    probes = [(lane, _signed(m)) for lane in range(lanes) for m in masks_of(allocate(tables[lane], count, share))]
    laid = F.explode(F.array(*[F.struct(F.lit(lane).alias("lane"), F.lit(m).cast("long").alias("mask")) for lane, m in probes]))
    rows = marks.select(laid.alias("probe"), "node", *names).select("probe.*", "node", *names)
    probed = F.get(F.array(*names), F.col("lane"))
    verify, schema = _verify(bits, share, group, lanes)
    found = None
    while True:
        keyed = rows.select("lane", "mask", F.col("mask").bitwiseAND(probed).alias("value"), "node", *names)
        met = materialize(
            keyed.repartition("lane", "mask", "value").sortWithinPartitions("lane", "mask", "value").mapInArrow(verify, schema)
        )
        new = met.where("kind = 'link'").select(F.col("x").alias("a"), F.col("y").alias("b"))
        found = new if found is None else found.union(new)
        again = met.where("kind = 'probe'")
        if again.isEmpty():
            return found
        rows = again.select("lane", F.col("x").alias("mask"), F.col("y").alias("node"), *names).distinct()


def classes(marked: DataFrame, bits: int, group: int = GROUP, lanes: int = 1) -> DataFrame:
    """(id, fp ..) -> (fp .., component), one row per distinct fingerprint."""
    names = lane_names(lanes)
    node = F.col("fp") if lanes == 1 else F.xxhash64(*names)
    distinct = materialize(marked.groupBy(*names).agg(F.min("id").alias("least")).withColumn("node", node))
    roots = components(links(distinct.select("node", *names), bits, group, lanes))
    rooted = distinct.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component"))
    return rooted.join(smallest, "root").select(*names, "root", "component")


def near_duplicates(
    rows: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = 4, bits: int = 4,
    group: int = GROUP, lanes: int = 1,
) -> DataFrame:
    """(id, tag, fp, root, component): component is the smallest id reachable
    by links, root a name for it that is never null, tag the text's hash."""
    marked = materialize(fingerprints(rows, id_column, text_column, words, lanes))
    found = marked.join(classes(marked, bits, group, lanes), lane_names(lanes))
    return found.select("id", "tag", "fp", "root", "component")


def one_of_each(rows: DataFrame, id_column: str = "doc_id", text_column: str = "text", **how) -> DataFrame:
    """The rows, all columns kept, with one row of each component: the one
    with the smallest id, nulls last, then the smallest hash of its text.
    Rows that have both in common are one document, of which any one row stays.
    """
    found = near_duplicates(rows, id_column, text_column, **how)
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "tag")
    best = found.groupBy("root").agg(F.min(order).alias("best")).select("best.id", "best.tag")
    own = free_prefix("_simhash_", rows.columns)
    best = best.select(F.col("id").alias(own + "id"), F.col("tag").alias(own + "tag"))
    key = [rows[id_column].cast("long").eqNullSafe(F.col(own + "id")), F.xxhash64(rows[text_column].cast("string")) == F.col(own + "tag")]
    kept = rows.join(best, key[0] & key[1])
    # equal rows that stay are told apart after all others are gone
    again = found.groupBy("id", "tag").count().where("count > 1")
    again = again.select(F.col("id").alias(own + "id2"), F.col("tag").alias(own + "tag2"))
    twice = kept.join(again, F.col(own + "id").eqNullSafe(F.col(own + "id2")) & (F.col(own + "tag") == F.col(own + "tag2")), "left")
    columns = [quoted(rows, c) for c in rows.columns]
    single = twice.where(F.col(own + "tag2").isNull()).select(*columns)
    several = twice.where(F.col(own + "tag2").isNotNull()).dropDuplicates([own + "id", own + "tag"]).select(*columns)
    return single.unionAll(several)


def hex_of(column) -> F.Column:
    """A long as 16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(column)), 16, "0")
