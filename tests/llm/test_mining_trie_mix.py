"""Hard negatives, the prefix trie and the mix on awkward tables, against brute force."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from trawl.llm import mixing, negatives, prefixtrie

# -- 11 ---------------------------------------------------------------------

NAN, INF = float("nan"), float("inf")
VECTORS = "vec_id long, label string, embedding array<double>, id long, vector string, score int, kind int, `a.b` int"


def vectors():
    rng = np.random.default_rng(5)
    rows = [(i, str(rng.integers(0, 3)), rng.normal(size=4).round(2).tolist()) for i in range(60)]
    rows += [(60 + i, "1", rows[7][2]) for i in range(30)]  # one vector many times
    rows += [rows[3], rows[3], (100, "0", None), (101, None, [1.0] * 4), (None, "0", [1.0] * 4)]
    rows += [(102, "0", [1.0, None, 1.0, 1.0]), (103, "1", [NAN, 0.0, 0.0, 0.0]), (104, "1", [INF, 0.0, 0.0, 0.0])]
    rows += [(105, "2", [0.5]), (106, "2", []), (110, "0", [0.5, 0.25]), (120, "9", [1.0] * 4), (-10, "1", [1.0] * 6)]
    return rows


def mined(rows, positives, k, low, scale=256):
    one = {}
    for i, label, vector in rows:
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = [math.floor(scale * x) for x in vector]
        one[i] = min(one.get(i, (label, whole)), (label, whole))
    out = set()
    for a, (label, vector) in one.items():
        if a % 10:
            continue
        scores = sorted((-sum(x * y for x, y in zip(vector, v)), i, other) for i, (other, v) in one.items())
        best = [(i, -s) for s, i, other in scores if other == label and i != a][:positives]
        for p, ps in best:
            found = [(i, -s) for s, i, other in scores if other != label and low * ps <= -100 * s <= 100 * ps]
            out |= {(a, p, rank, i, ps, s) for rank, (i, s) in enumerate(found[:k], 1)}
    return out


def got_negatives(df, **options):
    found = negatives.hard_negatives(df, df["vec_id"] % 10 == 0, **options).collect()
    names = ("anchor", "positive", "rank", "negative", "positive_score", "negative_score")
    assert len(found) == len(set(found))
    return {tuple(r[n] for n in names) for r in found}


@pytest.mark.parametrize("group_rows, positives, k, low", [(256, 5, 5, 80), (4, 5, 5, 80), (7, 3, 2, 0), (9, 40, 30, 50)])
def test_hard_negatives(spark, monkeypatch, group_rows, positives, k, low):
    monkeypatch.setattr(negatives, "GROUP_ROWS", group_rows)
    rows = vectors()
    df = spark.createDataFrame([(*r, 1, "x", 2, 3, 4) for r in rows], VECTORS).repartition(3)
    want = mined(rows, positives, k, low)
    assert want and got_negatives(df, positives=positives, negatives=k, low_percent=low) == want


def test_groups_are_bounded_in_bytes(spark, monkeypatch):
    monkeypatch.setattr(negatives, "GROUP_BYTES", 400)
    rows = vectors()
    df = spark.createDataFrame([(*r, 1, "x", 2, 3, 4) for r in rows], VECTORS)
    assert got_negatives(df) == mined(rows, 5, 5, 80)


def test_large_components_stay_exact(spark):
    rows = [(i, str(i % 2), [1e7 + i * 3.0, -1e6 * i, 2.0**20]) for i in range(12)]
    df = spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>")
    assert got_negatives(df, scale=100.0) == mined(rows, 5, 5, 80, 100)
    huge = [(i, str(i % 2), [1e300]) for i in range(12)]
    df = spark.createDataFrame(huge, "vec_id long, label string, embedding array<double>")
    found = got_negatives(df)
    assert found and {(x[4], x[5]) for x in found} == {(negatives.MOST, negatives.MOST)}


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert got_negatives(df) == set()
    df = spark.createDataFrame([(0, 1, [1.0]), (1, 1, [1.0])], "vec_id long, label int, embedding array<float>")
    assert got_negatives(df) == set()


# -- 12 ---------------------------------------------------------------------


def naive_close(bits):
    stack, close = [], {}
    for i, b in enumerate(bits):
        if b:
            stack.append(i)
        else:
            close[stack.pop()] = i
    return [close[i] for i in sorted(close)]


@pytest.mark.parametrize("pairs", [1, 2, 40, 700, 5000])
def test_findclose(pairs):
    rng = np.random.default_rng(pairs)
    for lean in (0.5, 0.9):
        bits, depth, left = [], 0, pairs
        while left or depth:
            if left and (not depth or rng.random() < lean):
                bits, depth, left = [*bits, 1], depth + 1, left - 1
            else:
                bits, depth = [*bits, 0], depth - 1
        bits = np.array(bits)
        assert prefixtrie.Parentheses(bits).findclose(np.flatnonzero(bits)).tolist() == naive_close(bits)


TURNS = "conv_id long, turn long, role string, text string, id long, keys int, `a.b` string"


def conversations():
    rng = np.random.default_rng(8)
    rows = []
    for c in [*range(0, 90), -1, -20, -21, 1000, 1003, 1021]:
        own = int(rng.integers(1, 6)) if c != 1003 else 1
        rows += [(c, t, "user" if t % 2 == 0 else "bot", f"say {rng.integers(0, 2)} it") for t in range(own)]
    rows += [(2000 + c, t, "user", f"same {t}") for c in range(60) for t in range(5)]  # many copies
    rows += [(5, None, "user", "no number"), (5, 0, None, None), (5, 0, "", "")]
    rows += [(7, 1, "user", "twice"), (7, 1, "user", "twice"), (None, 1, "user", "nobody")]
    rows += [(9, t, "user", "long \t\n" * 3000) for t in range(40)]
    return rows


def key_of(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def rebuilt(rows, every=20, heads=4):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, role, key_of(role, text), text))
    own = {c: [(r, t) for *_, r, _, t in sorted(x)] for c, x in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        given = c - int(math.fmod(c, every))
        out[c] = tuple(own.get(given, [])[:h] + turns[h:])
    return out


def trie_of(paths):
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            members[paths[c][:d]].append(c)
        ends[paths[c]].append(c)
    children = Counter(n[:-1] for n in members if n)
    leaves, saved = Counter(), Counter()
    for n in members:
        words = len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0
        for d in range(len(n) + 1):
            leaves[n[:d]] += n not in children
            saved[n[:d]] += (len(members[n]) - 1) * words
    return Counter(
        (min(m), len(n), min(members[n[:-1]]) if n else None, len(m), children[n], leaves[n], saved[n],
         hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest())
        for n, m in members.items()
    )


COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def nodes_of(df):
    lists = prefixtrie.spliced(prefixtrie.turn_lists(df), every=20, heads=4)
    return Counter(tuple(r[c] for c in COLUMNS) for r in prefixtrie.prefix_trie(lists).collect())


@pytest.mark.parametrize("shard_rows, piece", [(256, 1 << 16), (3, 2), (20, 7)])
def test_prefix_trie(spark, monkeypatch, shard_rows, piece):
    monkeypatch.setattr(prefixtrie, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(prefixtrie, "SHARD_TURNS", 40 if shard_rows == 3 else 1 << 18)
    rows = conversations()
    want = trie_of(rebuilt(rows))
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], TURNS).repartition(4)
    assert nodes_of(df) == want


def test_pieces_of_ids_across_shards():
    import pyarrow as pa

    batches = [pa.RecordBatch.from_pydict({"node": [1, 1], "ends": ["1,2", "3"]}), pa.RecordBatch.from_pydict({"node": [1, 4], "ends": ["4", "9"]})]
    got = [r for b in prefixtrie.hash_pieces(iter(batches)) for r in b.to_pylist()]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == [{"node": 1, "ends_sha256": sha("1,2,3,4")}, {"node": 4, "ends_sha256": sha("9")}]


def test_no_conversations(spark):
    assert nodes_of(spark.createDataFrame([], TURNS)) == Counter()
    df = spark.createDataFrame([(1, 0, "user", "alone")], "conv_id long, turn long, role string, text string")
    paths = rebuilt([(1, 0, "user", "alone")])
    assert nodes_of(df) == trie_of(paths)


# -- 13 ---------------------------------------------------------------------

DOCS = "doc_id long, text string, source string, id string, size string, key int, target int, `a.b` int, weight int"


def documents():
    rng = np.random.default_rng(2)
    rows = []
    for s, n in (("b", 200), ("a", 60), ("é", 40), ("", 30), (None, 50), ("z", 3), ("Z", 20)):
        rows += [(len(rows) + i, "w " * int(rng.integers(0, 40)), s) for i in range(n)]
    rows += [(7000, "same words here", "b")] * 90  # repeated rows
    rows += [(None, "no id \t\r\x0b", "a"), (None, None, "a"), (7001, "", "only empty"), (7002, "x " * 9000, "long")]
    return rows


def levels(sizes, weights, share, most):
    """Targets by plain repetition."""
    open_, left, out = dict(weights), share * sum(sizes.values()), {}
    while open_:
        total = sum(open_.values())
        above = [s for s in open_ if open_[s] * left > most * sizes[s] * total + 1e-9]
        if not above:
            return out | {s: open_[s] * left / total for s in open_}
        for s in above:
            out[s] = most * sizes[s]
            left -= out[s]
            del open_[s]
    return out


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.mark.parametrize("buckets", [4096, 1, 5])
def test_mix(spark, monkeypatch, buckets):
    monkeypatch.setattr(mixing, "BUCKETS", buckets)
    monkeypatch.setattr(mixing, "ROWS_A_TASK", 16)
    rows = documents()
    df = spark.createDataFrame([(*r, "i", "s", 1, 2, 3, 4) for r in rows], DOCS).repartition(3)
    quality = spark.createDataFrame([(5, 9.0), (5, 1.0), (8, 0.0), (9, NAN), (None, 2.0)], "id long, weight double")
    got = mixing.mix(df, quality=quality, seed="t").collect()
    again = mixing.mix(df.repartition(5), quality=quality, seed="t").collect()
    plain = lambda found: Counter((r.id, r.source, r["size"], r.copies * (r["size"] > 0), r.taken) for r in found)
    assert plain(got) == plain(again)
    assert Counter((r.id, r.source, r["size"]) for r in got) == Counter((i, s, size_of(t)) for i, t, s in rows)

    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += size_of(t)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = levels(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}, 1.5, 2)
    taken, largest = Counter(), Counter()
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        assert r.taken == r.copies * r["size"] and 0 <= r.copies <= 2
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))
    assert all(abs(taken[s] - want[s]) <= largest[s] / 2 for s in sizes)

    # the draw, by hand: all in order of their keys up to the budget
    weight = {5: 5.0, 8: None, 9: None}
    for s in sizes:
        own = []
        for i, t, source in rows:
            if source == s:
                n, w = size_of(t), weight.get(i, 1.0)
                u = (int(hashlib.md5(f"t:{'' if i is None else i}:{n}".encode()).hexdigest()[:13], 16) + 1) / 2**52
                own.append((INF if w is None else -math.log(u) / w, i is not None, i or 0, n))
        epochs = int(want[s] // sizes[s]) if sizes[s] else 0
        left, found = want[s] - epochs * sizes[s], Counter()
        for _, known, i, n in sorted(own):
            found[i if known else None, n] += (epochs + (left > 0 and 2 * left >= n)) * n
            left -= n
        assert +found == +Counter({k: v for k, v in sum((Counter({(r.id, r["size"]): r.taken}) for r in got if r.source == s), Counter()).items()})


def test_better_documents_come_first(spark):
    docs = spark.createDataFrame([(i, "one two three", "s" if i % 2 else "t") for i in range(4000)], "doc_id long, text string, source string")
    quality = docs.select(F.col("doc_id").alias("id"), F.when(F.col("doc_id") % 4 < 2, 4.0).otherwise(1.0).alias("weight"))
    got = mixing.mix(docs, weights=(1, 3), share_percent=50, quality=quality)
    shares = {r.good: r.share for r in got.where("source = 's'").groupBy((F.col("id") % 4 < 2).alias("good")).agg(F.avg("copies").alias("share")).collect()}
    assert shares[True] > 1.5 * shares[False]


def test_mixture_repeats_texts(spark):
    docs = spark.createDataFrame([(i, f"text {i}", "ab"[i > 7], i) for i in range(10)], "doc_id long, text string, source string, copies int")
    drawn = {r.id: r.copies for r in mixing.mix(docs).collect()}
    rows = mixing.mixture(docs).collect()
    assert Counter(r.id for r in rows) == +Counter(drawn) and all(r.text == f"text {r.id}" for r in rows)
    kept = mixing.mix(docs, keep=("copies", "text"))
    assert kept.columns[-2:] == ["_copies", "text"] and {(r.id, r._copies) for r in kept.collect()} == {(i, i) for i in range(10)}


def test_empty_mix(spark):
    df = spark.createDataFrame([], DOCS)
    assert mixing.mix(df).count() == 0 and mixing.mixture(df).count() == 0
    blank = spark.createDataFrame([(1, " ", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert {(r.id, r.target, r.taken) for r in mixing.mix(blank).collect()} == {(1, 0.0, 0), (2, 0.0, 0)}
    whole = mixing.mix(spark.createDataFrame([(1, "a b", "a"), (2, "c", "b")], "doc_id long, text string, source string"), share_percent=200)
    assert {(r.id, r.taken) for r in whole.collect()} == {(1, 4), (2, 2)}
