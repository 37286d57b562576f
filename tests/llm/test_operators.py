"""The pipeline's operators on small tables with awkward rows, against brute force."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trawl.llm import components, decontam, langid, licenses, lines, pieces, repair, simhash, units, urlfilter, warc

LONG = "Word after word stands here. " * 4000
TEXTS = [
    (1, "The cat sat on the mat. It was flat.\nThe cat sat on the mat. It was flat."),
    (1, "The same number, another text."),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (None, "No number here. Under the MIT License, and CC BY-NC 4.0."),
    (5, LONG),
    (6, "Ünïcödé 日本語 😀 text\x00 with ends.\r\nAnd ▁ marks."),
    (7, "The cat sat on the mat. It was flat.\nThe cat sat on the mat. It was flat."),
    (7, "The cat sat on the mat. It was flat.\nThe cat sat on the mat. It was flat."),
]
#: Further columns with names that operators use within.
EXTRA = "doc_id long, text string, id string, tag long, fp string, words int, lang string, start int, kept_spans string"


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(i, t, "x", 1, None, 2, "en", 3, "y") for i, t in TEXTS], EXTRA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], EXTRA)


def by_row(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# -- 1 ----------------------------------------------------------------------


def test_repair_files_round_trip(spark, rows, empty, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    repair.write_ids(rows, path, str(tmp_path / "a"), 1, shard_ids=50)
    tokenizer = Tokenizer.from_file(path)
    want, start = [], 0
    got = sorted(repair.read_ids(spark, str(tmp_path / "a")).collect(), key=lambda r: r.start)
    assert [r.id for r in got] == sorted((i for i, _ in TEXTS), key=lambda i: (i is not None, i))
    encoded = {t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for _, t in TEXTS}
    for r in got:
        assert r.start == start and r.ids in [encoded[t] for i, t in TEXTS if i == r.id]
        start += len(r.ids)
    repair.write_ids(empty, path, str(tmp_path / "b"), 1)
    assert repair.read_digests(spark, str(tmp_path / "b")).count() == 0


@pytest.mark.parametrize("alphabet", [300, 60_000, 200_000])
def test_grammar_decodes_any_stretch(alphabet):
    rng = np.random.default_rng(3)
    ids = np.concatenate([np.tile(rng.integers(0, 9, 30), 40), rng.integers(0, alphabet, 500), np.full(999, 5)]).astype(np.uint32)
    raw = repair.compress(ids, alphabet)
    grammar = repair.Grammar(raw)
    assert len(raw) < 4 * len(ids) and len(grammar.left) > 0
    known = {}
    for number, (left, right) in enumerate(zip(grammar.left.tolist(), grammar.right.tolist()), alphabet):
        known[number] = known.get(left, [left]) + known.get(right, [right])
    assert grammar.lengths.tolist() == [len(x) for x in known.values()]
    assert [i for x in grammar.symbols.tolist() for i in known.get(x, [x])] == ids.tolist()
    for first, stop in ((0, None), (7, 8), (100, 1500), (0, 1), (2000, 99_999), (5, 5)):
        assert grammar.ids(first, stop).tolist() == ids[first:stop].tolist()
    assert repair.Grammar(repair.compress(ids[:0], alphabet)).ids().tolist() == []


def apart(symbols):
    """How often each pair stands, without overlaps."""
    times, last = {}, {}
    for at, pair in enumerate(zip(symbols, symbols[1:])):
        if last.get(pair) != at - 1:
            times[pair], last[pair] = times.get(pair, 0) + 1, at
    return times


@pytest.mark.parametrize("alphabet", [300, 70_000])
def test_grammar_goes_on_until_no_pair_stands_twice(alphabet):
    rng = np.random.default_rng(9)
    bank = [rng.integers(0, 40, rng.integers(2, 9)) for _ in range(60)]
    for ids in (np.concatenate([bank[x] for x in rng.integers(0, 60, 400)]), np.array([7, 8, 9, 7, 8]), np.full(31, 4)):
        grammar = repair.Grammar(repair.compress(ids.astype(np.uint32), alphabet))
        assert grammar.ids().tolist() == ids.tolist() and len(grammar.left) > 0
        assert max(apart(grammar.symbols.tolist()).values(), default=0) < 2
        times = apart(ids.tolist())
        assert times[int(grammar.left[0]), int(grammar.right[0])] == max(times.values())
    # 1 2 stands most often, so it is replaced ahead of 0 1, which overlaps with it
    grammar = repair.Grammar(repair.compress(np.array([0, 1, 2] * 19 + [1, 2], dtype=np.uint32), alphabet))
    assert (grammar.left[0], grammar.right[0]) == (1, 2)
    # what is left of a pair is counted anew: 2 3 stands alone once only
    grammar = repair.Grammar(repair.compress(np.array([1, 2, 3] * 19 + [9, 1, 2, 8, 2, 3], dtype=np.uint32), alphabet))
    assert (2, 3) not in set(zip(grammar.left.tolist(), grammar.right.tolist()))


def test_grammar_of_a_real_shard():
    """Half a million ids of the real alphabet: more rules than 16 bits have room for, no pair twice."""
    coder = repair.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["text"]).column("text").combine_chunks()
    ids = coder.encode(texts.slice(0, 600))[0][: 1 << 19]
    ids = np.concatenate([ids, ids[1000:90_000], np.full(1001, 7), ids[: 1 << 17]]).astype(np.uint32)
    raw = repair.compress(ids, coder.alphabet)
    grammar = repair.Grammar(raw)
    assert coder.alphabet + len(grammar.left) > 1 << 16 and len(raw) < 2 * len(ids)
    assert (grammar.ids() == ids).all()
    assert max(apart(grammar.symbols.tolist()).values()) < 2
    for first, stop in ((5, 9), (300_000, 340_001), (len(ids) - 3, None), (0, 1 << 17)):
        assert (grammar.ids(first, stop) == ids[first:stop]).all()


# -- 2 ----------------------------------------------------------------------


def fits(host, path, rule):
    h, slash, rest = rule.partition("/")
    return (host == h or host.endswith("." + h)) and path.startswith(slash + rest)


@pytest.mark.parametrize("most_bits", [None, 0])
def test_url_rules(spark, monkeypatch, most_bits):
    if most_bits is not None:
        monkeypatch.setattr(urlfilter, "MOST_BITS", most_bits)
    rng = np.random.default_rng(5)
    pick = lambda *xs: xs[rng.integers(len(xs))]
    urls = [None, "", "no scheme/x.net/", "http://", "http://X.NET", "http://x.net?/a", "a://b.net/p://c.org/", "http://x.net/a#/b"]
    urls += [f"http{pick('', 's')}://{pick('a.', 'b.a.', '', 'xx.')}{pick('A', 'b', 'net', 'a.b')}.{pick('net', 'org', 'com')}{pick('', '/')}{pick('', 'en/', 'a/b', 'é')}{pick('', '?q', '#f')}" for _ in range(400)]
    rules = {f"{pick('a', 'b', 'xx.a', 'a.b', 'net')}.{pick('net', 'org')}{pick('', '/', '/en/', '/a', '/a/b')}": pick("allow", "block") for _ in range(25)}
    given = spark.createDataFrame([*rules.items(), (None, "block"), ("/x", "block")], "rule string, verdict string")
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(0, None, "again")], "page_id long, url string, host string")
    got = urlfilter.judge_urls(pages, given).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        rest = (urls[r.id] or "").partition("://")[2]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
        best = max((x for x in rules if fits(host, path, x)), key=lambda x: (len(x), x), default=None)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, best, rules[best] if best else "allow")
    assert urlfilter.judge_urls(pages, given.limit(0)).where("verdict <> 'allow' OR rule IS NOT NULL").count() == 0
    assert urlfilter.judge_urls(pages.limit(0), given).count() == 0


def test_cascade_is_exact_in_its_universe(spark):
    universe = spark.range(20_000).select(F.col("id").cast("string").alias("key"))
    cascade = urlfilter.Cascade(universe.where("key % 7 = 0"), universe.union(universe))
    assert len(cascade.filters) > 2
    wrong = universe.where(cascade.holds(F.col("key")) != (F.col("key") % 7 == 0))
    assert wrong.count() == 0


# -- 3 ----------------------------------------------------------------------


def test_warc_records(spark, tmp_path):
    big = "é" * 100_000
    pages = [(1, "http://a/\r\nX: y", big), (2, None, "small"), (3, "u", big), (4, "u", None), (5, "u", "small"), (None, "u", big), (6, "u", "x" * 999), (7, "u", "x" * 999)]
    df = spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, record string").repartition(3)
    warc.write_archive(df, str(tmp_path / "w"), chunk_bytes=4096)
    got = {(r.id, r.payload_bytes): r for r in warc.read_archive(spark, str(tmp_path / "w")).collect()}
    assert len(got) == len(pages)
    for number, _, html in pages:
        raw = (html or "").encode()
        r = got[number, len(raw)]
        assert r.payload_digest == hashlib.sha1(raw).hexdigest()
        revisit = html == big and number != 3
        assert (r.record_type, r.refers_to) == (("revisit", 3) if revisit else ("response", None))
    chunks = spark.read.parquet(str(tmp_path / "w"))
    assert chunks.agg(F.max(F.length("data"))).first()[0] <= 4096
    record = chunks.groupBy("record").count().orderBy(F.desc("count")).first()[0]
    parts = [(r.head, r.data) for r in chunks.where(F.col("record") == record).orderBy("chunk").collect()]
    raw = b"".join(warc.record_bytes(iter(parts)))
    head, _, block = raw.partition(b"\r\n\r\n")
    length = int(next(x for x in head.split(b"\r\n") if x.startswith(b"Content-Length: "))[16:])
    assert raw.endswith(b"\r\n\r\n") and len(block) == length + 4
    warc.write_archive(df.limit(0), str(tmp_path / "e"))
    assert warc.read_archive(spark, str(tmp_path / "e")).count() == 0


# -- 4 ----------------------------------------------------------------------


def test_line_rules(rows, empty):
    assert lines.failing_rule("Home | About | Contact | Help") == "navigation"
    assert lines.failing_rule("This site uses a cookie policy. Read on.") == "boilerplate"
    assert lines.failing_rule("buy!!! now!!! here!!!") == "punctuation"
    assert lines.failing_rule("A plain sentence, as it should be.") is None
    clean = "One sentence is here, and it says something of its own. " * 1 + " ".join(f"Word{i} follows word{i + 1}." for i in range(40))
    assert lines.judge(clean)[5:7] == (False, True)
    for kept in ("यह घर बहुत बड़ा है।", "یہ گھر بہت بڑا ہے۔", "บ้านหลังนี้ใหญ่มาก และสวย", "это дом.", "他说：「好。」", "- a list of four words", "2) and one more of these", "ይህ ቤት ነው።"):
        assert lines.failing_rule(kept) is None, kept
    for lost, rule in (("Startseite · Über uns · Kontakt", "navigation"), ("Accueil » Page » Suite", "navigation"), ("- two words", "punctuation"), ("यह घर", "punctuation"), ("1) 22 333 4444 55555", "punctuation")):
        assert lines.failing_rule(lost) == rule, lost
    menu = "\n".join(f"a{i} | b{i} | c{i} | d{i}" for i in range(40))
    assert lines.judge(menu)[5:7] == (False, False)
    assert lines.repeated_words(b"a b c x a b c d".split()) == 6
    got = lines.clean_lines(rows)
    assert got.count() == len(TEXTS) and got.where("id = 2 AND n_words = 0 AND base_failed AND NOT kept").count() == 1
    assert lines.clean_lines(empty).count() == 0
    for r in got.where("id = 1").collect():
        assert r.cleaned is not None and r.n_dup_lines in (0, 1)


def test_line_figures_match_brute_force(spark):
    rng = np.random.default_rng(12)
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    docs = [(r.doc_id, r.text) for r in table]
    odd = ["a", "b", "a", "\n", "\t", "\x0b", "\u00a0", "\x1c", "é", "#|", "😀", ". ", " c d ", " < ! "]
    docs += [(10**6 + i, "".join(rng.choice(odd, rng.integers(0, 160)))) for i in range(300)] + [(-1, None), (-2, "")]
    got = lines.clean_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    cut = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t)
    judged = set()
    for r, (i, text) in zip(sorted(got, key=lambda r: r.id), sorted(docs)):
        text = text or ""
        words = cut(text)
        windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        often = Counter(windows)
        inside = {k + d for k, w in enumerate(windows) if often[w] > 1 for d in range(3)}
        own = [x for x in text.split("\n") if cut(x)]
        figures = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(own) - len(set(own)), len(inside))
        assert (r.id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (i, *figures)
        failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
        lost = sum(len(cut(x)) for x in own if lines.failing_rule(x))
        assert r.base_failed == failed and r.kept == (not failed and 2 * lost <= len(words))
        assert r.cleaned == "\n".join(x for x in text.split("\n") if not (cut(x) and lines.failing_rule(x)))
        judged.add((r.base_failed, r.kept))
    assert judged >= {(True, False), (False, True)}


# -- 5 ----------------------------------------------------------------------


def reach(marks, bits):
    root = list(range(len(marks)))
    for i, a in enumerate(marks):
        for j in range(i):
            if sum((x ^ y).bit_count() for x, y in zip(a, marks[j])) <= bits:
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    return root


@pytest.mark.parametrize(("lanes", "bits", "group"), [(1, 4, 1 << 16), (1, 4, 3), (3, 14, 1 << 16), (3, 14, 5)])
def test_links_match_brute_force(spark, lanes, bits, group):
    rng = np.random.default_rng(lanes + group)
    marks = []
    for _ in range(25):
        center = rng.integers(0, 2**63, lanes, dtype=np.uint64)
        for _ in range(12):
            m = center.copy()
            for spot in rng.integers(0, 64 * lanes, rng.integers(0, 2 * bits)):
                m[spot // 64] ^= np.uint64(1 << int(spot % 64))
            marks.append(tuple(m.tolist()))
    signed = [tuple(x - (1 << 64) if x >> 63 else x for x in m) for m in marks]
    names = simhash.lane_names(lanes)
    df = spark.createDataFrame([(i, *m) for i, m in enumerate(signed)], "id long, " + ", ".join(f"{n} long" for n in names))
    found = df.join(simhash.classes(df, bits, group, lanes), names)
    got = dict(found.select("id", "component").collect())
    want = reach(marks, bits)
    assert [got[i] for i in range(len(marks))] == [want.index(r) for r in want]


def test_allocation_is_complete():
    table = np.full((64, 64), 250.0) + np.eye(64) * 250
    for bits in (0, 3, 4, 9):
        parts = simhash.allocate(table, 1000, bits)
        assert sum(t + 1 for _, t in parts) > bits
        spots = [i for part, _ in parts for i in part]
        assert len(spots) == len(set(spots))


def test_near_duplicates_edges(rows, empty):
    got = by_row(simhash.near_duplicates(rows), "id", "component")
    assert len(got) == len(TEXTS)
    assert (2, 2) in got and (3, 2) in got and (4, 2) in got and got.count((7, 1)) == 2 and (None, None) in got
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.one_of_each(rows, words=5, lanes=3, bits=29)
    assert kept.columns == rows.columns and kept.count() == 6
    assert simhash.one_of_each(rows.where("doc_id = 7")).count() == 1


def test_components_of_a_chain(spark):
    edges = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    more = spark.createDataFrame([(100, 101), (101, 100), (200, 200), (None, 3)], "a long, b long")
    got = dict(components.components(edges.union(more)).collect())
    assert got == {i: 0 for i in range(1, 61)} | {101: 100}


# -- 6 ----------------------------------------------------------------------


def test_viterbi_is_optimal():
    rng = np.random.default_rng(1)
    per_text = np.array([0, 1, 7, 4, 0, 6])
    scores = rng.normal(size=(per_text.sum(), 3)) * 3
    path = langid.best_paths(scores, per_text, 2.0)
    first = 0
    for n in per_text:
        own = scores[first : first + n]
        value = lambda p: sum(own[i, x] for i, x in enumerate(p)) - 2.0 * sum(a != b for a, b in zip(p, p[1:]))
        if n:
            best = max(value(p) for p in np.ndindex(*[3] * n))
            assert value(path[first : first + n]) == pytest.approx(best)
        first += n


@pytest.mark.parametrize("n_languages", [130, 300])
def test_viterbi_with_many_languages(n_languages):
    scores = np.zeros((6, n_languages))
    scores[[0, 1, 2], n_languages - 1] = scores[[3, 4, 5], 129] = 50.0
    if n_languages == 130:
        scores[[3, 4, 5]] = np.roll(scores[[3, 4, 5]], -1, axis=1)
    want = [n_languages - 1] * 3 + [128 if n_languages == 130 else 129] * 3
    assert langid.best_paths(scores, np.array([6]), 2.0).tolist() == want


def test_language_spans(spark, rows, empty):
    say = {"en": "the cat and the dog went out into the rain", "de": "der hund und die katze gingen hinaus in den regen", "el": "η γάτα και ο σκύλος"}
    taught = spark.createDataFrame([(t, k) for k, t in say.items()] * 5 + [(None, "en"), ("x", None)], "text string, lang string")
    model = langid.fit(taught)
    assert model.languages == ("de", "el", "en")
    mixed = say["en"] + ". " + say["de"] + ". " + say["el"]
    got = langid._label([mixed, "123", "", "καλημέρα"], model, langid.PENALTY)
    assert [s["lang"] for s in got["spans"].to_pylist()[0]] == ["en", "de", "el"]
    assert got["lang"][1:] == ["und", "und", "el"]
    labelled = langid.label(rows, model)
    assert labelled.count() == len(TEXTS) and labelled.where("id IN (2, 3, 4) AND lang <> 'und'").count() == 0
    nothing = langid.fit(taught.limit(0))
    assert langid.label(rows, nothing).where("lang <> 'und'").count() == 0 and langid.label(empty, model).count() == 0
    kept = langid.in_one_language(rows, model)
    assert kept.columns == rows.columns and kept.where("doc_id IN (2, 3, 4)").count() == 0


# -- 7 ----------------------------------------------------------------------


def test_repeated_units(spark, rows, empty):
    passage = "Here is a passage that stands in many texts of the corpus. So it is. And nobody knows where it came from first."
    docs = [(1, f"Something of its own begins this text right here. {passage}"), (2, f"Another text starts in quite another way today. {passage} The end of it."), (3, "So it is."), (2, None), (None, passage)]
    df = spark.createDataFrame([(i, t, "s") for i, t in docs], "doc_id long, text string, start string")
    found = units.repeated_units(df)
    cut = {(r.id, r.start, r.stop) for r in found.collect()}
    text = docs[1][1]
    assert {text[a:b] for i, a, b in cut if i == 2} == {"Here is a passage that stands in many texts of the corpus.", "So it is.", "And nobody knows where it came from first."}
    assert {i for i, _, _ in cut} == {2, None} and {r.kept_id for r in found.collect()} == {1}
    left = units.remove_spans(df, found)
    by_id = {r.doc_id: r for r in left.where("text IS NOT NULL").collect()}
    assert "".join(text[s.start : s.stop] for s in by_id[2].kept_spans) == by_id[2].text and "passage" not in by_id[2].text
    assert by_id[3].text == "So it is." and left.count() == len(docs)
    assert units.without_repeats(rows).columns == rows.columns and units.without_repeats(empty).count() == 0
    twice = units.repeated_units(rows)
    assert twice.where("id = 7 AND kept_id = 1").count() > 0


def test_units_match_brute_force(spark):
    rng = np.random.default_rng(2)
    bank = [" ".join(f"w{x}" for x in rng.integers(0, 30, rng.integers(1, 14))) + "." for _ in range(25)]
    docs = {i: (" " if i % 2 else "\n").join(bank[x] for x in rng.integers(0, 25, 12)) for i in range(30)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    first, want = {}, {}
    for i in sorted(docs):
        for start, stop, digest in units.units_of(docs[i]):
            if digest in first:
                want.setdefault((i, start, stop), []).append(first[digest])
            first.setdefault(digest, (i, start))
    got = units.repeated_units(df).select("id", "start", "stop", "kept_id", "kept_start").collect()
    assert sorted(map(tuple, got)) == sorted((*span, *min(places)) for span, places in want.items())
    assert max(map(len, want.values())) == 2


def test_whole_lines_go_as_in_plain_line_hashing(spark):
    rng = np.random.default_rng(8)
    say = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 40, n))
    bank = ["Oh.", "So it is.", "}", "Short. Then a sentence of rather more than eight words follows here.", "Yes. No. Perhaps so."]
    bank += [". ".join(say(rng.integers(1, 12)) for _ in range(rng.integers(1, 5))) + "." for _ in range(20)]
    docs = {i: "\n".join(x.upper() if i % 3 else x.replace(" ", " \u00a0") for x in rng.choice(bank, 9)) for i in range(25)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    gone = {i: set() for i in docs}
    for r in units.repeated_units(df).collect():
        gone[r.id].update(range(r.start, r.stop))
    seen, checked = set(), 0
    for i, text in sorted(docs.items()):
        at = 0
        for line in text.split("\n"):
            key = " ".join(line.lower().split())
            if key in seen:
                checked += 1
                assert all(c.isspace() or at + k in gone[i] for k, c in enumerate(line))
            elif key == "oh.":
                assert at not in gone[i]
            seen.add(key)
            at += len(line) + 1
    assert checked > 150


def test_wholly_cut_texts_go(spark):
    one, two = "One line of the corpus that stands in several texts.", "Another line of the corpus that stands in several texts."
    docs = [(1, f"{one}\n\n{two}\nMore."), (2, one), (3, f"{one}\n\n{two}\n"), (4, f"{two} {one}\u00a0"), (5, f"{one}\nIts own."), (6, ""), (7, None), (8, "\n")]
    left = {r.doc_id: r.text for r in units.without_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert left == {1: docs[0][1], 5: "\nIts own.", 6: "", 7: None, 8: "\n"}


# -- 8 ----------------------------------------------------------------------


def test_agenda_equals_library(rows, empty):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    got = by_row(pieces.digest_texts(rows, path), "id", "n_tokens", "ids_sha256", "decoded_sha256", "agrees")
    want = []
    for i, t in TEXTS:
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        raw = np.array(ids, dtype="<u4").tobytes()
        want.append((i, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest(), True))
    assert got == sorted(want, key=repr)
    rng = np.random.default_rng(4)
    odd = ["".join(rng.choice(list("ab  \n\t▁é1.😀<>"), rng.integers(0, 50))) for _ in range(400)] + ["a" * 3000, "▁", " ▁ "]
    ids, agrees = pieces.checked(path).encode(odd)
    assert all(agrees) and [x.tolist() for x in ids] == library.encode(odd, add_bos=True, add_eos=True)
    assert pieces.encode_texts(empty, path).count() == 0
    assert pieces.with_ids(rows.drop("tag"), path).columns[-3:] == ["n_tokens", "ids", "round_trip"]


# -- 9 ----------------------------------------------------------------------


def test_masks_lose_no_stretch():
    from itertools import combinations

    laid = [[i for i, one in enumerate(m) if one == "1"] for m in decontam.MASKS]
    for n in range(decontam.SHORTEST, decontam.WINDOW + 1):
        places = [{p + s for p in m} for m in laid for s in range(n - m[-1])]
        assert all(any(not p & set(gone) for p in places) for gone in combinations(range(n), int(n * 0.2 + 1e-9)))


def test_overlaps_tolerate_substitutions(spark, rows, empty):
    rng = np.random.default_rng(6)
    words = lambda n: [f"v{x}" for x in rng.integers(0, 5000, n)]
    items = {i: words(n) for i, n in enumerate((30, 14, 20, 5, 12, 60))}
    docs, want = {}, set()
    for d in range(40):
        item = d % 6
        text, part = words(80), list(items[item])
        allowed = 0 if len(part) < 12 else int(0.2 * min(len(part), 20) + 1e-9)
        changed = allowed if d < 24 else allowed + 3
        for spot in rng.choice(min(len(part), 20), min(changed, len(part)), replace=False):
            part[spot] = "changed"
        docs[d] = " ".join(text[:40] + part[:20] + text[40:])
        same = sum(a == b for a, b in zip(part[:20], items[item]))
        if same >= 0.8 * min(len(items[item]), 20) and (len(items[item]) >= 12 or same == len(items[item])):
            want.add((d, item))
    benchmark = spark.createDataFrame([(i, " ".join(w), 1) for i, w in items.items()] + [(9, None, 1), (10, "", 1)], "item_id long, text string, words int")
    df = spark.createDataFrame([(d, t, "x") for d, t in docs.items()] + [(0, docs[0], "again"), (None, docs[0], "no number")], "doc_id long, text string, item string")
    got = decontam.overlaps(df, benchmark)
    assert {(r.id, r.item) for r in got.where("id IS NOT NULL").collect()} == want
    assert got.where("id = 0").count() == 1 and got.where("id IS NULL").count() == 1
    kept = decontam.without_overlaps(df, benchmark)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == set(docs) - {d for d, _ in want}
    assert decontam.overlaps(rows, benchmark).count() == 0 and decontam.overlaps(empty, benchmark).count() == 0
    assert decontam.overlaps(df, benchmark.limit(0)).count() == 0


def test_short_items_tolerate_substitutions(spark):
    from itertools import combinations

    docs, want = [], set()
    benchmark = [(n, " ".join(f"i{n}x{k}" for k in range(n))) for n in range(1, decontam.SHORTEST)]
    for n, text in benchmark:
        for many in range(min(n, 3) + 1):
            for gone in combinations(range(n), many):
                part = ["changed" if k in gone else w for k, w in enumerate(text.split())]
                if n - many >= 0.8 * n:
                    want.add((len(docs), n, 2, n - many))
                docs.append((len(docs), " ".join(["a", "b", *part, "c"])))
    found = decontam.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(benchmark, "item_id long, text string"))
    assert {(r.id, r.item, r.start, r.same) for r in found.collect()} == want


# -- 10 ---------------------------------------------------------------------


def test_licenses(spark, rows, empty):
    texts = {
        1: "Released under the MIT License.", 2: "CC BY NC, cc-by-nc and CC_BY_NC", 3: None,
        4: "x " * 50 + "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction.",
        5: "This work is licensed under the GNU General Public License, version 3.", 6: "permission granted free charge software", 7: "All rights reserved.",
    }
    df = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id long, text string, labels string")
    got = {r.id: r for r in licenses.scan_licenses(df).collect()}
    assert (got[1].n_base, got[1].base_labels, got[1].labels, got[1].first_word) == (1, "mit", "mit", 1)
    assert (got[2].n_base, got[2].first_word, got[2].last_word, got[2].n_words) == (3, 0, 7, 10)
    assert (got[3].n_words, got[3].first_word, got[3].labels, got[3].score) == (0, None, "", 0.0)
    assert got[4].labels == "mit" and got[4].base_labels == "" and got[4].score > 0.9
    assert got[5].labels == "gpl-3" and got[6].labels == "" and got[7].labels == "reserved"
    assert licenses.scan_licenses(rows).count() == len(TEXTS) and licenses.scan_licenses(empty).count() == 0


def test_every_template_is_found_and_base_figures_match_brute_force(spark):
    rng = np.random.default_rng(21)
    filler = "the of to and license this software is x1 y2 version 2 permission any über".split()
    say = lambda n: [str(w) for w in rng.choice(filler, n)]
    docs, want = [], {}
    for i, (label, template, phrases) in enumerate(licenses.TEMPLATES):
        other_label, other, _ = licenses.TEMPLATES[int(rng.integers(len(licenses.TEMPLATES)))]
        # a word beyond the mandatory phrases is changed in long notices
        words = template.split()
        free = [k for k, w in enumerate(words) if not any(w in p.split() for p in phrases)]
        if len(words) > 20 and free:
            words[free[0]] = "changed"
        text = " ".join([*say(30), *words, *say(40), other, *say(20)])
        docs.append((i, text.replace(" license ", " License, ").upper() if i % 2 else text))
        want[i] = {label, other_label}
    gone = len(docs)
    for i, (_, template, phrases) in enumerate(licenses.TEMPLATES):
        # the mandatory phrase is broken, all words are there
        docs.append((gone + i, " ".join([*say(5), *reversed(template.split()), *say(5)])))
    bits = ["under", "the", "mit", "license", "cc", "by", "nc", "apache", "version", "2", ",", "-", "é", "CC", "\n"]
    docs += [(1000 + i, " ".join(rng.choice(bits, 60))) for i in range(200)]
    docs += [(2000, "under the MIT license cc by nc cc BY-NC apache license version 2"), (2001, None), (2002, "")]
    got = {r.id: r for r in licenses.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for i, labels in want.items():
        assert labels <= set(got[i].labels.split(",")), (docs[i][1], got[i].labels)
        assert 0.9 <= got[i].score <= 1
    long_ones = [i for i, (_, t, _) in enumerate(licenses.TEMPLATES) if len(t.split()) > 20]
    assert all(licenses.TEMPLATES[i][0] not in got[gone + i].labels.split(",") for i in long_ones)
    for i, text in docs:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        places = [(k, label) for phrase, label in licenses.BASE for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
        at = [k for k, _ in places]
        figures = (len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})))
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == figures
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))


def test_crc_is_of_all_ids(spark, rows, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    repair.write_ids(rows, path, str(tmp_path / "c"), 1)
    ids = {(r.id, r.start): r.ids for r in repair.read_ids(spark, str(tmp_path / "c")).collect()}
    for r in repair.read_digests(spark, str(tmp_path / "c")).collect():
        assert r.crc32 == zlib.crc32(np.array(ids[r.id, r.start], dtype="<u4").tobytes())


# -- names, letters, marks, long stretches ------------------------------------


def test_taken_and_odd_names(spark):
    text = "A whole line of some more words than eight stands here."
    extra = "doc_id long, text string, lang string, _units_id long, _units_tag int, __units_x int, _simhash_id2 int, _leak_tag int, held int, `a.b` int, `c``d` int"
    docs = spark.createDataFrame([(i, t, "en", 1, 2, 3, 4, 5, 6, 7, 8) for i, t in ((1, text), (2, text), (3, f"{text} And one."), (4, None))], extra)
    assert sorted(r.doc_id for r in units.without_repeats(docs).collect()) == [1, 3, 4]
    left = simhash.one_of_each(docs, words=4, bits=4)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} - {3} == {1, 4}
    items = spark.createDataFrame([(1, text)], "item_id long, text string")
    clean = decontam.without_overlaps(docs, items)
    assert clean.columns == docs.columns and [r.doc_id for r in clean.collect()] == [4]
    kept = langid.in_one_language(docs, langid.fit(docs))
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3]


def test_numbers_are_no_letters_and_marks_belong_to_words(spark):
    taught = spark.createDataFrame([("a house stands", "en"), ("हिन्दी भाषा में", "hi")], "text string, lang string")
    model = langid.fit(taught)
    got = langid._label(["½ ²", "Ⅷ ③ 12", "्", "हिन्दी", "x²"], model, langid.PENALTY)
    assert got["lang"][:3] == ["und"] * 3 and got["lang"][3] == "hi" and got["score"][:3] == [0.0] * 3
    assert [len(langid.WORD.findall(t)) for t in ("हिन्दी", "été", "x²y")] == [1, 1, 2]
    assert got["lang"][4] in ("en", "hi")
    for point in range(0x3000):
        text = f"ab{chr(point)}cd"
        assert langid.words_of(text) == langid.WORD.findall(text.lower()), hex(point)


def test_marks_of_the_tokenizer_are_ids_as_in_the_library(spark, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    marks = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    texts = ["plain words", *(f"Some {m}text {m} {m.upper()} END" for m in marks), "".join(marks), None, "more, of it."]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(1)
    repair.write_ids(rows, path, str(tmp_path / "m"), 1)
    got = {r.id: list(r.ids) for r in repair.read_ids(spark, str(tmp_path / "m")).collect()}
    assert got == {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}


def test_long_stretches_take_a_heap():
    import time

    path = public_tokenizers.path("piece_bpe_32k.model")
    merger, library = pieces.Merger(path), sentencepiece.SentencePieceProcessor(model_file=path)
    rng = np.random.default_rng(1)
    letters = list("etaoinshrdlucmfwypvbgkqjxz0123456789+/ABCDEFG中文字語😀é")
    for n in (pieces.LONG_STRETCH + 1, 20_000):
        for pool in (letters, letters[:4], ["a"]):
            text = "".join(rng.choice(pool, n))
            flat, counts = merger.encode([pieces.BLANK + text, "ab"])
            assert flat[: counts[0]].tolist() == library.encode(text) and len(counts) == 2
    start = time.perf_counter()
    text = "".join(rng.choice(letters[:40], 1_000_000))
    flat, _ = merger.encode([pieces.BLANK + text])
    assert time.perf_counter() - start < 60 and flat.tolist() == library.encode(text)
