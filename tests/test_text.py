import math
import random
import time

import pytest
from pyspark.sql import functions as F

from trawl.functions import text as tx
from trawl.functions.text import word_kinds
from trawl.operators import lexicon
from trawl.operators.query_terms import query_terms
from trawl.operators.text_search import prefix_matches, text_matches, text_search

TOPICS = {
    "t1": "Machine learning teaches systems from data and is part of artificial intelligence.",
    "t2": "Deep learning stacks layers in neural networks to find hidden patterns.",
    "t3": "Kubernetes runs containers, deploying and scaling services.",
    "t4": "Flight bookings can be changed or cancelled under the fare rules.",
    "t5": "Rebooking a flight needs a call to the airline a day ahead.",
    "t6": "A relational database answers SQL; SQLite is one such database.",
    "t7": "Vector search finds similar content through embeddings.",
    "t8": "Gold members reach the concierge desk by phone: 1-800-555-0100, the service number of the gold tier.",
    "t9": "Silver members pay a lower change fee than others, gold ones none.",
}


@pytest.fixture(scope="module")
def topics(make_elements):
    rows = [
        {"id": i, "text": t, "labels": ["Chunk"], "metadata": '{"group": "%s"}' % ("low" if i < "t5" else "high")}
        for i, t in TOPICS.items()
    ]
    return make_elements([*rows, {"id": "doc", "text": "machine learning", "labels": ["Document"]}]).cache()


def found(queries, elements, **options):
    rows = text_search(queries, elements, options.pop("k", 10), **options).collect()
    hits = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        assert 0.0 <= r.score <= 1.0
        hits.setdefault(r.query_id, []).append(r.id)
    return hits


def test_clean_text_and_tokens(spark):
    df = spark.createDataFrame([("a", None), ("b", ""), ("c", "  Two words "), ("d", "Café, déjà-vu 42!")], "id string, text string")
    rows = {r.id: r for r in df.withColumn("c", tx.clean_text(F.col("text"))).withColumn("t", tx.tokens(F.col("c"))).collect()}
    assert rows["a"].c == "" and rows["a"].t == [""]
    assert rows["b"].t == [""]
    assert rows["c"].t == ["", "two", "words", ""]
    assert rows["d"].c == "caf djvu 42" and rows["d"].t == ["caf", "djvu", "42"]


def test_positions_count_stop_words(spark):
    df = spark.createDataFrame([("a", "The cats and the dogs, the cat")], "id string, text string")
    rows = {r.lexeme: r.positions for r in lexicon.postings(df, "english").collect()}
    assert rows == {"cat": [2, 7], "dog": [5]}
    simple = {r.lexeme: r.positions for r in lexicon.postings(df, "simple").collect()}
    assert simple["the"] == [1, 4, 6] and simple["cats"] == [2]


def test_positions_have_no_bound(spark, make_queries):
    long = "alpha " * 300 + "filler " * 17_000 + "alpha beta"
    df = spark.createDataFrame([("c", long), ("d", None), ("e", "beta alpha")], "id string, text string")
    rows = {r.lexeme: r.positions for r in lexicon.postings(df, "simple").where("id = 'c'").collect()}
    assert len(rows["alpha"]) == 301 and rows["alpha"][-1] == 17_301 and rows["beta"] == [17_302]
    found = text_matches(make_queries({"q": '"alpha beta"'}), df, kind="simple")
    assert [r.id for r in found.collect()] == ["c"]


def test_english_search(topics, make_queries):
    hits = found(
        make_queries({
            "both": "machine learning", "one": "learning", "stem": "network", "ing": "deploy", "stops": "what is an artificial intelligence",
            "db": "sqlite database", "none": "zxqv", "only stops": "the of and", "gold": "gold service number",
        }),
        topics,
    )
    assert hits["both"] == ["t1"]
    assert sorted(hits["one"]) == ["t1", "t2"]
    assert hits["stem"] == ["t2"] and hits["ing"] == ["t3"] and hits["stops"] == ["t1"] and hits["db"] == ["t6"]
    assert hits["gold"] == ["t8"]
    assert "none" not in hits and "only stops" not in hits


def test_web_syntax(topics, make_queries):
    hits = found(
        make_queries({
            "or": "kubernetes or sqlite", "OR": "kubernetes OR vector", "not": "learning -machine",
            "phrase": '"machine learning"', "reversed": '"learning machine"', "gap": '"part of artificial"',
            "not phrase": 'learning -"deep learning"', "only not": "-flight", "or not": "kubernetes or -learning",
            "leading or": "or flight", "trailing or": "flight or",
        }),
        topics, threshold=0.0,
    )
    assert sorted(hits["or"]) == ["t3", "t6"] and sorted(hits["OR"]) == ["t3", "t7"]
    assert hits["not"] == ["t2"] and hits["phrase"] == ["t1"] and "reversed" not in hits
    assert hits["gap"] == ["t1"] and hits["not phrase"] == ["t1"]
    assert hits["only not"] == ["t1", "t2", "t3", "t6", "t7", "t8", "t9"]
    assert sorted(hits["or not"]) == ["t3", "t4", "t5", "t6", "t7", "t8", "t9"]
    assert sorted(hits["leading or"]) == sorted(hits["trailing or"]) == ["t4", "t5"]


def test_plain_syntax_ignores_operators(topics, make_queries):
    hits = found(make_queries({"q": 'learning -"machine"'}), topics, syntax="plain")
    assert hits["q"] == ["t1"]


def test_rank_constants(spark, make_queries):
    chunks = spark.createDataFrame(
        [("one", "gold"), ("pair", "gold silver"), ("far", "gold " + "x " * 150 + "silver"), ("thrice", "gold gold gold")],
        "id string, text string",
    )
    asked = make_queries({"w": "gold", "and": "gold silver", "not": "gold -silver", "or": "gold or silver", "same": "gold gold"})
    ranks = {(r.query_id, r.id): r.raw_rank for r in text_matches(asked, chunks, kind="simple").collect()}
    single = 0.1 / 1.64493406685
    assert ranks["w", "one"] == pytest.approx(0.0607927, abs=1e-6)
    assert ranks["w", "thrice"] == pytest.approx(single * (1 + 1 / 4 + 1 / 9))
    assert ranks["same", "one"] == pytest.approx(single)
    assert ranks["and", "pair"] == pytest.approx(0.0991032, abs=1e-6)
    assert ranks["and", "far"] == pytest.approx(math.sqrt(0.01 * 1e-30), abs=1e-15)
    assert ranks["not", "one"] == pytest.approx(1e-20)
    assert ranks["or", "pair"] == pytest.approx(single)
    assert ranks["or", "one"] == pytest.approx(single / 2)


def test_threshold_and_ceiling(topics, make_queries):
    asked = make_queries({"q": "gold service number"})
    eased = text_search(asked, topics, 10, 0.9, payload=False).count()
    exact = text_search(asked, topics, 10, 0.99, ceiling=None, payload=False).collect()
    assert eased == 1 and all(r.score >= 0.99 for r in exact)
    low = {r.id for r in text_search(asked, topics, 10, 0.0, payload=False).collect()}
    high = {r.id for r in text_search(asked, topics, 10, 0.3, payload=False).collect()}
    assert high <= low


def test_an_alternative_filter_stays_inside_the_search(topics, make_queries):
    from trawl.functions.filters import Eq, Or

    either = Or([Eq("group", "low"), Eq("group", "high")])
    hits = found(make_queries({"q": "learning"}), topics, metadata_filter=either, syntax="plain", ceiling=None)
    assert sorted(hits["q"]) == ["t1", "t2"]
    one = found(make_queries({"q": "flight"}), topics, metadata_filter=Eq("group", "high"), syntax="plain")
    assert one["q"] == ["t5"]


def test_prefixes(spark, make_queries):
    chunks = spark.createDataFrame(
        [("a", "kubernetes and kubectl"), ("b", "docker"), ("c", "the Kube way"), ("d", "ku")], "id string, text string"
    )
    rows = prefix_matches(make_queries({"k": "kube", "d": "docker"}), chunks).collect()
    assert {(r.query_id, r.id, r.words) for r in rows} == {("k", "a", 2), ("k", "c", 1), ("d", "b", 1)}


def test_index_frequencies_and_shuffled_joins_agree(topics, make_queries, monkeypatch):
    from trawl.operators import text_search as module
    from trawl.plans import sizing

    asked = make_queries({"a": "learning", "b": "gold or flight", "c": "-gold", "d": "gold members"})
    chunks = topics.where(F.array_contains("labels", "Chunk")).select("id", "text")
    want = sorted(tuple(r) for r in text_matches(asked, chunks).select("query_id", "id", F.round("raw_rank", 9)).collect())
    index = lexicon.postings(chunks).cache()
    options = {"index": index, "frequencies": lexicon.document_frequencies(index)}

    def got(**kw):
        return sorted(tuple(r) for r in text_matches(asked, chunks, **kw).select("query_id", "id", F.round("raw_rank", 9)).collect())

    assert got(**options) == want
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(module, "PUSHED_LEXEMES", 0)
    assert got() == want and got(**options) == want


def test_batch_equals_each_query_alone(topics, make_queries):
    texts = {"a": "learning", "b": "gold or flight", "c": '"gold members"'}
    together = found(make_queries(texts), topics)
    for name, text in texts.items():
        assert found(make_queries({name: text}), topics).get(name) == together.get(name)


def test_query_terms_rows(make_queries):
    rows = query_terms(make_queries({"q": 'the Cats -"big dogs" or fish'}), "web", "english").collect()
    assert {(r.clause, r.negated, r.ordered, r.lexeme) for r in rows} == {
        (0, False, False, "cat"), (0, True, True, "big"), (0, True, True, "dog"), (1, False, False, "fish"),
    }
    with pytest.raises(ValueError):
        query_terms(make_queries({"q": "x"}), "fancy")


def test_rank_of_a_text_with_many_hits(spark):
    """Near-linear: 50,000 hits, far pairs by their number."""
    from trawl.functions.ranking import text_rank

    rows = [(1, [list(range(1, 100_000, 4)), list(range(3, 100_000, 4))]), (2, [[1], [5000]]), (3, [[1, 400], [2]]), (4, [[7], []])]
    df = spark.createDataFrame([(i, {"a": a, "b": b}) for i, (a, b) in rows], "id int, hits map<string,array<int>>")
    rank = text_rank(F.col("hits"), F.array(F.lit("a"), F.lit("b")), F.lit(True))
    start = time.perf_counter()
    got = {r.id: r.rank for r in df.select("id", rank.alias("rank")).collect()}
    # all pairs would be a billion steps; these are 5 million, interpreted
    assert time.perf_counter() - start < 30
    near = lambda d: (0.01 / (1.005 + 0.05 * math.exp(d / 1.5 - 2))) ** 0.5
    assert got[1] == pytest.approx(1.0) and got[4] == 1e-20
    assert got[2] == pytest.approx(1e-16, abs=1e-15) and got[3] == pytest.approx(near(1))


def test_rank_equals_the_product_over_all_pairs(spark):
    from trawl.functions.ranking import text_rank

    rng = random.Random(7)
    rows = []
    for i in range(60):
        at = rng.sample(range(1, rng.choice([20, 150, 2000])), rng.randint(2, 18))
        hits = {}
        for p in at:
            hits.setdefault(rng.choice("abc"), []).append(p)
        rows.append((i, {t: sorted(ps) for t, ps in hits.items()}))
    df = spark.createDataFrame(rows, "id int, hits map<string,array<int>>")
    lexemes = F.array(*map(F.lit, "abc"))
    got = {r.id: r.rank for r in df.select("id", text_rank(F.col("hits"), lexemes, F.lit(True)).alias("rank")).collect()}
    for i, hits in rows:
        left, pairs = 1.0, 0
        for a in "abc":
            for b in "abc":
                for p in hits.get(a, []):
                    for q in hits.get(b, []):
                        if a < b:
                            d, pairs = abs(p - q), pairs + 1
                            left *= 1 - 0.1 * (1e-30 if d > 100 else 1 / (1.005 + 0.05 * math.exp(d / 1.5 - 2))) ** 0.5
        assert got[i] == (pytest.approx(1 - left, abs=1e-12) if pairs else 1e-20)


KIND_CASES = {
    "Mail John.Doe+x@Mail.Example.org, now.": ["mail", "john.doe+x@mail.example.org", "now"],
    "See https://Example.com/a/b?c=1#d. Then": ["see", "https://example.com/a/b?c=1#d", "example.com", "then"],
    "It costs $1,299.50 or 3.14, v2.0.1 too": ["it", "costs", "1,299.50", "or", "3.14", "v2.0.1", "too"],
    "state-of-the-art co-op - x": ["state-of-the-art", "state", "of", "the", "art", "co-op", "co", "op", "x"],
    "End.Next a@b http:// -1 10-20": ["end", "next", "a", "b", "http", "1", "10-20", "10", "20"],
    "": [],
}


def test_word_kinds(spark):
    rows = spark.createDataFrame([(t, w) for t, w in KIND_CASES.items()] + [(None, [])], "text string, want array<string>")
    for r in rows.withColumn("got", word_kinds(F.col("text"))).collect():
        assert r.got == r.want, r.text


def test_search_by_kinds_of_words(spark):
    chunks = spark.createDataFrame(
        [("1", "Write to ann@x.org about well-known costs of 9.99"), ("2", "x.org, ann and 9 or 99"), ("3", "Well known since 1999")],
        "id string, text string",
    )
    asked = {"mail": "ann@x.org", "price": "9.99", "whole": "well-known", "part": "known", "several": "well-known cost 9.99"}
    queries = spark.createDataFrame(list(asked.items()), "query_id string, query string")
    want = {("mail", "1"), ("price", "1"), ("whole", "1"), ("part", "1"), ("part", "3"), ("several", "1")}
    index = lexicon.postings(chunks, "english_kinds")
    for held in (None, index):
        found = text_matches(queries, chunks, syntax="plain", kind="english_kinds", index=held).collect()
        assert {(r.query_id, r.id) for r in found} == want


def test_last_part_of_hyphenated_words_is_stemmed(spark):
    vocabulary = spark.createDataFrame([(w,) for w in ("re-runs", "runs", "runs@x.org", "1.5", "the")], "word string")
    got = {r.word: r.lexeme for r in lexicon.ENGLISH_KINDS.lexemes(vocabulary).collect()}
    assert got == {"re-runs": "re-run", "runs": "run", "runs@x.org": "runs@x.org", "1.5": "1.5"}
    assert all(lexicon.ENGLISH_KINDS.lexeme(w) == got.get(w) for w in ("re-runs", "runs", "runs@x.org", "1.5", "the"))


def test_batches_are_cut_by_words():
    """Python holds a bounded number of words at a time, and loses none."""
    import pyarrow as pa

    from trawl.operators.lexicon import SIMPLE, _grouped, slices

    lists = [["a", "b"], [], ["a"] * 9, ["c"], ["d", "d", "e"], []]
    batch = pa.RecordBatch.from_arrays([pa.array(list("uvwxyz")), pa.array(lists, pa.list_(pa.string()))], names=["id", "words"])
    # a batch that is itself a slice starts within its arrays
    for whole in (batch, batch.slice(1), batch.slice(6)):
        cut = list(slices(iter([whole]), 4))
        assert [r for part in cut for r in part.to_pylist()] == whole.to_pylist()
        assert all(part.num_rows == 1 or sum(map(len, part.column(1).to_pylist())) <= 4 for part in cut)
        found = [r for part in cut for out in _grouped(SIMPLE)(iter([part])) for r in out.to_pylist()]
        assert found == [r for out in _grouped(SIMPLE)(iter([whole])) for r in out.to_pylist()]


def test_queries_that_ask_the_same_are_ranked_once(spark, make_queries):
    """Every one of them gets its rows, from a single evaluation."""
    chunks = spark.createDataFrame([("c1", "red green"), ("c2", "red red"), ("c3", "blue")], "id string, text string")
    asked = make_queries({"a": "red", "b": "Red!", "c": "red", "d": "red green", "e": "red green", "f": "blue"})
    found = text_matches(asked, chunks, syntax="plain", kind="simple")
    got = {(r.query_id, r.id): r.raw_rank for r in found.collect()}
    assert got.keys() == {(q, i) for q in "abc" for i in ("c1", "c2")} | {("d", "c1"), ("e", "c1"), ("f", "c3")}
    assert len({got[q, "c2"] for q in "abc"}) == 1 and got["d", "c1"] == got["e", "c1"]
    shape = found._sc._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "simple")
    # the ids of the queries are dealt out after the rank
    assert shape.index("explode(query_ids") < shape.index("explode(map_keys(hits")


def test_postings_of_a_slice_come_in_the_order_of_lexemes(spark):
    from trawl.operators.lexicon import ENGLISH, SIMPLE, postings

    texts = spark.createDataFrame([("1", "b a b z\u00e9 a"), ("2", ""), ("3", "the \U0001d41a \uff41 running runs")], "id string, text string")
    rows = [(r.lexeme, r.id, r.positions) for r in postings(texts.coalesce(1), SIMPLE, by_lexeme=True).collect()]
    assert rows[:2] == [("a", "1", [2, 5]), ("b", "1", [1, 3])] and len(rows) == 8
    assert [r[0].encode() for r in rows] == sorted(r[0].encode() for r in rows)
    assert ("run", "3", [4, 5]) in [(r.lexeme, r.id, r.positions) for r in postings(texts, ENGLISH, by_lexeme=True).collect()]
