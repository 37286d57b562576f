import pytest
from pyspark.sql import functions as F

from trawl.functions.trigrams import similarity
from trawl.operators.fuzzy_search import fuzzy_matches, fuzzy_search
from trawl.operators.hybrid_search import hybrid_search

TEXTS = {
    "c1": ("Kubernetes schedules containers", [1.0, 0.0]),
    "c2": ("Docker builds container images", [0.0, 1.0]),
    "c3": ("Gold members fly first", None),
    "c4": ("Gold and silver members", [0.6, 0.8]),
}


@pytest.fixture(scope="module")
def chunks(make_elements):
    return make_elements(
        [{"id": i, "text": t, "labels": ["Chunk"], "embedding": v} for i, (t, v) in TEXTS.items()]
        + [{"id": "d", "text": "kubernetes", "labels": ["Document"]}]
    ).cache()


def test_similarity_values(spark):
    df = spark.createDataFrame(
        [("kubernetes", "kubernetis"), ("same", "same"), ("abc", "xyz"), ("", "abc"), ("", ""), ("Two Words", "words two"), ("été", "ete")],
        "a string, b string",
    )
    got = [r[0] for r in df.select(similarity(F.col("a"), F.col("b"))).collect()]
    assert got[0] == pytest.approx(8 / 14) and got[1] == 1.0 and got[2:5] == [0.0, 0.0, 0.0]
    assert got[5] == 1.0 and got[6] < 0.2


def test_fuzzy_equals_brute_force(spark, chunks, make_queries, monkeypatch):
    asked = {"a": "kubernetis", "b": "contaner", "c": "gold membres", "d": "qqq", "e": "dokcer images"}
    queries = make_queries(asked)

    def grams(text):
        import re

        return {("  " + w + " ")[i : i + 3] for w in re.findall(r"[^\W_]+", text.lower()) for i in range(len(w) + 1)}

    want = {}
    for q, text in asked.items():
        for i, (held, _) in TEXTS.items():
            best = max(len(grams(w) & grams(text)) / len(grams(w) | grams(text)) for w in held.lower().split())
            if best > 0.2:
                want[q, i] = round(best, 5)

    def got():
        rows = fuzzy_matches(queries, chunks.where(F.array_contains("labels", "Chunk"))).collect()
        return {(r.query_id, r.id): round(r.score, 5) for r in rows}

    assert got() == want
    from trawl.plans import sizing

    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 0)
    assert got() == want


def test_one_in_five_passes(make_queries, make_elements):
    # two shared of ten, and two shared of eleven trigrams
    elements = make_elements([{"id": i, "text": t, "labels": ["Chunk"]} for i, t in (("x", "abcde"), ("y", "abcdef"))])
    rows = fuzzy_search(make_queries({"q": "abxyz"}), elements).collect()
    assert [(r.id, round(r.score, 6)) for r in rows] == [("x", 0.2)]


def test_thresholds_are_checked(chunks, make_queries):
    with pytest.raises(ValueError):
        fuzzy_search(make_queries({"q": "x"}), chunks, threshold=1.5)
    with pytest.raises(ValueError):
        hybrid_search(make_queries({"q": "x"}), chunks, vector_weight=-0.1)
    with pytest.raises(ValueError):
        fuzzy_search(make_queries({"q": "x"}), chunks, 0)


def test_hybrid_with_fallback(chunks, make_queries):
    vectors = {q: [1.0, 0.0] for q in ("match", "bare", "typo", "none")}
    queries = make_queries({"match": "gold members", "bare": "kubernetes", "typo": "dokcer", "none": "qqqq"}, vectors)
    rows = hybrid_search(queries, chunks, 10).collect()
    got = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        got.setdefault(r.query_id, []).append((r.id, r.strategy))
    # c4 has a vector and ranks above c3, which has none and keeps its text part
    assert got["match"] == [("c4", "hybrid"), ("c3", "hybrid")]
    assert got["bare"] == [("c1", "hybrid")]
    assert got["typo"] == [("c2", "fuzzy")]
    assert "none" not in got
    scores = {(r.query_id, r.id): r.score for r in rows}
    raw = 0.1 / 1.64493406685
    assert scores["bare", "c1"] == pytest.approx(0.7 + 0.3 * raw / (1 + raw), abs=1e-6)
    assert all(0 < s <= 1 for s in scores.values())
    assert all(r.text for r in rows)


def test_threshold_that_empties_a_query_starts_the_fallback(chunks, make_queries):
    queries = make_queries({"q": "kubernetes"}, {"q": [0.0, 1.0]})
    rows = hybrid_search(queries, chunks, 10, 0.5).collect()
    assert [(r.id, r.strategy, r.score) for r in rows] == [("c1", "fuzzy", 1.0)]


def test_weights(chunks, make_queries):
    queries = make_queries({"q": "gold members"}, {"q": [1.0, 0.0]})
    rows = hybrid_search(queries, chunks, 10, vector_weight=0.0, text_weight=1.0).collect()
    by_id = {r.id: r for r in rows}
    assert by_id["c3"].score == pytest.approx(by_id["c3"].text_score, abs=1e-6)
    assert by_id["c3"].text_score > by_id["c4"].text_score


def random_words(seed: int, n: int):
    import random

    rng = random.Random(seed)
    return ["".join(rng.choice("abcd") for _ in range(rng.randint(1, 9))) for _ in range(n)]


@pytest.mark.parametrize("threshold", [0.0, 0.2, 0.35, 0.5, 1.0])
def test_prefix_filter_finds_every_similar_word(spark, make_elements, make_queries, threshold):
    from trawl.operators.fuzzy_search import token_similarities, word_table

    vocabulary = sorted(set(random_words(1, 150)))
    rows = [{"id": f"c{i}", "text": w, "labels": ["Chunk"]} for i, w in enumerate(vocabulary)]
    asked = {f"q{i}": " ".join(random_words(50 + i, 1 + i % 4)) for i in range(20)} | {"none": "?!", "far": "zzzz yyyy"}
    table = word_table(make_elements(rows))
    got = {(r.query_id, r.word): r.similarity for r in token_similarities(make_queries(asked), table, threshold).collect()}
    pairs = spark.createDataFrame([(q, t, w) for q, t in asked.items() for w in vocabulary], "q string, t string, w string")
    want = {
        (r.q, r.w): r.s
        for r in pairs.select("q", "w", similarity(F.col("t"), F.col("w")).alias("s")).where(F.col("s") > threshold).collect()
    }
    assert got == want and (want or threshold == 1.0)


@pytest.mark.parametrize("k", [1, 3, 1000])
def test_best_matches_without_all_matches(spark, make_elements, make_queries, k):
    from trawl.operators.fuzzy_search import best_fuzzy, word_table
    from trawl.plans.topk import top_k

    words = random_words(3, 40)
    rows = [{"id": f"c{i:03}", "text": " ".join(words[(i * j) % 40] for j in range(1, 5)), "labels": ["Chunk"]} for i in range(120)]
    chunks = make_elements(rows)
    queries = make_queries({f"q{i}": w for i, w in enumerate(random_words(9, 12))})
    pick = lambda df: sorted(tuple(r) for r in df.select("query_id", "rank", "id", "score").collect())
    want = pick(top_k(fuzzy_matches(queries, chunks), k))
    assert want and pick(best_fuzzy(queries, chunks, k)) == want
    assert pick(best_fuzzy(queries, chunks, k, words=word_table(chunks))) == want


def test_only_beginnings_of_sets_meet(spark, make_elements, make_queries):
    from trawl.operators import fuzzy_search as fz

    table = fz.word_table(make_elements([{"id": f"c{i}", "text": w, "labels": ["Chunk"]} for i, w in enumerate(random_words(4, 80))]))
    sets = table.words.select("word", F.col("size").alias("nw"), "codes", F.lit(0).alias("missing"))
    met = fz._beginnings(sets, "word", "nw", "codes", "at", 0.5, 10).count()
    assert met < 0.75 * sets.agg(F.sum("nw")).first()[0]
