import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from trawl.functions.term_vectors import TermEmbedder
from trawl.functions.vectors import cosine_similarity
from trawl.operators.entities import entity_vector_search
from trawl.operators.hybrid_search import hybrid_search
from trawl.operators.vector_search import (
    assign_cells, nearest, nearest_approximate, recall, train_cells, vector_search,
)
from trawl.sources.schemas import conform, conform_entities

RNG = np.random.default_rng(3)
# a third of the corpus are copies of one vector, one vector is zero
CORPUS = np.vstack([RNG.normal(size=(400, 12)), np.tile(RNG.normal(size=12), (200, 1)), np.zeros((1, 12))]).astype("float32")
ASKED = np.vstack([RNG.normal(size=(30, 12)), CORPUS[450:451]]).astype("float32")


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(f"c{i:04d}", v.tolist()) for i, v in enumerate(CORPUS)] + [("missing", None)]
    return spark.createDataFrame(rows, "id string, embedding array<float>").repartition(7).cache()


@pytest.fixture(scope="module")
def asked(spark):
    return spark.createDataFrame([(f"q{i}", v.tolist()) for i, v in enumerate(ASKED)], "query_id string, embedding array<float>")


def brute(k):
    a, b = ASKED.astype("float64"), CORPUS[:-1].astype("float64")
    scores = (a @ b.T) / np.linalg.norm(a, axis=1)[:, None] / np.linalg.norm(b, axis=1)
    out = {}
    for q, row in enumerate(scores):
        best = sorted(((-s, f"c{i:04d}") for i, s in enumerate(row)))[:k]
        out[f"q{q}"] = [i for _, i in best]
    return out


def ids(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append(r.id)
    return out


@pytest.mark.parametrize("k", [1, 10, 1500])
def test_exact_top_k(corpus, asked, k):
    assert ids(nearest(asked, corpus, k)) == brute(k)


def test_many_query_blocks_give_the_same(corpus, asked):
    assert ids(nearest(asked, corpus, 10, block_bytes=12 * 4 * 5)) == brute(10)


def test_small_slices_give_the_same(corpus, asked, monkeypatch):
    from trawl.operators import vector_search as module

    monkeypatch.setattr(module, "SLICE_ROWS", 3)
    monkeypatch.setattr(module, "SLICE_QUERIES", 2)
    unit = module.scan_kernel(["a", "b", "c"], ASKED[:3].astype("float64"), None, 5)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays(
        [pa.array([f"c{i:04d}" for i in range(len(CORPUS))]), pa.array(CORPUS.tolist(), pa.list_(pa.float32()))], names=["id", "embedding"]
    )
    got = pa.Table.from_batches(list(unit(iter([batch.slice(0, 100), batch.slice(100)])))).to_pydict()
    want = brute(5)
    assert got["id"] == want["q0"] + want["q1"] + want["q2"]


def test_probing_every_cell_is_exact_and_fewer_cells_recall(corpus, asked):
    centres = train_cells(corpus, 12)
    indexed = assign_cells(corpus, centres).cache()
    assert indexed.count() == len(CORPUS)
    assert ids(nearest_approximate(asked, indexed, centres, 10, probes=12)) == brute(10)
    some = nearest_approximate(asked, indexed, centres, 10, probes=6)
    total = recall(some, nearest(asked, corpus, 10)).agg(F.sum("found"), F.sum("wanted")).first()
    assert total[0] / total[1] > 0.7


def test_cosine_expression(spark):
    rows = [([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 1.0]), (None, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "a array<float>, b array<float>")
    got = [r[0] for r in df.select(cosine_similarity(F.col("a"), F.col("b"))).collect()]
    assert got[0] == pytest.approx(0.96) and got[1:] == [None, None]


def test_search_skips_other_elements_and_filters_first(make_elements, make_queries):
    from trawl.functions.filters import Eq

    rows = [
        {"id": "near", "labels": ["Chunk"], "embedding": [1.0, 0.0], "metadata": '{"lang":"en"}', "text": "x"},
        {"id": "other", "labels": ["Chunk"], "embedding": [0.9, 0.1], "metadata": '{"lang":"de"}', "text": "y"},
        {"id": "root", "labels": ["Document"], "embedding": [1.0, 0.0]},
        {"id": "bare", "labels": ["Chunk"], "text": "z"},
    ]
    elements, asked = make_elements(rows), make_queries({"q": "x"}, {"q": [1.0, 0.0]})
    assert ids(vector_search(asked, elements, 5)) == {"q": ["near", "other"]}
    assert ids(vector_search(asked, elements, 1, metadata_filter=Eq("lang", "de"), ceiling=None)) == {"q": ["other"]}
    assert vector_search(make_queries({"q": "x"}), elements, 5).count() == 0


def test_lengths_must_agree(spark, corpus):
    wrong = spark.createDataFrame([("q", [1.0, 2.0])], "query_id string, embedding array<float>")
    with pytest.raises(Exception, match="every embedding must have 2"):
        nearest(wrong, corpus, 3).collect()


def test_close_scores_keep_their_order(spark):
    angle = lambda c: [c, (1 - c * c) ** 0.5]
    rows = spark.createDataFrame([("a", angle(0.9000001)), ("b", angle(0.9000004))], "id string, embedding array<float>")
    one = spark.createDataFrame([("q", [1.0, 0.0])], "query_id string, embedding array<float>")
    assert [r.id for r in nearest(one, rows, 1).collect()] == ["b"]


def hashed(texts, corpus):
    """Brute force of the hashed words."""
    split = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    digest = lambda w: hashlib.md5(w.encode()).hexdigest()
    texts_with = Counter(b for t in corpus for b in {int(digest(w)[:4], 16) for w in split(t)})
    out = []
    for t in texts:
        vector = [0.0] * 64
        for h in map(digest, split(t)):
            bucket = int(h[:4], 16)
            weight = math.log((1 + len(corpus)) / (1 + texts_with[bucket])) + 1
            vector[bucket % 64] += weight if h[4] < "8" else -weight
        out.append(vector if split(t) else None)
    return out


def test_hashed_term_vectors(spark, make_elements):
    texts = ["The cat sat on the mat", "the dog, the cat", "Äpfel und 日本語", "", None, " ?! ", "of the the the", "cat"]
    rows = spark.createDataFrame([(str(i), t, [0.5]) for i, t in enumerate(texts)], "id string, text string, embedding array<double>")
    embedder = TermEmbedder.fit(rows)
    got = {r.id: r.embedding for r in embedder(rows, key="id", text="text").collect()}
    for i, want in enumerate(hashed(texts, texts)):
        assert (got[str(i)] is None) == (want is None)
        assert want is None or np.allclose(got[str(i)], want)
    # words that the corpus lacks have a weight too
    other = embedder(spark.createDataFrame([("q", "zebra cat")], "query_id string, query string")).collect()[0].embedding
    assert np.allclose(other, hashed(["zebra cat"], texts)[0])
    none = rows.limit(0)
    assert TermEmbedder.fit(none)(none, key="id", text="text").count() == 0


def test_searches_embed_their_queries(spark, make_elements):
    chunks = make_elements([
        {"id": str(i), "text": t, "labels": ["Chunk"]}
        for i, t in enumerate(["apples and pears", "pears alone", "trains and planes", "apples apples"])
    ])
    embedder = TermEmbedder.fit(chunks)
    held = conform(embedder(chunks, key="id", text="text"))
    queries = spark.createDataFrame([("a", "apples"), ("p", "pears")], "query_id string, query string")
    first = lambda found: {r.query_id: r.id for r in found.where("rank = 1").collect()}
    assert first(vector_search(queries, held, 2, embed=embedder)) == {"a": "3", "p": "1"}
    found = hybrid_search(queries, held, 2, embed=embedder).collect()
    assert {r.query_id: r.id for r in found if r.rank == 1} == {"a": "3", "p": "1"}
    people = held.select("id", F.col("text").alias("name"), F.col("text").alias("description"), "labels", "metadata", "embedding")
    assert first(entity_vector_search(queries, conform_entities(people), 2, embed=embedder)) == {"a": "3", "p": "1"}


def test_term_vectors_of_repeated_keys_and_long_texts(spark, monkeypatch):
    """One Arrow pass a text: no row a word, texts of one key summed, none for texts without a word."""
    import hashlib
    import math

    from trawl.functions.term_vectors import DIMENSION, bucket_weights, term_vectors

    texts = [("a", "one two two"), ("a", "three"), ("b", " ... "), ("c", None), (None, "four"), ("d", "x " * 300_000), ("e", "")]
    rows = spark.createDataFrame(texts, "id string, text string").coalesce(1)
    weights = bucket_weights(rows)

    def digest(word):
        found = hashlib.md5(word.encode()).hexdigest()
        return int(found[:4], 16), 1.0 if found[4] < "8" else -1.0

    having = {}
    for _, text in texts:
        for bucket in {digest(w)[0] for w in (text or "").split() if w.isalnum()}:
            having[bucket] = having.get(bucket, 0) + 1
    weigh = {b: math.log(8 / (1 + n)) + 1 for b, n in having.items()}
    want = {}
    for key, text in texts:
        for word in (text or "").split():
            if word.isalnum():
                bucket, sign = digest(word)
                want.setdefault(key, [0.0] * DIMENSION)[bucket % DIMENSION] += sign * weigh[bucket]
    found = term_vectors(rows, weights, "id", "text")
    assert "Generate" not in found._sc._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "formatted")
    got = {r.id: r.embedding for r in found.collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
