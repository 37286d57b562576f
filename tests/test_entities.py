import pytest
from pyspark.sql import functions as F

from trawl.functions.filters import HasAnyLabel
from trawl.operators import delete, entities as e, upsert
from trawl.sources.schemas import RELATIONSHIPS, conform, conform_entities

ROWS = [
    ("p1", "Ada Stone", "wrote the first program", ["Person"], '{"context_id":"north"}', [1.0, 0.0]),
    ("p2", "Bob Ada", None, ["Person"], '{"context_id":"south"}', [0.9, 0.1]),
    ("p3", "Cy", "100% ada_", ["Person"], '{"context_id":7}', [0.0, 1.0]),
    ("o1", "Acme", "works", ["Organization"], None, None),
]


@pytest.fixture(scope="module")
def people(spark):
    schema = "id string, name string, description string, labels array<string>, metadata string, embedding array<float>"
    return conform_entities(spark.createDataFrame(ROWS, schema)).cache()


@pytest.fixture(scope="module")
def links(spark):
    rows = [
        ("p1", "o1", "WORKS_AT", '{"since":1}'), ("p2", "o1", "WORKS_AT", "{}"), ("p1", "p1", "KNOWS", "{}"),
        ("p1", "p2", "KNOWS", "{}"), ("p2", "p1", "KNOWS", "{}"), ("p3", "p1", "KNOWS", "{}"),
    ]
    return conform(spark.createDataFrame(rows, RELATIONSHIPS), RELATIONSHIPS).cache()


def one(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "id string")


def test_text_search(people, make_queries):
    asked = make_queries({"ada": "ADA", "short": "cy", "letter": "k", "under": "a_", "percent": "0%", "all": "", "none": "zzz"})
    rows = e.entity_text_search(asked, people, 10).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append(r.id)
        assert r.score == 1.0
    assert got == {"ada": ["p1", "p2", "p3"], "short": ["p3"], "letter": ["o1"], "under": ["p3"], "percent": ["p3"], "all": ["o1", "p1", "p2", "p3"]}
    first = e.entity_text_search(make_queries({"q": "ada"}), people, 2, entity_filter=HasAnyLabel(["Person"])).collect()
    assert sorted(r.id for r in first) == ["p1", "p2"]


def test_vector_search_and_scope(people, make_queries):
    asked = make_queries({"q": "x"}, {"q": [1.0, 0.0]})
    assert [r.id for r in e.entity_vector_search(asked, people, 2).orderBy("rank").collect()] == ["p1", "p2"]
    before = e.entity_vector_search(asked, people, 1, context="south").collect()
    after = e.entity_vector_search(asked, people, 1, context="south", post_filter=True).collect()
    assert [r.id for r in before] == ["p2"] and after == []
    assert [r.id for r in e.entity_vector_search(asked, people, 3, 0.5).orderBy("rank").collect()] == ["p1", "p2"]
    assert [r.id for r in e.scoped(e.find_by_label(people, "Person"), "north").collect()] == ["p1"]
    assert e.scoped(people, "7").count() == 0


@pytest.mark.parametrize("rows", [200_000, 0])
def test_related(spark, people, links, rows, monkeypatch):
    from trawl.plans import sizing

    monkeypatch.setattr(sizing, "BROADCAST_ROWS", rows)

    def related(name, direction, *ids):
        found = e.find_related(one(spark, *ids), links, people, name, direction)
        return sorted((r.source, r.id) for r in found.collect())

    assert related("WORKS_AT", "OUTGOING", "p1") == [("p1", "o1")]
    assert related("WORKS_AT", "INCOMING", "o1") == [("o1", "p1"), ("o1", "p2")]
    assert related("WORKS_AT", "BOTH", "o1", "p1") == [("o1", "p1"), ("o1", "p2"), ("p1", "o1")]
    # the self-loop once, the pair linked both ways twice
    assert related("KNOWS", "BOTH", "p1") == [("p1", "p1"), ("p1", "p2"), ("p1", "p2"), ("p1", "p3")]
    with pytest.raises(ValueError):
        e.related_ids(one(spark, "p1"), links, "KNOWS", "SIDEWAYS")


def test_save_entities(spark, people):
    rows = spark.createDataFrame(
        [("p1", "Ada", '{"context_id":"west"}'), ("n", "New", '{"context_id":5}'), ("m", "Other", None)],
        "id string, name string, metadata string",
    )
    after = {r.id: r for r in upsert.save_entities(people, rows).collect()}
    assert len(after) == 6
    assert (after["p1"].context_id, after["p1"].description, after["p1"].embedding) == ("west", "", None)
    assert after["n"].context_id is None and after["m"].properties == "{}" and after["m"].labels == []
    assert after["p2"].name == "Bob Ada"


def test_relationship_writes(spark, people, links):
    def added(*rows):
        return spark.createDataFrame(rows, RELATIONSHIPS)

    good = added(("p3", "o1", "WORKS_AT", "{}"))
    assert upsert.create_relationships(links, people, good).count() == 7
    bad = added(
        ("p1", "o1", "WORKS_AT", "{}"), ("p1", "ghost", "KNOWS", "{}"), ("p3", "p2", "KNOWS", "{}"), ("p3", "p2", "KNOWS", "{}"),
    )
    accepted, rejected = upsert.new_relationships(links, people, bad)
    assert accepted.count() == 0
    assert sorted(r.reason for r in rejected.collect()) == ["repeated in batch", "repeated in batch", "stored already", "unknown endpoint"]
    with pytest.raises(ValueError):
        upsert.create_relationships(links, people, bad)
    merged = upsert.merge_relationships(links, added(("p1", "o1", "WORKS_AT", '{"since":2}'), ("p3", "o1", "WORKS_AT", "{}")))
    got = {(r.source_id, r.target_id, r.relationship_name): r.properties for r in merged.collect()}
    assert len(got) == 7 and got["p1", "o1", "WORKS_AT"] == '{"since":2}' and got["p2", "o1", "WORKS_AT"] == "{}"


def test_delete_takes_relationships_along(spark, people, links):
    kept, left, told = delete.delete_entities(one(spark, "p1", "ghost"), people, links)
    assert {r.id for r in kept.collect()} == {"p2", "p3", "o1"}
    assert [(r.source_id, r.target_id) for r in left.collect()] == [("p2", "o1")]
    assert {r.id: r.deleted for r in told.collect()} == {"p1": True, "ghost": False}


def test_embedding_on_save(spark, people):
    import pandas as pd
    from pyspark.sql import types as T

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def lengths(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [float(len(t))])

    rows = spark.createDataFrame([("n", "New", "one")], "id string, name string, description string")
    after = {r.id: r for r in upsert.save_entities(people, rows, embed=lengths).collect()}
    assert after["n"].embedding == [8.0]
