import pytest
from pyspark.sql import functions as F

from trawl.functions import filters as f

ROWS = [
    ("hit", ["Person"], '{"owner":"alice","score":0.9,"count":10,"tags":["a","b"],"in":{"x":1,"y":"z"},"ok":true,"a.b":"dotted","path":"/api/v1","code":"ERR-404","big":9007199254740993}'),
    ("miss", ["Place"], '{"owner":"bob","score":0.2,"count":3,"tags":["b"],"in":{"x":2},"ok":false,"path":"/web","code":"err-404"}'),
    ("gone", ["Organization"], '{"other":1}'),
    ("null", [], '{"owner":null,"score":null,"count":null}'),
    ("type", None, '{"owner":1,"score":"high","count":"10","ok":"true"}'),
    ("none", ["Person"], None),
]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(ROWS, "id string, labels array<string>, metadata string").cache()


CASES = [
    (f.Gt("big", 9007199254740992), "hit"),
    (f.Gte("big", 9007199254740994), ""),
    (f.Lt("score", 0.3), "miss"),
    (f.Lte("score", 0.2), "miss"),
    (f.Gt("count", 9.5), "hit type"),
    (f.Eq("owner", "alice"), "hit"),
    (f.Eq("owner", 1), "type"),
    (f.Eq("owner", "1"), ""),
    (f.Eq("owner", None), "null"),
    (f.Eq("count", 10), "hit"),
    (f.Eq("count", 10.0), "hit"),
    (f.Eq("count", "10"), "type"),
    (f.Eq("ok", True), "hit"),
    (f.Eq("in", {"x": 1}), "hit"),
    (f.Eq("in", {"x": 1, "y": "z"}), "hit"),
    (f.Eq("in", {}), "hit miss"),
    (f.Eq("tags", ["b"]), "hit miss"),
    (f.Eq("tags", ["b", "a"]), "hit"),
    (f.Eq("tags", "a"), ""),
    (f.Eq("big", 9007199254740993), "hit"),
    (f.Eq("big", 9007199254740992), ""),
    (f.Eq("a.b", "dotted"), "hit"),
    (f.Eq("it's \"odd\"", "x"), ""),
    (f.Ne("owner", "alice"), "miss gone null type"),
    (f.Gt("score", 0.2), "hit"),
    (f.Gte("score", 0.2), "hit miss"),
    (f.Lt("count", 10), "miss"),
    (f.Lte("count", 10), "hit miss type"),
    (f.In("owner", ["alice", "carol", "1"]), "hit type"),
    (f.Nin("owner", ["alice"]), "miss type"),
    (f.Contains("path", "api"), "hit"),
    (f.Contains("path", "%"), ""),
    (f.ContainsIgnoreCase("path", "API"), "hit"),
    (f.EqIgnoreCase("owner", "ALICE"), "hit"),
    (f.StartsWith("path", "/api/"), "hit"),
    (f.EndsWith("path", "web"), "miss"),
    (f.Like("code", r"ERR-\d{3}"), "hit"),
    (f.Like("code", r"\d{3}$"), "hit miss"),
    (f.And([f.Eq("owner", "alice"), f.Gt("score", 0.5)]), "hit"),
    (f.And([f.Eq("owner", "bob")]), "miss"),
    (f.Or([f.Eq("owner", "alice"), f.Eq("owner", "bob")]), "hit miss"),
    (f.Not(f.Eq("owner", "alice")), "miss gone null type"),
    (f.Not(f.Gt("score", 0.5)), "miss"),
    (f.Not(f.Nin("owner", ["alice"])), "hit"),
    (f.Or([f.And([f.Eq("owner", "alice"), f.Eq("ok", True)]), f.And([f.Eq("owner", "bob"), f.Eq("ok", True)])]), "hit"),
    (f.HasAnyLabel(["Person", "Organization"]), "hit gone none"),
    (f.HasAnyLabel(["Nothing"]), ""),
    (f.Eq("owner", "alice") & f.HasAnyLabel(["Person"]) | ~f.Ne("owner", "bob"), "hit miss"),
]


@pytest.mark.parametrize("node,want", CASES, ids=[str(n)[:60] for n, _ in CASES])
def test_selected_rows(table, node, want):
    assert {r.id for r in table.where(f.column(node)).select("id").collect()} == set(want.split())


def test_combining(table):
    def ids(*filters):
        return {r.id for r in table.where(f.combine(*filters)).collect()}

    assert len(ids()) == len(ROWS)
    assert ids(f.Eq("owner", "alice")) == {"hit"} and ids(None, f.HasAnyLabel(["Place"])) == {"miss"}
    assert ids(f.Or([f.Eq("owner", "alice"), f.Eq("owner", "bob")]), f.HasAnyLabel(["Place"])) == {"miss"}


def test_options(table):
    wild = f.column(f.Contains("path", "a_i"), wildcards=True)
    assert {r.id for r in table.where(wild).collect()} == {"hit"}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        table.where(f.column(f.Gt("score", 0.5), strict_numbers=True)).collect()


def test_errors():
    with pytest.raises(TypeError):
        f.column(f.Filter())
    with pytest.raises(TypeError):
        f.column(f.In("k", [1]), F.lit("{}"))
    with pytest.raises(TypeError):
        f.column(f.Eq("k", object()), F.lit("{}"))
