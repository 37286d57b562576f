import datetime as dt

import pytest
from pyspark.sql import functions as F

from trawl.functions.filters import HasAnyLabel
from trawl.operators import delete, lookup, upsert
from trawl.sources.schemas import ELEMENTS, check_dimension, conform
from trawl.sources.store import ContentStore
from trawl.streaming.upkeep import derived_stream, upkeep

OLD = dt.datetime(2020, 1, 1)


@pytest.fixture(scope="module")
def now(spark):
    return F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")


@pytest.fixture(scope="module")
def base(make_elements):
    return make_elements([
        {"id": "a", "text": "old a", "urtext": "raw a", "labels": ["Chunk"], "embedding": [1.0], "ingestion_timestamp": OLD,
         "raw_content": b"x", "content_type": "text/plain", "metadata": "{}"},
        {"id": "b", "text": "old b", "labels": ["Chunk"], "embedding": [2.0], "ingestion_timestamp": OLD},
    ]).cache()


def by_id(df):
    return {r.id: r for r in df.collect()}


def updates(spark, rows):
    return spark.createDataFrame(rows, "id string, text string, labels array<string>, n int")


def test_save_keeps_what_it_does_not_set(spark, base, now):
    new = updates(spark, [("a", "New A!", ["Chunk"], 1), ("c", "new c", ["Chunk"], 1)])
    after = by_id(upsert.save_elements(base, new, now=now))
    assert set(after) == {"a", "b", "c"}
    a, c = after["a"], after["c"]
    assert (a.text, a.urtext, a.metadata, a.clean_text, a.tokens) == ("New A!", None, None, "new a", ["new", "a"])
    assert (a.embedding, a.ingestion_timestamp, bytes(a.raw_content), a.content_type) == ([1.0], OLD, b"x", "text/plain")
    assert c.embedding is None and c.ingestion_timestamp == dt.datetime(2025, 1, 1)
    assert after["b"].text == "old b"


def test_upserts_are_idempotent_and_the_last_duplicate_wins(spark, base, now):
    new = updates(spark, [("a", "first", ["Chunk"], 1), ("a", "last", ["Chunk"], 3), ("a", "middle", ["Chunk"], 2)])
    once = upsert.save_elements(base, new, order="n", now=now)
    twice = upsert.save_elements(once, new, order="n", now=now)
    assert by_id(once)["a"].text == "last"
    assert by_id(once) == by_id(twice)


def test_chunks_without_a_vector_lose_it(spark, base, now):
    new = updates(spark, [("a", "t", ["Chunk"], 1), ("b", "t", ["Chunk"], 1)])
    vectors = spark.createDataFrame([("b", [9.0])], "id string, embedding array<float>")
    after = by_id(upsert.persist_chunks(base, new, vectors, now=now))
    assert after["a"].embedding is None and after["b"].embedding == [9.0]


def test_documents_with_content(spark, base, now):
    new = base.where("id = 'a'").select("id", "text", "labels").withColumns(
        {"raw_content": F.lit(b"bytes"), "content_type": F.lit("text/html")}
    )
    a = by_id(upsert.save_documents(base, new, now=now))["a"]
    assert (bytes(a.raw_content), a.content_type, a.urtext) == (b"bytes", "text/html", "raw a")


def test_conform_and_dimension(spark):
    df = conform(spark.createDataFrame([("x", [1.0, 2.0], "extra")], "id string, embedding array<float>, other string"))
    assert df.columns == [f.name for f in ELEMENTS.fields]
    assert check_dimension(df, 2).count() == 1
    with pytest.raises(Exception, match="expected 3"):
        check_dimension(df, 3).select("embedding").collect()
    with pytest.raises(ValueError):
        check_dimension(df, 0)


def tree(make_elements):
    doc = ["Document"]
    return make_elements([
        {"id": "r1", "uri": "u1", "labels": doc}, {"id": "s1", "parent_id": "r1", "labels": ["Section"]},
        {"id": "c1", "parent_id": "s1", "labels": ["Chunk"]}, {"id": "c2", "parent_id": "c1", "labels": ["Chunk"]},
        {"id": "r2", "uri": "u2", "labels": doc}, {"id": "c3", "parent_id": "r2", "labels": ["Chunk"]},
        {"id": "r3", "uri": "u2", "labels": doc},
        {"id": "root only", "uri": "u3", "labels": ["ContentRoot"]},
        {"id": "orphan", "parent_id": "nowhere", "labels": ["Chunk"]},
        {"id": "l1", "uri": "loop", "parent_id": "l2", "labels": doc}, {"id": "l2", "parent_id": "l1", "labels": ["Section"]},
    ])


def test_tree_delete(spark, make_elements):
    uris = spark.createDataFrame([("u1",), ("u2",), ("u3",), ("loop",), ("absent",)], "uri string")
    kept, counts = delete.delete_trees(uris, tree(make_elements))
    assert {r.id for r in kept.collect()} == {"root only", "orphan"}
    assert {r.root_uri: r.deleted for r in counts.collect()} == {"u1": 4, "u2": 3, "loop": 2}


def test_tree_delete_beyond_the_broadcast_check(spark, make_elements, monkeypatch):
    from trawl.plans import sizing

    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 0)
    uris = spark.createDataFrame([("u1",)], "uri string")
    assert delete.delete_trees(uris, tree(make_elements))[1].collect()[0].deleted == 4


def test_deep_trees_take_few_rounds(spark, monkeypatch):
    """A chain of 10,000, a long circle below a root's child, and a root within another's tree."""
    deep, ring = 10_000, 37
    rows = [(f"d{i}", f"d{i - 1}" if i else None) for i in range(deep)]
    rows += [(f"o{i}", f"o{(i - 1) % ring}") for i in range(ring)]
    elements = spark.createDataFrame(rows, "id string, parent_id string").repartition(4)
    roots = spark.createDataFrame([("top", "d0"), ("mid", "d9000"), ("ring", "o5"), ("ring", "o9")], "root_uri string, id string")
    rounds = []
    kept = delete.materialize
    monkeypatch.setattr(delete, "materialize", lambda df: rounds.append(1) or kept(df))
    found = {(r.root_uri, r.id) for r in delete.descendants(roots, elements).collect()}
    want = {("top", f"d{i}") for i in range(deep)} | {("mid", f"d{i}") for i in range(9000, deep)}
    assert found == want | {("ring", f"o{i}") for i in range(ring)}
    assert len(rounds) <= 2 * 16


def test_lookups(spark, make_elements):
    elements = make_elements([
        {"id": "d", "uri": "u", "labels": ["Document"], "metadata": '{"title":"T","ingestionTimestamp":"2024-01-02T03:04:05Z"}', "ingestion_timestamp": OLD},
        {"id": "m", "uri": "u", "labels": ["ContentRoot"], "metadata": '{"ingestionTimestamp":1704164645000}'},
        {"id": "n", "uri": None, "labels": ["Document"], "metadata": " ", "raw_content": b"n"},
        {"id": "c", "labels": ["Chunk"], "text": "t", "metadata": None},
        {"id": "x", "labels": None},
    ])
    one = spark.createDataFrame([("c",), ("c",), ("zzz",)], "id string")
    assert [r.id for r in lookup.find_by_id(one, elements).collect()] == ["c"]
    assert [r.id for r in lookup.find_chunks(spark.createDataFrame([("d",)], "id string"), elements).collect()] == []
    assert lookup.find_chunks(one.limit(0), elements).count() == 0
    roots = {r.id: r for r in lookup.as_roots(elements.where("id != 'c'")).collect()}
    assert roots["d"].title == "T" and roots["m"].title == "" and roots["n"].uri == "" and roots["n"].metadata == {}
    assert roots["d"].ingested_at == roots["m"].ingested_at and roots["n"].ingested_at is None
    found = lookup.roots_exist(spark.createDataFrame([("u",), ("v",)], "uri string"), elements)
    assert {r.uri: r.found for r in found.collect()} == {"u": True, "v": False}
    read = {r.id: r for r in lookup.as_read(elements).collect()}
    assert read["c"].urtext == "t" and read["c"].parent_id == "" and read["c"].kind == "Chunk" and read["c"].metadata == {}
    assert read["x"].labels == ["ContentElement"] and read["d"].text is None
    assert [r.id for r in lookup.raw_content(spark.createDataFrame([("n",), ("m",)], "id string"), elements).collect()] == ["n"]
    stats = lookup.statistics(elements).first()
    assert (stats.document_count, stats.chunk_count, stats.content_element_count) == (2, 1, 5)
    assert [r.id for r in lookup.find_all(elements, "ContentRoot").collect()] == ["d", "n"]
    lookup.require_searchable("Chunk")
    with pytest.raises(ValueError):
        lookup.require_searchable("Document")


def chunk_rows(spark, rows):
    return spark.createDataFrame([(i, t, ["Chunk"]) for i, t in rows], "id string, text string, labels array<string>")


def test_bucketed_store(spark, tmp_path, now):
    store = ContentStore(spark, str(tmp_path / "s"), kind="english", buckets=4)
    assert store.elements.read().count() == 0
    store.save(chunk_rows(spark, [(f"c{i}", f"word{i} learning") for i in range(20)]), upsert.save_elements, now=now)
    store.save(chunk_rows(spark, [("c3", "rewritten text"), ("new", "fresh")]), upsert.save_elements)
    held = by_id(store.elements.read())
    assert len(held) == 21 and held["c3"].text == "rewritten text" and held["c3"].ingestion_timestamp == dt.datetime(2025, 1, 1)
    lexemes = {r.lexeme for r in store.postings.read().where("id = 'c3'").collect()}
    assert lexemes == {"rewritten", "text"}
    assert store.without_postings().count() == 0
    asked = spark.createDataFrame([("c3",), ("nope",)], "id string")
    assert [r.id for r in store.elements.lookup(asked).collect()] == ["c3"]


def test_store_backfill_delete_and_search(spark, tmp_path, make_queries):
    from trawl.operators.text_search import text_search

    store = ContentStore(spark, str(tmp_path / "s"), buckets=4)
    rows = conform(chunk_rows(spark, [("c1", "machine learning"), ("c2", "learning to fly"), ("c3", " ")])).withColumn("parent_id", F.lit("root"))
    root = conform(spark.createDataFrame([("root", "u", ["Document"])], "id string, uri string, labels array<string>"))
    store.elements.append(rows.unionByName(root))
    assert store.backfill() == 2 and store.backfill() == 0
    asked, elements, index = make_queries({"q": "learning"}), store.elements.read(), store.postings.read()
    assert {r.id for r in text_search(asked, elements, 10, index=index).collect()} == {"c1", "c2"}
    ranked = text_search(asked, elements, 10, index=index, entity_filter=HasAnyLabel(["Chunk"]), payload=False)
    assert {r.id: r.text for r in store.elements.attach(ranked).collect()} == {"c1": "machine learning", "c2": "learning to fly"}
    from trawl.operators.hybrid_search import hybrid_search

    # rows that the caller has narrowed: the index finds nothing outside of them
    some = elements.where("id <> 'c1'")
    for payload in (True, False):
        for search in (text_search, hybrid_search):
            with_vector = asked.withColumn("embedding", F.lit(None).cast("array<float>"))
            hits = search(with_vector, some, 1, index=index, payload=payload).collect()
            assert [r.id for r in hits] == ["c2"] == [r.id for r in search(with_vector, some, 1, payload=payload).collect()]
    none = text_search(asked, elements, 10, index=index, entity_filter=HasAnyLabel(["Other"]), payload=False)
    assert none.count() == 0
    assert [tuple(r) for r in store.delete_trees(spark.createDataFrame([("u",)], "uri string")).collect()] == [("u", 4)]
    assert store.elements.read().count() == 0 and store.postings.read().count() == 0


def test_stream_upkeep(spark, tmp_path):
    store = ContentStore(spark, str(tmp_path / "s"), kind="simple", buckets=4)
    inbox, progress = str(tmp_path / "inbox"), str(tmp_path / "progress")
    schema = "id string, text string, labels array<string>, n int"

    def arrive(rows):
        updates(spark, rows).coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(schema).parquet(inbox)
        run = upkeep(stream, store, progress, order="n").trigger(availableNow=True).start()
        run.awaitTermination()

    arrive([("a", "one two", ["Chunk"], 1), ("b", "three", ["Chunk"], 1), ("a", "two three", ["Chunk"], 2)])
    arrive([("b", "four", ["Chunk"], 1)])
    assert {r.id: r.text for r in store.elements.read().collect()} == {"a": "two three", "b": "four"}
    held = {(r.id, r.lexeme) for r in store.postings.read().collect()}
    assert held == {("a", "two"), ("a", "three"), ("b", "four")}


def test_derived_columns_on_a_stream(spark, tmp_path):
    conform(chunk_rows(spark, [("a", "Some Text!")])).write.parquet(str(tmp_path / "in"))
    stream = derived_stream(spark.readStream.schema(ELEMENTS).parquet(str(tmp_path / "in")))
    run = stream.writeStream.format("memory").queryName("derived").trigger(availableNow=True).start()
    run.awaitTermination()
    assert spark.table("derived").first().tokens == ["some", "text"]


def test_store_checks_vectors_and_leaves_no_files(spark, tmp_path):
    from pathlib import Path

    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    before = {p.name for p in folder.iterdir()} if folder.exists() else set()
    store = ContentStore(spark, str(tmp_path / "d"), buckets=2, dimension=2)
    rows = chunk_rows(spark, [("c1", "some words")])
    store.save(rows.withColumn("embedding", F.array(F.lit(1.0), F.lit(2.0)).cast("array<float>")), upsert.save_chunks)
    assert {p.name for p in folder.iterdir()} == before
    with pytest.raises(Exception, match="expected 2"):
        store.save(rows.withColumn("embedding", F.array(F.lit(1.0)).cast("array<float>")), upsert.save_chunks)
    assert store.elements.read().count() == 1 and store.postings.read().count() == 1


@pytest.mark.parametrize("rows", [0, 1000])
def test_saves_beyond_the_row_check_keep_postings_in_step(spark, tmp_path, now, monkeypatch, rows):
    """Whole buckets analyzed anew, or the changed elements only: the same store."""
    monkeypatch.setattr("trawl.sources.store.BROADCAST_ROWS", rows)
    monkeypatch.setattr("trawl.sources.store.FILES_A_BUCKET", 2)
    store = ContentStore(spark, str(tmp_path / "s"), kind="simple", buckets=3)
    held = {}
    for turn in range(5):
        fresh = {f"c{n}": None if n % 7 == turn else f"Word{n % 3} turn{turn} word{n % 3}" for n in range(turn * 5, turn * 5 + 20)}
        held |= fresh
        batch = spark.createDataFrame(list(fresh.items()), "id string, text string").withColumn("labels", F.array(F.lit("Chunk")))
        store.save(batch, upsert.save_chunks, now=now)
    want = {(i, w): [k + 1 for k, x in enumerate(t.lower().split()) if x == w] for i, t in held.items() if t for w in t.lower().split()}
    assert {(r.id, r.lexeme): r.positions for r in store.postings.read().collect()} == want
    rows_held = store.elements.read().collect()
    assert {r.id: r.text for r in rows_held} == held and len(rows_held) == len(held)
    assert all(r.clean_text == (r.text or "").lower() and r.tokens == (r.text or "").lower().split(" ") for r in rows_held)
    # a shuffle on the key gives a task rows of few buckets, and files do not pile up
    names = [name for files in store.elements.files_of(range(3)).values() for name in files if not name.startswith(".")]
    assert names and all("zstd" in name for name in names) and len(names) <= 3 * 2
    # values that differ from what the text gives stay as they were
    own = spark.createDataFrame([("x", "A B", "own", ["o"])], "id string, text string, clean_text string, tokens array<string>")
    other = spark.createDataFrame([("y", "Z")], "id string, text string")
    after = {r.id: r for r in upsert.save_elements(conform(own), other, now=now).collect()}
    assert (after["x"].clean_text, after["x"].tokens) == ("own", ["o"]) and (after["y"].clean_text, after["y"].tokens) == ("z", ["z"])


def test_a_few_changes_leave_the_other_rows_where_they_are(spark, tmp_path, now, monkeypatch):
    """More changed ids than rows that may be broadcast, but few beside the table."""
    from trawl.operators import lexicon

    analyzed, known = [], []
    fresh, derive = lexicon.postings, upsert.upsert
    monkeypatch.setattr("trawl.sources.store.BROADCAST_ROWS", 1)
    monkeypatch.setattr(lexicon, "postings", lambda texts, *a, **b: analyzed.append(texts.count()) or fresh(texts, *a, **b))
    monkeypatch.setattr(upsert, "upsert", lambda target, *a, **b: known.append(target.count()) or derive(target, *a, **b))
    store = ContentStore(spark, str(tmp_path / "s"), kind="simple", buckets=3)
    first = [(f"c{i}", f"Word{i % 3} b a b") for i in range(40)]
    store.save(chunk_rows(spark, first), upsert.save_chunks, now=now)
    # without derived columns, as an append leaves them
    store.elements.append(conform(chunk_rows(spark, [("bare", "No Words")])))
    changed = chunk_rows(spark, [("c3", "new text"), ("c4", None), ("added", "fresh"), ("c3", "new text")])
    store.save(changed, upsert.save_elements, now=now)
    assert analyzed == [40, 2] and known == [0, 2]
    held = store.elements.read().collect()
    want = dict(first) | {"bare": "No Words", "c3": "new text", "c4": None, "added": "fresh"}
    assert {r.id: r.text for r in held} == want and len(held) == len(want)
    touched = set(store.elements.buckets_of(changed))
    assert all(r.tokens == (r.text or "").lower().split(" ") for r in held if r.bucket in touched)
    found = {(r.id, r.lexeme): r.positions for r in store.postings.read().collect()}
    texts = {i: t for i, t in want.items() if t and i != "bare"}
    assert found == {(i, w): [k + 1 for k, x in enumerate(t.lower().split()) if x == w] for i, t in texts.items() for w in t.lower().split()}


def test_updates_without_repeated_keys_are_not_folded(spark, tmp_path, now, monkeypatch):
    folded = []
    fold = upsert.last_per_key
    monkeypatch.setattr(upsert, "last_per_key", lambda *a: folded.append(1) or fold(*a))
    store = ContentStore(spark, str(tmp_path / "s"), kind="simple", buckets=2)
    store.save(chunk_rows(spark, [("a", "one"), ("b", "two")]), upsert.save_chunks, now=now)
    assert folded == []
    store.save(updates(spark, [("a", "x", ["Chunk"], 1), ("a", "y", ["Chunk"], 2), (None, "z", ["Chunk"], 1)]).where("id IS NOT NULL"), upsert.save_chunks, now=now, order="n")
    assert folded == [1] and {r.id: r.text for r in store.elements.read().collect()} == {"a": "y", "b": "two"}
