"""The shape of the physical plans, and the building blocks under them."""

import pytest
from pyspark.sql import functions as F

from trawl.operators.entities import entity_text_matches, find_related
from trawl.operators.fuzzy_search import fuzzy_matches
from trawl.operators.lexicon import matching_positions
from trawl.operators.text_search import text_matches
from trawl.operators.vector_search import vector_search
from trawl.plans import sizing
from trawl.plans.lineage import checkpoint_folder, materialize
from trawl.plans.topk import cut, top_k
from trawl.sources import corpus as c

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_no_pairwise_joins(spark):
    asked, chunks = c.sentence_queries(spark, SF), c.chunks(spark, SF)
    frames = {
        "vector": vector_search(asked, chunks, 10),
        "text": text_matches(asked, chunks.select("id", "text"), kind="simple"),
        "fuzzy": fuzzy_matches(c.name_queries(spark, SF), chunks),
        "entity text": entity_text_matches(c.name_queries(spark, SF), c.entities(spark, SF)),
    }
    for name, df in frames.items():
        shape = plan(df)
        assert "CartesianProduct" not in shape and "NestedLoop" not in shape, name


def test_vector_search_shuffles_results_only(spark):
    shape = plan(vector_search(c.sentence_queries(spark, SF), c.read(spark, SF, "embeddings").select(
        F.col("vec_id").cast("string").alias("id"), "embedding", F.array(F.lit("Chunk")).alias("labels")), 10, payload=False))
    assert shape.count("Exchange hashpartitioning") + shape.count("hashpartitioning(query_id") >= 1
    assert "hashpartitioning(id" not in shape and "WindowGroupLimit" in shape


def test_text_hits_shuffle_once_by_chunk(spark):
    chunks = c.chunks(spark, SF, embeddings=False).select("id", "text")
    wanted = spark.createDataFrame([("the",), ("of",)], "lexeme string")
    shape = plan(matching_positions(chunks, wanted, "simple"))
    assert "hashpartitioning(id" in shape and "hashpartitioning(id#0, lexeme" not in shape
    assert "BroadcastHashJoin" in shape


def test_scan_reads_only_the_columns_asked(spark):
    shape = plan(c.chunks(spark, SF, embeddings=False).select("id", "text"))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in shape


def test_labels_and_ranges_reach_the_scan(spark):
    shape = plan(c.read(spark, SF, "labels").where("toxic = 1").select("doc_id"))
    assert "PushedFilters: [IsNotNull(toxic), EqualTo(toxic,1)]" in shape


@pytest.mark.parametrize("k", [1, 3, 1200])
def test_top_k(spark, k):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("q"), F.col("id") % 7)).alias("query_id"),
        F.format_string("%05d", "id").alias("id"), ((F.col("id") * 7919) % 50).cast("double").alias("score"),
    )
    want = {}
    for r in sorted(rows.collect(), key=lambda r: (-r.score, r.id)):
        want.setdefault(r.query_id, []).append(r.id)
    got = {}
    for r in sorted(top_k(rows, k).collect(), key=lambda r: r["rank"]):
        got.setdefault(r.query_id, []).append(r.id)
    assert got == {q: ids[:k] for q, ids in want.items()}


def test_cut(spark):
    rows = spark.createDataFrame([(0.4,), (0.5,), (0.9,)], "score double")
    assert cut(rows, 0.5).count() == 2 and cut(rows, 0.9, 0.5).count() == 2 and cut(rows, 0.9).count() == 1


def test_salted_join_equals_the_broadcast_one(spark):
    big = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 11)).alias("k"), "id")
    small = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("absent", 4)], "k string, v int")
    left = sorted(map(tuple, sizing.join_checked(big, small, "k", spread="id").collect()))
    salted = sizing.join_checked(big, small, "k", spread="id", rows=1)
    plain = sizing.join_checked(big, small, "k", rows=1)
    assert sorted(map(tuple, salted.collect())) == left == sorted(map(tuple, plain.collect()))
    assert len(left) == 2 * 1000 + big.where("k = 'k1'").count()


def test_materialized_results_use_the_named_folder(spark):
    folder = checkpoint_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    kept = materialize(spark.range(5).toDF("id"))
    assert kept.count() == 5 and all(folder in f for f in kept.inputFiles())


@pytest.mark.parametrize("spread", [None, "id"])
def test_sides_beyond_the_check_are_never_broadcast(spark, spread):
    """Few bytes in files do not make a side of many rows fit for the driver."""
    big, small = spark.range(3000).select((F.col("id") % 9).alias("k"), "id"), spark.range(50).select(F.col("id").alias("k"))
    shape = plan(sizing.join_checked(big, small, "k", spread=spread, rows=10))
    assert "SortMergeJoin" in shape and "BroadcastHashJoin" not in shape


def test_entities_are_not_broadcast_to_their_links(spark):
    people = spark.range(200).select(F.concat(F.lit("p"), "id").alias("id"), F.lit("n").alias("name"))
    links = spark.range(200).select(
        F.concat(F.lit("p"), "id").alias("source_id"), F.concat(F.lit("p"), F.col("id") % 7).alias("target_id"),
        F.lit("KNOWS").alias("relationship_name"),
    )
    found = find_related(links.select(F.col("source_id").alias("id")), links, people, "KNOWS")
    # the sources pass the row check; the entities have none
    assert found.count() == 200
    assert plan(found).count("+- SortMergeJoin Inner") == 1
