"""The registered queries of the subpackage, and the pipeline stage by stage."""

from __future__ import annotations

import duckdb
import pytest
from oracle import connect, difference

import corpus_pipeline
from __spark_entry__ import SMOKE_DIR, oracle_sql, queries
from trawl.llm import langid, simhash, units
from trawl.llm.querybook import ORACLES, QUERIES


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES) and "pipeline" in queries() and set(ORACLES) <= set(oracle_sql())


def test_held_out_accuracy(spark):
    truth = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{SMOKE_DIR}/documents.parquet'").fetchall())
    held = [r for r in QUERIES["op6_language_spans"](spark, SMOKE_DIR).collect() if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held) > 0


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMOKE_DIR).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        found.append(docs)
    return found


def test_language_stage_keeps_clean_text(stages):
    assert stages[1].columns == stages[0].columns and stages[1].count() >= 0.99 * stages[0].count()


def test_near_duplicate_stage(stages):
    """The operator's contract: four-word shingles, links at 4 differing bits or fewer."""
    before = {r.doc_id: r.text for r in stages[1].collect()}
    after = {r.doc_id for r in stages[2].collect()}
    marks = {i: simhash.fingerprint(t, 4)[0] for i, t in before.items()}
    root = {i: i for i in before}
    for i in sorted(before):
        for j in sorted(before):
            if j < i and root[i] != root[j] and (marks[i] ^ marks[j]).bit_count() <= 4:
                low, high = sorted((root[i], root[j]))
                root = {k: low if r == high else r for k, r in root.items()}
    assert after == set(root.values()) and len(after) < len(before)


def test_repeats_are_cut(stages):
    before = {r.doc_id: r.text for r in stages[2].collect()}
    seen, want = set(), {}
    for i in sorted(before):
        text, left, at = before[i], [], 0
        for start, stop, digest in units.units_of(text):
            if digest in seen:
                left.append(text[at:start])
                at = stop
            seen.add(digest)
        want[i] = "".join([*left, text[at:]])
    got = {r.doc_id: r for r in stages[3].collect()}
    assert {i: r.text for i, r in got.items()} == {i: t for i, t in want.items() if t.strip() or not before[i]}
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_leaks_go(stages):
    con = connect(SMOKE_DIR)
    con.register("left_over", stages[3].toPandas())
    con.execute("CREATE OR REPLACE VIEW documents AS SELECT * FROM left_over")
    leaks = {r[0] for r in con.execute(ORACLES["op9_spaced_seeds"]).fetchall()}
    assert {r.doc_id for r in stages[4].collect()} == {r.doc_id for r in stages[3].collect()} - leaks


def test_last_stage_and_run(spark, stages):
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, SMOKE_DIR).collect())
    assert got == sorted(tuple(r) for r in stages[5].collect()) and stages[5].where("NOT round_trip").count() == 0


def test_empty_input(spark, stages):
    docs = stages[0].limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMOKE_DIR)
        assert docs.count() == 0


def test_stage_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[:5])
    assert isinstance(langid.fit(stages[0]).languages, tuple)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    assert difference(QUERIES[name](spark, SMOKE_DIR), connect(SMOKE_DIR), ORACLES[name]) is None
