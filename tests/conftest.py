from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from trawl.plans.session import build_session

    session = build_session(
        "trawl-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            # tiny inputs: compiling generated code would take most of the time
            "spark.sql.codegen.wholeStage": "false",
            "spark.sql.codegen.factoryMode": "NO_CODEGEN",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_elements(spark):
    """Rows given as dicts -> a full element table."""
    from trawl.sources.schemas import ELEMENTS, conform

    def build(rows):
        names = [f.name for f in ELEMENTS.fields]
        data = [tuple(r.get(n) for n in names) for r in rows]
        return conform(spark.createDataFrame(data, ELEMENTS))

    return build


@pytest.fixture(scope="session")
def make_queries(spark):
    def build(texts, vectors=None):
        vectors = vectors or {}
        rows = [(q, t, vectors.get(q)) for q, t in texts.items()]
        return spark.createDataFrame(rows, "query_id string, query string, embedding array<float>")

    return build
