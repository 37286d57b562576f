"""Headline timings: ingest once, then batches of queries against the store.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [--full]

Prints one JSON line.  Each query is run once to warm up and then timed (best
of two with ``--full``, which adds batches of 1 and 1,000 queries).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from math import isqrt

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from trawl.operators import upsert  # noqa: E402
from trawl.operators.fuzzy_search import fuzzy_search, word_table  # noqa: E402
from trawl.operators.hybrid_search import hybrid_search  # noqa: E402
from trawl.operators.lexicon import document_frequencies  # noqa: E402
from trawl.operators.lookup import statistics  # noqa: E402
from trawl.operators.text_search import text_search  # noqa: E402
from trawl.operators.vector_search import (  # noqa: E402
    assign_cells, is_chunk, nearest, nearest_approximate, recall, train_cells, vector_search,
)
from trawl.plans.lineage import materialize  # noqa: E402
from trawl.plans.session import build_session  # noqa: E402
from trawl.sources import corpus as c  # noqa: E402
from trawl.sources.store import ContentStore  # noqa: E402

FULL = "--full" in sys.argv


def timed(action, repeats: int) -> float:
    best = float("inf")
    for _ in range(repeats):
        start = time.perf_counter()
        action()
        best = min(best, time.perf_counter() - start)
    return round(best, 3)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    work = tempfile.mkdtemp(prefix="trawl-bench-")
    spark = build_session(
        "trawl-bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": f"{work}/checkpoint",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings: dict[str, float] = {}

    start = time.perf_counter()
    store = ContentStore(spark, f"{work}/store", buckets=int(cpus) * 2)
    store.save(c.elements(spark, sf_dir), upsert.save_chunks)
    words = word_table(store.elements.read().where(is_chunk()))
    timings["ingest"] = round(time.perf_counter() - start, 3)

    elements, index = store.elements.read(), store.postings.read()
    frequencies = materialize(document_frequencies(index))
    vectors = c.read(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("query_id"), "embedding")
    asked = c.sentence_queries(spark, sf_dir).unionByName(
        c.read(spark, sf_dir, "conversations").select(
            F.concat_ws("-", "conv_id", "turn").alias("query_id"), F.col("text").alias("query")
        ).join(vectors, "query_id", "left"),
        allowMissingColumns=True,
    )
    asked, vectors = materialize(asked), materialize(vectors)
    corpus = materialize(elements.where(is_chunk() & F.col("embedding").isNotNull()).select("id", "embedding"))
    centres = train_cells(corpus, max(4, isqrt(corpus.count())))
    cells = materialize(assign_cells(corpus, centres))

    def first(df, n: int):
        return materialize(df.orderBy("query_id").limit(n))

    indexed = {"index": index, "frequencies": frequencies, "index_covers_all": True}
    sizes = (1, 100, 1000) if FULL else (100,)
    repeats = 2 if FULL else 1
    for n in sizes:
        v, q = first(vectors, n), first(asked, n)
        cases = {
            f"vector_top10_{n}": lambda: run(vector_search(v, elements, 10)),
            f"vector_approximate_top10_{n}": lambda: run(nearest_approximate(v, cells, centres, 10)),
            f"text_top10_{n}": lambda: run(text_search(q, elements, 10, **indexed)),
            f"fuzzy_top10_{n}": lambda: run(fuzzy_search(q, elements, 10, words=words)),
            f"hybrid_top10_{n}": lambda: run(hybrid_search(q, elements, 10, words=words, **indexed)),
        }
        for name, action in cases.items():
            action()
            timings[name] = timed(action, repeats)
            print(name, timings[name], file=sys.stderr, flush=True)
    timings["statistics"] = timed(lambda: run(statistics(elements)), repeats)
    changed = materialize(
        elements.where(is_chunk() & (F.pmod(F.xxhash64("id"), F.lit(100)) == 0)).withColumn("text", F.upper("text"))
    )
    timings["upsert_1pct"] = timed(lambda: store.save(changed, upsert.save_elements), 1)
    extra = {}
    if FULL:
        v = first(vectors, 1000)
        found = recall(nearest_approximate(v, cells, centres, 10), nearest(v, corpus, 10))
        share = found.agg(F.sum("found") / F.sum("wanted")).first()[0]
        extra = {"recall_at_10": round(share, 4), "queries_available": asked.count()}
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1], "cpus": int(cpus), **extra,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
