"""Cutting lineage: intermediate results that outlive a lost executor.

A result that is used more than once, or that closes a loop iteration, is
written as Parquet under the checkpoint folder the cluster names and read back.
The files also carry a size, so Spark picks broadcast or shuffle joins on a
measured side rather than a guess.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    own = tempfile.mkdtemp(prefix="trawl-checkpoint-")
    spark.sparkContext.setCheckpointDir(own)
    return spark.sparkContext.getCheckpointDir() or own


_open: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate files written within are deleted at the end.

    For operations that have committed their result by then; nothing lazy that
    reads such files may leave the block.
    """
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame, codec: str | None = None) -> DataFrame:
    """Write ``df`` once under the checkpoint folder and read it back."""
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/trawl-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    if _open:
        _open[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)
