"""Session settings for retrieval jobs, and shipping this package to executors."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
    "spark.sql.parquet.filterPushdown": "true",
}
PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the Python workers, once per application.

    Needed where it is not installed on the executors: the Arrow functions are
    looked up there by module name.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    folder = tempfile.mkdtemp(prefix="trawl-package-")
    archive = shutil.make_archive(f"{folder}/{PACKAGE.name}", "zip", PACKAGE.parent, PACKAGE.name)
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def build_session(app: str = "trawl", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; the master comes from the launcher
    unless one is named."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark
