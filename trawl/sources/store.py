"""A bucketed Parquet store: elements, postings, entities, relationships.

Rows live in folders ``bucket=<pmod(hash(key), buckets)>``.  A write rewrites
only the buckets it touches (dynamic partition overwrite), lookups by id read
only their buckets.  One writer at a time; an overwrite is committed bucket by
bucket, not across buckets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.functions.text import WORD
from trawl.operators.upsert import BY_KEY, filled
from trawl.plans.lineage import materialize, scratch
from trawl.plans.sizing import BROADCAST_ROWS, join_checked
from trawl.plans.topk import PAYLOAD
from trawl.sources.schemas import ELEMENTS, POSTINGS, check_dimension, conform

BUCKETS = 64
#: Tables hold each text several times over, which zstd makes half as large as the default.
CODEC = "zstd"
#: Buckets with more files than this, besides those that their size asks for, are dealt anew.
FILES_A_BUCKET, FILE_BYTES = 16, 16 << 20
#: Hashes of changed keys that are broadcast, for each row that may be, and the
#: share of the present rows beyond which all of these are taken as changed.
MARKS_A_ROW, FEW = 5, 0.25


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.hash(key), F.lit(buckets))


def buckets_in(marks: DataFrame) -> list[int]:
    return sorted(row.bucket for row in marks.select("bucket").distinct().collect())


class Table:
    """One table under ``path``, bucketed on ``key``, sorted by ``order``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str = "id", buckets: int = BUCKETS, order: str | None = None):
        self.spark, self.path, self.schema, self.key, self.buckets = spark, path, schema, key, buckets
        self.order = order or key

    def bucketed(self, df: DataFrame) -> DataFrame:
        return conform(df.drop("bucket"), self.schema).withColumn("bucket", bucket_of(F.col(self.key), self.buckets))

    def exists(self) -> bool:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop)

    def read(self) -> DataFrame:
        """The table, with ``bucket``; empty before the first write."""
        typed = T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType())])
        if not self.exists():
            return self.spark.createDataFrame([], typed)
        return self.spark.read.schema(typed).parquet(self.path)

    def buckets_of(self, keys: DataFrame) -> list[int]:
        """The buckets the keys fall in; no more numbers than buckets exist."""
        numbers = keys.select(bucket_of(F.col(self.key), self.buckets).alias("bucket")).distinct()
        return sorted(row.bucket for row in numbers.collect())

    def _mark(self) -> Column:
        return F.xxhash64(F.col(self.key).cast(self.schema[self.key].dataType))

    def marks(self, keys: DataFrame) -> DataFrame:
        """(mark, bucket) of the keys, each once: 64-bit hashes that tell rows a
        change may concern from those that it leaves alone."""
        bucket = bucket_of(F.col(self.key).cast(self.schema[self.key].dataType), self.buckets).alias("bucket")
        return materialize(keys.select(self._mark().alias("mark"), bucket).distinct())

    def few(self, marks: DataFrame) -> bool:
        """True when the rows of the marks are picked out of their buckets by a
        broadcast of the marks, rather than all rows of these handled alike."""
        if not self.exists():
            return False
        held = self.read().where(F.col("bucket").isin(buckets_in(marks))).count()
        return marks.count() <= min(MARKS_A_ROW * BROADCAST_ROWS, FEW * held)

    def marked(self, rows: DataFrame, marks: DataFrame, how: str = "left_semi") -> DataFrame:
        """Rows with one of the marks, or without one (``left_anti``)."""
        return rows.join(F.broadcast(marks.select("mark")), self._mark() == F.col("mark"), how)

    def lookup(self, keys: DataFrame) -> DataFrame:
        """Rows of the given keys; only their buckets are read."""
        present = self.read().where(F.col("bucket").isin(self.buckets_of(keys)))
        return present.join(keys.select(self.key), self.key, "left_semi")

    def attach(self, results: DataFrame, columns: Sequence[str] = PAYLOAD) -> DataFrame:
        """A finished ranking with columns of this table, read from the buckets
        of its ids only."""
        results = materialize(results)
        present = self.read().where(F.col("bucket").isin(self.buckets_of(results)))
        return join_checked(present.select(self.key, *columns), results, self.key)

    def _write(self, df: DataFrame, mode: str, *, dealt: bool = False) -> None:
        """Rows that are ``dealt`` by bucket already are written where they are."""
        rows = self.bucketed(df)
        (
            # rebalanced, not just repartitioned: a bucket above the advisory
            # size is split over several tasks and files
            (rows if dealt else rows.hint("rebalance", F.col("bucket")))
            .sortWithinPartitions("bucket", self.order)
            .write.mode(mode)
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", CODEC)
            # sorted values lie side by side and compress without one
            .option(f"parquet.enable.dictionary#{self.order}", "false")
            .partitionBy("bucket")
            .parquet(self.path)
        )

    def append(self, df: DataFrame) -> None:
        self._write(df, "append")

    @contextmanager
    def _in_step(self) -> Iterator[None]:
        """Shuffles on the key give each task rows of one bucket.

        Spark deals keys out by the same hash, so this holds with a multiple of
        the buckets as the number of partitions; with another one the files of
        a bucket are only more.
        """
        name = "spark.sql.shuffle.partitions"
        before = self.spark.conf.get(name)
        self.spark.conf.set(name, str(self.buckets * ceil(int(before) / self.buckets)))
        try:
            yield
        finally:
            self.spark.conf.set(name, before)

    def files_of(self, numbers: Sequence[int]) -> dict[int, dict[str, int]]:
        """The files of these buckets with their bytes."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        held = {}
        for number in numbers:
            folder = path(f"{self.path}/bucket={number}")
            system = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
            found = system.listStatus(folder) if system.exists(folder) else []
            held[number] = {f.getPath().getName(): f.getLen() for f in found}
        return held

    def change(
        self,
        touched: DataFrame,
        change: Callable[[DataFrame], DataFrame],
        *,
        removes: bool = False,
        dealt: bool = False,
        apart: Callable[[DataFrame], DataFrame] | None = None,
    ) -> None:
        """Rewrite the buckets that hold the keys of ``touched``.

        ``change`` maps the present rows of those buckets to their next state;
        new files are staged and swapped in when the job commits.  An overwrite
        leaves a bucket without new rows as it was, so after a change that
        ``removes`` rows a bucket that ends empty is dropped.  A change whose
        rows are ``dealt``, by a join on the key or by leaving them in their
        files, is written without a further shuffle.

        ``touched`` may be the ``marks`` of the keys.  If these are ``few``,
        name what becomes of the rows ``apart`` from them: only the marked ones
        go through ``change``, the others are written where they are read.
        """
        marked = "mark" in touched.columns
        chosen = buckets_in(touched) if marked else self.buckets_of(touched)
        if not chosen:
            return
        present = self.read().where(F.col("bucket").isin(chosen)).drop("bucket")
        before = self.files_of(chosen)
        sizes = [size for files in before.values() for size in files.values()]
        # small files of many changes are brought together again
        scattered = len(sizes) > FILES_A_BUCKET * len(chosen) + 2 * sum(sizes) / FILE_BYTES
        with self._in_step():
            if marked and apart is not None:
                rest = apart(self.marked(present, touched, "left_anti"))
                after = conform(change(self.marked(present, touched)), self.schema).unionByName(conform(rest, self.schema))
            else:
                after = change(present)
            self._write(after, "overwrite", dealt=dealt and not scattered)
        if removes:
            held = self.files_of(chosen)
            for number in chosen:
                # names are new with each write: the same ones were left behind
                if before[number] and before[number].keys() == held[number].keys():
                    self._clear(number)

    def _clear(self, number: int) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/bucket={number}")
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


class ContentStore:
    """Elements and their postings kept in step."""

    def __init__(
        self, spark: SparkSession, path: str, *, kind: str = "english", buckets: int = BUCKETS, dimension: int | None = None
    ):
        """With a ``dimension`` a write fails on a vector of another length."""
        self.spark, self.kind, self.dimension = spark, kind, dimension
        self.elements = Table(spark, f"{path}/elements", ELEMENTS, buckets=buckets)
        # sorted by lexeme inside each bucket, so a search skips row groups
        self.postings = Table(spark, f"{path}/postings", POSTINGS, buckets=buckets, order="lexeme")

    def save(self, updates: DataFrame, how: Callable[..., DataFrame], **options) -> None:
        """Apply one of the element upserts and refresh the postings it changed."""
        if self.dimension is not None and "embedding" in updates.columns:
            updates = check_dimension(updates, self.dimension)
        with scratch(self.spark):
            # read several times below, and it may read from this very table
            kept = materialize(updates, CODEC)
            marks = self.elements.marks(kept.select("id"))
            by_key = how in BY_KEY
            if by_key and kept.count() == marks.count():
                options["unique"] = True
            few = self.elements.few(marks)
            self.elements.change(
                marks, lambda present: how(present, kept, **options), dealt=True, apart=filled if few and by_key else None
            )
            self._refresh(marks, few)

    def refresh_postings(self, ids: DataFrame) -> None:
        """Rewrite the postings of the given elements from their present text."""
        with scratch(self.spark):
            marks = self.elements.marks(ids)
            self._refresh(marks, self.elements.few(marks))

    def _refresh(self, marks: DataFrame, few: bool) -> None:
        """Only chunks have postings, so a search without a filter needs no look
        at the elements.  A few marked ones are analyzed and the postings of
        the others written where they are read.  Else all chunks of the touched
        buckets are analyzed where they are read, which moves nothing; postings
        would weigh several times their texts.
        """
        from trawl.operators.lexicon import postings

        chunk = F.array_contains("labels", "Chunk") & F.col("text").isNotNull() & F.col("id").isNotNull()
        chunks = self.elements.read().where(F.col("bucket").isin(buckets_in(marks)) & chunk).select("id", "text")
        if few:
            chunks = self.elements.marked(chunks, marks).repartition(self.elements.buckets, "id")
        fresh = postings(chunks, self.kind, by_lexeme=True)
        self.postings.change(marks, lambda present: fresh, removes=True, dealt=True, apart=(lambda rest: rest) if few else None)

    def without_postings(self) -> DataFrame:
        """Chunks with words but no postings row yet."""
        chunk = F.array_contains("labels", "Chunk")
        held = self.elements.read().where(chunk & F.col("text").rlike(WORD)).select("id", "text")
        return held.join(self.postings.read().select("id"), "id", "left_anti")

    def backfill(self) -> int:
        """Analyze what has no postings yet; returns how many elements."""
        missing = materialize(self.without_postings().select("id"))
        count = missing.count()
        if count:
            self.refresh_postings(missing)
        return count

    def delete_trees(self, uris: DataFrame) -> DataFrame:
        """Delete the trees under the uris; (root_uri, deleted) counts."""
        from trawl.operators.delete import descendants, roots_by_uri

        present = self.elements.read()
        doomed = materialize(descendants(roots_by_uri(uris, present), present))
        ids = doomed.select("id").distinct()
        for table in (self.elements, self.postings):
            table.change(ids, lambda rows: rows.join(ids, "id", "left_anti"), removes=True, dealt=True)
        return doomed.groupBy("root_uri").agg(F.countDistinct("id").alias("deleted"))
