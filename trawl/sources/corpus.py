"""Adapters from the given tables to content elements, entities and queries.

Chunking is our own definition: one Document row per document and one Chunk
row per non-blank line of its text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.sources.schemas import ELEMENTS, conform, conform_entities

EPOCH = "TIMESTAMP_NTZ'2024-01-01 00:00:00'"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A text table in at least as many partitions as there are cores.

    Only an input of a few small files is spread out; one that already splits
    into enough scan tasks is read in place, without a shuffle.
    """
    rows = read(spark, sf_dir, name)
    cores = spark.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def _stamp(key: str):
    return F.expr(f"{EPOCH} + make_dt_interval(0, 0, 0, {key})")


def document_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return conform(
        docs.select(
            F.concat(F.lit("doc-"), "doc_id").alias("id"),
            F.concat(F.lit("corpus://"), "source", F.lit("/"), "doc_id").alias("uri"),
            F.array(F.lit("Document"), F.lit("ContentRoot"), F.lit("ContentElement")).alias("labels"),
            F.to_json(
                F.struct(
                    F.concat(F.lit("Document "), "doc_id").alias("title"),
                    F.lit("2024-01-01T00:00:00Z").alias("ingestionTimestamp"),
                    "lang", "source", "n_chars",
                )
            ).alias("metadata"),
            _stamp("doc_id").alias("ingestion_timestamp"),
        )
    )


def page_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return conform(
        pages.select(
            F.concat(F.lit("page-"), "page_id").alias("id"),
            F.col("url").alias("uri"),
            F.array(F.lit("Document"), F.lit("ContentRoot"), F.lit("ContentElement")).alias("labels"),
            F.to_json(F.struct(F.concat(F.lit("Page "), "page_id").alias("title"))).alias("metadata"),
            _stamp("page_id").alias("ingestion_timestamp"),
            F.col("html").cast("binary").alias("raw_content"),
            F.lit("text/html").alias("content_type"),
        )
    )


def chunks(spark: SparkSession, sf_dir: str, *, embeddings: bool = True) -> DataFrame:
    """One Chunk row per non-blank line; a document's vector goes to its first."""
    docs = read_texts(spark, sf_dir, "documents")
    lines = F.filter(
        F.transform(F.split("text", "\n"), lambda line, i: F.struct(i.alias("pos"), line.alias("text"))),
        lambda item: F.trim(item["text"]) != "",
    )
    rows = docs.select("doc_id", "lang", "source", "n_chars", F.posexplode(lines).alias("ord", "line"))
    if embeddings:
        vectors = read(spark, sf_dir, "embeddings").select(
            F.col("vec_id").alias("doc_id"), F.lit(0).alias("ord"), "embedding"
        )
        rows = rows.join(vectors, ["doc_id", "ord"], "left")
    else:
        rows = rows.withColumn("embedding", F.lit(None).cast("array<float>"))
    return conform(
        rows.select(
            F.concat(F.lit("doc-"), "doc_id", F.lit("-"), F.col("line.pos")).alias("id"),
            F.concat(F.lit("corpus://"), "source", F.lit("/"), "doc_id").alias("uri"),
            F.col("line.text").alias("text"),
            F.col("line.text").alias("urtext"),
            "embedding",
            F.concat(F.lit("doc-"), "doc_id").alias("parent_id"),
            F.array(F.lit("Chunk"), F.lit("ContentElement")).alias("labels"),
            F.to_json(F.struct("lang", "source", "n_chars")).alias("metadata"),
            _stamp("doc_id").alias("ingestion_timestamp"),
        )
    )


def elements(spark: SparkSession, sf_dir: str, *, embeddings: bool = True) -> DataFrame:
    """Documents, their chunks and the pages as one element table."""
    return (
        document_roots(spark, sf_dir)
        .unionByName(chunks(spark, sf_dir, embeddings=embeddings))
        .unionByName(page_roots(spark, sf_dir))
    )


def event_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as labelled rows with JSON metadata, for filters at volume."""
    events = read(spark, sf_dir, "events")
    return conform(
        events.select(
            F.concat(F.lit("event-"), "event_id").alias("id"),
            F.array(F.lit("Chunk"), F.col("event_type")).alias("labels"),
            F.col("props").alias("metadata"),
            F.col("ts").alias("ingestion_timestamp"),
        ),
        ELEMENTS,
    )


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(query_id, query, embedding): one query per benchmark item."""
    items = read(spark, sf_dir, "benchmark")
    vectors = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("item_id"), "embedding")
    return items.join(vectors, "item_id", "left").select(
        F.concat(F.lit("b"), "item_id").alias("query_id"), F.col("text").alias("query"), "embedding"
    )


def sentence_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query per sentence of every benchmark item, with the item's vector."""
    return benchmark_queries(spark, sf_dir).select(
        "query_id", "embedding", F.posexplode(F.split("query", "[.\\n]+")).alias("pos", "query")
    ).where(F.trim("query") != "").select(
        F.concat("query_id", F.lit("-"), "pos").alias("query_id"), F.trim("query").alias("query"), "embedding"
    )


def name_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query per nation and region name; few of them occur in a text."""
    nations = read(spark, sf_dir, "nation").select(
        F.concat(F.lit("n"), "n_nationkey").alias("query_id"), F.col("n_name").alias("query")
    )
    regions = read(spark, sf_dir, "region").select(
        F.concat(F.lit("r"), "r_regionkey").alias("query_id"), F.col("r_name").alias("query")
    )
    return nations.unionByName(regions)


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations, customers and suppliers; a vector by equal number where given."""
    nation = read(spark, sf_dir, "nation").join(
        F.broadcast(read(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey")
    )
    vectors = read(spark, sf_dir, "embeddings")
    place = F.broadcast(nation.select("n_nationkey", "n_name", "r_name"))
    scope = F.to_json(F.struct(F.col("r_name").alias("context_id")))
    nations = nation.select(
        F.concat(F.lit("nation-"), "n_nationkey").alias("id"),
        F.col("n_name").alias("name"),
        F.concat(F.lit("Nation in "), "r_name").alias("description"),
        F.array(F.lit("Nation"), F.lit("Place")).alias("labels"),
        scope.alias("metadata"),
        F.col("r_name").alias("context_id"),
    )

    def party(table: str, prefix: str, label: str, kind: str) -> DataFrame:
        rows = read(spark, sf_dir, table)
        rows = rows.join(place, F.col(f"{prefix}_nationkey") == F.col("n_nationkey")).join(
            vectors, F.col(f"{prefix}_{kind}key") == F.col("vec_id"), "left"
        )
        return rows.select(
            F.concat(F.lit(f"{table}-"), f"{prefix}_{kind}key").alias("id"),
            F.col(f"{prefix}_name").alias("name"),
            F.concat(F.lit(f"{label} from "), "n_name").alias("description"),
            F.array(F.lit(label), F.lit("Party")).alias("labels"),
            F.to_json(F.struct(F.col(f"{prefix}_acctbal").alias("acctbal"))).alias("properties"),
            scope.alias("metadata"),
            F.col("r_name").alias("context_id"),
            "embedding",
        )

    return (
        conform_entities(nations)
        .unionByName(conform_entities(party("customer", "c", "Customer", "cust")))
        .unionByName(conform_entities(party("supplier", "s", "Supplier", "supp")))
    )


def relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LOCATED_IN edges from customers and suppliers to their nations."""
    located = [
        read(spark, sf_dir, table).select(
            F.concat(F.lit(f"{table}-"), f"{prefix}_{kind}key").alias("source_id"),
            F.concat(F.lit("nation-"), f"{prefix}_nationkey").alias("target_id"),
            F.lit("LOCATED_IN").alias("relationship_name"),
            F.lit("{}").alias("properties"),
        )
        for table, prefix, kind in (("customer", "c", "cust"), ("supplier", "s", "supp"))
    ]
    return located[0].unionByName(located[1])


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BOUGHT_FROM edges, one per customer and supplier that share an order."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey")
    return (
        lines.join(orders, "o_orderkey")
        .groupBy("o_custkey", "l_suppkey")
        .agg(F.count("*").alias("lines"))
        .select(
            F.concat(F.lit("customer-"), "o_custkey").alias("source_id"),
            F.concat(F.lit("supplier-"), "l_suppkey").alias("target_id"),
            F.lit("BOUGHT_FROM").alias("relationship_name"),
            F.to_json(F.struct("lines")).alias("properties"),
        )
    )
