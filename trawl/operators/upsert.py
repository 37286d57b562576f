"""Batch upserts: insert new keys, overwrite named columns of known ones.

All forms are DataFrame -> DataFrame; ``trawl.sources.store`` applies them to a
bucketed Parquet table so that only touched buckets are rewritten.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.functions import text as tx
from trawl.sources.schemas import ELEMENTS, conform, conform_entities, with_derived

# Columns each write operation sets; the others keep their value.
ELEMENT_COLUMNS = ("uri", "text", "urtext", "parent_id", "labels", "metadata")
DERIVED = ("clean_text", "tokens")
CHUNK_COLUMNS = (*ELEMENT_COLUMNS, "embedding")
CONTENT_COLUMNS = ("uri", "text", "parent_id", "labels", "metadata", "raw_content", "content_type")
ENTITY_COLUMNS = ("name", "description", "uri", "labels", "properties", "metadata", "context_id", "embedding")
RELATIONSHIP_KEY = ("source_id", "target_id", "relationship_name")


def last_per_key(updates: DataFrame, key: Sequence[str], order: str | None, left_out: Sequence[str] = ()) -> DataFrame:
    """One row per key, the last by ``order``, without the columns ``left_out``.

    An aggregate with a map-side combine: a key repeated in a third of all
    updates is folded inside each task before it is shuffled.
    """
    rest = [c for c in updates.columns if c not in key and c not in left_out]
    sequence = F.col(order) if order else F.lit(0)
    tie = F.xxhash64(*[F.col(c) for c in updates.columns])
    picked = updates.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(sequence, tie)).alias("_row"))
    return picked.select(*key, *[F.col("_row")[c].alias(c) for c in rest])


def upsert(
    target: DataFrame,
    updates: DataFrame,
    columns: Sequence[str],
    *,
    key: Sequence[str] = ("id",),
    order: str | None = None,
    on_insert: dict[str, Column] | None = None,
    emptied: Sequence[str] = (),
    unique: bool = False,
) -> DataFrame:
    """The target after the updates, one full outer join on the key.

    ``columns`` are overwritten (a NULL too).  Target columns outside them keep
    their value and are NULL, or ``on_insert``, for a new key.  Columns that are
    ``emptied`` decide between repeated keys but become NULL instead of moving.
    Keys known to be ``unique`` are not folded, only dealt out.
    """
    key = list(key)
    named = [c for c in columns if c in target.columns]
    if unique:
        one = updates.select(*key, *[c for c in named if c not in emptied]).repartition(*key)
    else:
        one = last_per_key(updates.select(*key, *named, *([order] if order else [])), key, order, emptied)
    new = one.select(*key, F.struct(*[c for c in named if c not in emptied]).alias("_new"))
    joined = target.withColumn("_known", F.lit(True)).join(new, key, "full_outer")
    defaults = on_insert or {}

    def value(name: str) -> Column:
        if name in key:
            return F.col(name)
        if name in emptied:
            return F.when(F.col("_new").isNull(), F.col(name)).alias(name)
        if name in named:
            return F.when(F.col("_new").isNotNull(), F.col("_new")[name]).otherwise(F.col(name)).alias(name)
        if name in defaults:
            return F.when(F.col("_known"), F.col(name)).otherwise(defaults[name]).alias(name)
        return F.col(name)

    return joined.select(*[value(c) for c in target.columns])


def _element_upsert(
    target: DataFrame, updates: DataFrame, columns: Sequence[str], order: str | None, now: Column | None, unique: bool
) -> DataFrame:
    target = conform(target, ELEMENTS)
    missing = [c for c in columns if c not in updates.columns]
    updates = updates.withColumns({c: F.lit(None).cast(ELEMENTS[c].dataType) for c in missing})
    stamped = {"ingestion_timestamp": F.localtimestamp() if now is None else now}
    # texts move once: what follows from them stays behind and is derived anew
    # after the join; values of other rows that differ from it move and are kept
    cleaned = tx.clean_text(F.col("text"))
    target = target.withColumn("tokens", F.when(~F.col("tokens").eqNullSafe(tx.tokens(F.col("clean_text"))), F.col("tokens")))
    target = target.withColumn("clean_text", F.when(~F.col("clean_text").eqNullSafe(cleaned), F.col("clean_text")))
    after = upsert(
        target, with_derived(updates), (*columns, *DERIVED), order=order, on_insert=stamped, emptied=DERIVED,
        unique=unique,
    )
    return filled(after)


def filled(elements: DataFrame) -> DataFrame:
    """Elements with the derived columns that they lack."""
    cleaned = elements.withColumn("clean_text", F.coalesce("clean_text", tx.clean_text(F.col("text"))))
    return cleaned.withColumn("tokens", F.coalesce("tokens", tx.tokens(F.col("clean_text"))))


def save_elements(
    target: DataFrame, updates: DataFrame, *, order: str | None = None, now: Column | None = None, unique: bool = False
) -> DataFrame:
    """Upsert elements; embedding, raw content and time stamp stay as they were."""
    return _element_upsert(target, updates, ELEMENT_COLUMNS, order, now, unique)


def save_chunks(
    target: DataFrame, updates: DataFrame, *, order: str | None = None, now: Column | None = None, unique: bool = False
) -> DataFrame:
    """Upsert chunks with their embedding; without one it becomes NULL."""
    return _element_upsert(target, updates, CHUNK_COLUMNS, order, now, unique)


def save_documents(
    target: DataFrame, updates: DataFrame, *, order: str | None = None, now: Column | None = None, unique: bool = False
) -> DataFrame:
    """Upsert documents with their raw bytes and MIME type; urtext stays."""
    return _element_upsert(target, updates, CONTENT_COLUMNS, order, now, unique)


#: What these leave of an element without an update is the element, ``filled``.
BY_KEY = (save_elements, save_chunks, save_documents)


def persist_chunks(
    target: DataFrame,
    chunks: DataFrame,
    vectors: DataFrame,
    *,
    order: str | None = None,
    now: Column | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Upsert chunks with the vectors given for their ids, NULL where none is.

    ``transform`` may rewrite the chunks (DataFrame -> DataFrame) beforehand.
    """
    rows = chunks.transform(transform) if transform else chunks
    with_vectors = rows.drop("embedding").join(vectors.select("id", "embedding"), "id", "left")
    return save_chunks(target, with_vectors, order=order, now=now)


def embed_texts(rows: DataFrame, embed: Callable[[Column], Column], text: str = "text") -> DataFrame:
    """Fill ``embedding`` from a text column by a user's pandas UDF."""
    return rows.withColumn("embedding", embed(F.col(text)))


def save_entities(
    target: DataFrame,
    updates: DataFrame,
    *,
    order: str | None = None,
    embed: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Upsert entities, all columns; the scope comes from the metadata.

    With ``embed`` the vector is computed from name and description.
    """
    from trawl.functions.properties import typed_value

    rows = updates if not embed else updates.withColumn(
        "embedding", embed(F.concat_ws(": ", "name", F.nullif("description", F.lit(""))))
    )
    rows = last_per_key(rows, ["id"], order)
    conformed = conform_entities(rows)
    scope = typed_value(F.col("metadata"), "context_id")
    conformed = conformed.withColumn(
        "context_id", F.when(F.schema_of_variant(scope) == "STRING", F.try_variant_get(scope, "$", "string"))
    )
    return upsert(conform_entities(target), conformed, ENTITY_COLUMNS)


def new_relationships(existing: DataFrame, entities: DataFrame, added: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) of a plain insert.

    Rejected rows carry a ``reason``: an unknown endpoint, or a triple that is
    stored already or repeated in the batch.
    """
    key = list(RELATIONSHIP_KEY)
    ids = entities.select("id")
    checked = (
        added.join(ids.select(F.col("id").alias("source_id"), F.lit(True).alias("_source")), "source_id", "left")
        .join(ids.select(F.col("id").alias("target_id"), F.lit(True).alias("_target")), "target_id", "left")
        .join(existing.select(*key, F.lit(True).alias("_stored")), key, "left")
    )
    repeats = added.groupBy(*key).agg((F.count("*") > 1).alias("_repeated"))
    reason = (
        F.when(F.col("_source").isNull() | F.col("_target").isNull(), "unknown endpoint")
        .when(F.col("_stored"), "stored already")
        .when(F.col("_repeated"), "repeated in batch")
    )
    judged = checked.join(repeats, key).select(*added.columns, reason.alias("reason"))
    return judged.where("reason IS NULL").drop("reason"), judged.where("reason IS NOT NULL")


def create_relationships(existing: DataFrame, entities: DataFrame, added: DataFrame) -> DataFrame:
    """The table after a plain insert; any rejected row fails the call."""
    accepted, rejected = new_relationships(existing, entities, added)
    bad = rejected.limit(5).collect()
    if bad:
        raise ValueError(f"relationships not inserted, for example: {[r.asDict() for r in bad]}")
    return existing.unionByName(accepted, allowMissingColumns=True)


def merge_relationships(existing: DataFrame, added: DataFrame, *, order: str | None = None) -> DataFrame:
    """Upsert on the triple: the properties of a known one are replaced."""
    return upsert(existing, added, ("properties",), key=RELATIONSHIP_KEY, order=order)
