"""Continuous upkeep: new or changed elements arrive as a stream.

Each micro-batch is an idempotent upsert plus a refresh of the postings of the
changed elements, so a batch that runs again after a failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from trawl.operators.upsert import save_elements
from trawl.sources.schemas import with_derived
from trawl.sources.store import ContentStore


def derived_stream(changes: DataFrame) -> DataFrame:
    """The stream with its derived text columns filled; stateless."""
    return with_derived(changes)


def upkeep(
    changes: DataFrame,
    store: ContentStore,
    checkpoint: str,
    *,
    how: Callable[..., DataFrame] = save_elements,
    order: str | None = None,
) -> DataStreamWriter:
    """A writer that keeps ``store`` in step with a stream of elements.

    Start it with a trigger of your choice, for example ``availableNow``.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        store.save(batch, how, order=order)

    return changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
