"""Incremental ingest: newly landed files to an insert-ignore table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import new_rows
from ..schemas import ATOM_ENTRY
from ..sources import BucketedTable, TableStore
from ..sources.feeds import ATOM_OPTIONS, entry_columns


def atom_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Entries of feed files as they land, shaped as ``sources.read_atom`` shapes them."""
    stream = spark.readStream.schema(ATOM_ENTRY).format("xml").options(**ATOM_OPTIONS)
    return entry_columns(stream.option("maxFilesPerTrigger", files_per_batch).load(path))


def ingest(
    stream: DataFrame,
    store: TableStore,
    table: str,
    key: str,
    order: list[Column],
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> StreamingQuery:
    """Load all files landed since the last call, then stop.

    A batch that is run again after a failure adds nothing twice: its keys are in the table.
    The state is the table itself, so the query keeps none.
    """

    def load(batch: DataFrame, _: int) -> None:
        # Read twice, for its keys and its rows.
        rows = prepare(batch).persist()
        store.append(table, new_rows(store.read(table), rows, key, *order))
        rows.unpersist()

    return (
        stream.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(load)
        .start()
    )


def ingest_unique(
    stream: DataFrame,
    table: BucketedTable,
    order: list[Column],
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> StreamingQuery:
    """As ``ingest``, into a table by key buckets: a micro-batch reads only buckets that may hold its keys."""

    def load(batch: DataFrame, _: int) -> None:
        rows = prepare(batch).persist()
        table.insert_ignore(rows, *order)
        rows.unpersist()

    return (
        stream.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(load)
        .start()
    )
