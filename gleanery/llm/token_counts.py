"""Token counts of whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .library import byte_level
from .segments import balanced


def token_counts(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", limit: int = 1024) -> DataFrame:
    """Per row of ``docs``: its id, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    Only lengths leave the Arrow function. Slices of about equal bytes are encoded together, and
    long texts in stretches that end at safe places; a text without such places, which lie before single spaces,
    is one stretch. NULL and empty texts have no bytes and no tokens;
    special strings in a text count as the library counts them by default. Repeated rows are each
    returned, other columns left out. ``path`` is a byte-level file that every executor can open.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = byte_level(path)
        for batch in batches:
            for rows in balanced(batch, "text") if batch.num_rows else ():
                n_tokens = pa.array([library.count(t or "") for t in rows.column("text").to_pylist()], pa.int64())
                yield pa.RecordBatch.from_arrays([rows.column("id"), rows.column("n_bytes"), n_tokens], ["id", "n_bytes", "n_tokens"])

    n_bytes = F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")
    rows = docs.select(F.col(id).alias("id"), n_bytes.alias("n_bytes"), F.col(text).alias("text"))
    schema = f"id {docs.schema[id].dataType.simpleString()}, n_bytes bigint, n_tokens bigint"
    counted = rows.mapInArrow(count, schema)
    return counted.select(F.col("id").alias(id), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
