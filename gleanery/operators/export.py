"""Report export."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir

# Audit columns that reports leave out, and the index column's name.
AUDIT_COLUMNS = ("created_at", "updated_at", "deleted_at")
INDEX_NAME = "row_index"

# Quotes are doubled, line breaks kept inside quotes, blanks kept, NULL and '' both left empty.
CSV_OPTIONS = {
    "sep": "|",
    "header": "true",
    "escape": '"',
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def drop_audit(df: DataFrame) -> DataFrame:
    return df.drop(*AUDIT_COLUMNS)


def with_row_index(df: DataFrame, *order: Column, name: str = INDEX_NAME) -> DataFrame:
    """Rows in order with their 0-based position, for any number of rows.

    The sorted rows are checkpointed, so their partitions stay the same while each partition's
    offset is computed; only the row counts per partition meet in one task.
    """
    shared_dir(df.sparkSession)
    placed = df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()).checkpoint()
    # monotonically_increasing_id: partition number above bit 33, position in the partition below.
    part = F.shiftright("_at", 33)
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    # One row per sort partition, so this side is small by construction.
    joined = placed.join(F.broadcast(offsets), part == F.col("_part"))
    return joined.select((F.col("_offset") + place).alias(name), *df.columns)


def export_csv(df: DataFrame, path: str, *order: Column) -> None:
    """Pipe-separated files with a header and a leading index column, in order."""
    with_row_index(df, *order).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def refresh_if_loaded(rows: int, refresh: Callable[[], None]) -> bool:
    """Rebuild an export only after a load that had rows; otherwise the old one stays."""
    if rows > 0:
        refresh()
    return rows > 0
