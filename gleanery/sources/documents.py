"""JSON documents and the interval-keyed landing layout."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregate import counted
from ..operators.dedupe import latest_document
from ..session import remove_path, scratch_path

# Fixed value: run stamps in landing paths.
STAMP = "yyyy-MM-dd-HH-mm-ss"


def interval_path(root: str, host: str, flow: str, at: datetime) -> str:
    """Landing folder of one run."""
    return f"{root}/hosts/{host}/{flow}/interval={at:%Y-%m-%d-%H-%M-%S}"


def read_documents(spark: SparkSession, path: str, schema: str, lineage: str = "s3_key", lines: bool = False) -> DataFrame:
    """One row per JSON file, with the file's path in ``lineage``; a broken file fails the read.

    With ``lines`` there is a document on each line, as ``write_documents`` leaves them.
    """
    documents = spark.read.schema(schema).option("multiLine", not lines).option("mode", "FAILFAST").json(path)
    return documents.withColumn(lineage, F.col("_metadata.file_path"))


def read_staged(spark: SparkSession, path: str, schema: str, arrays: bool = False) -> DataFrame:
    """Rows staged by ``write_staged``; with ``arrays`` each file is one JSON array of rows."""
    return spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", arrays).json(path)


def write_staged(df: DataFrame, path: str) -> None:
    """One JSON object per line, UTF-8, replacing an earlier run's rows; NULLs are written."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_intervals(df: DataFrame, path: str, at: str = "interval_end") -> None:
    """Stage rows under ``interval=<stamp>``; a rerun replaces only the intervals it holds."""
    stamped = df.withColumn("interval", F.date_format(at, STAMP))
    writer = stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("interval").option("ignoreNullFields", False).json(path)


def write_documents(df: DataFrame, path: str, key: str, *fetch_order: str) -> None:
    """The last fetched document per key, replacing those of an earlier run."""
    write_staged(latest_document(df, key, *fetch_order), path)


@contextmanager
def stage(df: DataFrame, label: str = "batch") -> Iterator[tuple[DataFrame, int]]:
    """Write a batch once to the shared folder; gives it as read from there and its size.

    A load reads its batch several times (keys, rows, children). Staged, the documents are
    parsed once and each reader takes the columns it needs. The files go when the load has ended.
    """
    path = scratch_path(df.sparkSession, label)
    batch, seen = counted(df)
    try:
        batch.write.parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path), seen.get["rows"]
    finally:
        remove_path(df.sparkSession, path)
