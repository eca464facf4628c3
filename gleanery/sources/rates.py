"""Exchange-rate sheets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import RATE


def read_rates(spark: SparkSession, path: str) -> DataFrame:
    """One row per currency element; its attribute becomes ``ID`` beside the child elements."""
    sheet = spark.read.schema(RATE).option("rowTag", "Valute").option("mode", "FAILFAST").xml(path)
    return sheet.withColumnRenamed("_ID", "ID")
