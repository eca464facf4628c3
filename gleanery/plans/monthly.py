"""Reports kept month by month: a refresh computes the months anew whose source has changed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTS = "month string, load string"
GONE = "gone"


def write_months(rows: DataFrame, path: str, at: str, load: str) -> None:
    """Store the rows of one load by the month of ``at``; a load that is run again replaces its first try as a whole.

    Rows without a time are in the month "none".
    """
    month = F.coalesce(F.date_format(at, "yyyy-MM"), F.lit("none"))
    stored = rows.withColumn("month", month).write.mode("overwrite").option("partitionOverwriteMode", "static")
    stored.partitionBy("month").parquet(f"{path}/load={load}")


class MonthlyReport:
    """``report`` of each month of a table that ``write_months`` has filled, stored with the version of its source.

    A month's version is made of its loads with the times and numbers of rows of their files, which come from the files' names and
    footers. Report rows carry the version they were computed from, and ``read`` shows those of the recorded
    version only; versions are recorded after the rows. So of a refresh that breaks off some months are missing until the next one, but
    none is stale, and a month that has become empty shows nothing. Months are few, so their list is on the driver.
    """

    def __init__(self, spark: SparkSession, source: str, path: str, schema: str, report: Callable[[DataFrame], DataFrame]):
        self.spark, self.source, self.path, self.report = spark, source, path.rstrip("/"), report
        self.schema = T.StructType([*T.StructType.fromDDL(schema), *T.StructType.fromDDL(PARTS)])
        self._types = {"versions": "source_version string, month string"}

    def rows(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.source)

    def source_versions(self) -> DataFrame:
        """``month, source_version``; no column of the table itself is read."""
        file = F.struct("load", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_modification_time").cast("string").alias("changed"))
        files = self.rows().select("month", file.alias("file")).groupBy("month", "file").agg(F.count(F.lit(1)).alias("rows"))
        listed = F.to_json(F.sort_array(F.collect_list(F.struct("file", "rows"))))
        return files.groupBy("month").agg(F.sha2(listed, 256).alias("source_version"))

    def _recorded(self) -> DataFrame:
        empty = self.spark.createDataFrame([], self._types["versions"])
        empty.write.mode("append").parquet(f"{self.path}/versions")
        return self.spark.read.schema(self._types["versions"]).parquet(f"{self.path}/versions")

    def refresh(self) -> list[str]:
        """Compute the months whose source differs from the one they were computed from; returns them."""
        now = self.source_versions().withColumnRenamed("source_version", "now")
        # A month that has lost its source gets a version that no row has.
        pairs = now.join(self._recorded(), "month", "full").select("month", F.coalesce("now", F.lit(GONE)).alias("now"), "source_version")
        touched = {p["month"]: p["now"] for p in pairs.where("NOT (now <=> source_version)").select("month", "now").collect()}
        stale = sorted(touched)
        if not stale:
            return []
        versions = self.spark.createDataFrame(list(touched.items()), "month string, source_version string")
        part = self.report(self.rows().where(F.col("month").isin(stale)).drop("load"))
        if "month" not in part.columns:
            raise ValueError("the report must keep the column month")
        self._store(part.join(versions, "month"), "rows")
        self._store(versions, "versions")
        return stale

    def _store(self, df: DataFrame, name: str) -> None:
        # Only the months that occur are replaced.
        # One hot month is split, small ones are put together.
        df.hint("rebalance", "month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(f"{self.path}/{name}")

    def read(self) -> DataFrame:
        """The report of all months."""
        shape = self.report(self.rows().drop("load").limit(0)).schema
        typed = T.StructType([*[f for f in shape if f.name != "month"], *T.StructType.fromDDL(self._types["versions"])])
        rows = self.spark.read.schema(typed).parquet(f"{self.path}/rows")
        return rows.join(self._recorded(), ["month", "source_version"]).select(*shape.names)
