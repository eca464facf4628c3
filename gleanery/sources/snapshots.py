"""History of full snapshots that stores what changed only: plain Parquet, one folder for each load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import remove_path
from .documents import stage

# All digits of a time, so that rows that differ by a microsecond differ in their digest.
TIMES = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
KEY = ["digest", "started"]


def row_digest(columns: list[str]) -> Column:
    """SHA-256 of a row's values, names and NULLs included."""
    return F.sha2(F.to_json(F.struct(*columns), TIMES), 256)


class SnapshotHistory:
    """Rows of full snapshots as versions: a row that stays the same from load to load is stored once.

    ``versions`` holds the rows that a load brought, each with its digest and its number of equal copies, ``ends``
    the versions that it lacks, and ``loads`` one row for the load. The latter is written last: a load without it is not seen.
    A load reads digests of the stored versions, never their rows, and writes as many rows as have changed. Loads
    come in the order of their times; the last one may be run again, with other rows too, and replaces its first try.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), T.StructType.fromDDL(schema)
        self._types = {
            "versions": f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in self.schema)}, digest string, copies bigint",
            "ends": "digest string, started int",
            "loads": "at timestamp_ntz, rows bigint, added bigint, ended bigint",
        }
        clash = {"digest", "copies", "load", "started", "ended", "created_at", "deleted_at"} & set(self.schema.names)
        if clash:
            raise ValueError(f"columns that the history has itself: {sorted(clash)}")
        for name, columns in self._types.items():
            # Load 0 is empty; it gives the folder a file to read.
            spark.createDataFrame([], columns).write.mode("overwrite").parquet(f"{self.path}/{name}/load=0")

    def _read(self, name: str, upto: int | None = None) -> DataFrame:
        stored = self.spark.read.schema(f"{self._types[name]}, load int").parquet(f"{self.path}/{name}")
        return stored if upto is None else stored.where(F.col("load") <= upto)

    def loads(self) -> DataFrame:
        """``load, at, rows, added, ended`` of each load."""
        return self._read("loads")

    def _last(self) -> tuple[int, str | None]:
        last = self.loads().agg(F.max(F.struct("load", F.col("at").cast("string").alias("at"))).alias("last")).first()["last"]
        return (last["load"], last["at"]) if last else (0, None)

    def _open(self, upto: int) -> DataFrame:
        """``digest, copies, started`` of the versions that the load ``upto`` holds."""
        stored = self._read("versions", upto).select("digest", "copies", F.col("load").alias("started"))
        return stored.join(self._read("ends", upto).select(*KEY), KEY, "left_anti")

    def load(self, rows: DataFrame, now: str) -> tuple[int, int, int]:
        """Make ``rows`` the state from ``now`` on; returns the number of rows, and of versions added and ended.

        An empty snapshot ends all rows. Equal rows are one version with a number of copies, counted map-side, so one row
        repeated any number of times is no hot group; another number of copies is another version.
        """
        at = self.spark.range(1).select(F.lit(str(now)).cast("timestamp_ntz").cast("string").alias("at")).first()["at"]
        before, newest = self._last()
        if newest is not None and at < newest:
            raise ValueError(f"there is a later load of {newest}")
        if at == newest:
            remove_path(self.spark, f"{self.path}/loads/load={before}")
            before -= 1
        number = before + 1
        names = self.schema.names
        typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema])
        with stage(typed.withColumn("digest", row_digest(names)), "snapshot") as (batch, size):
            held = batch.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"))
            state = self._open(before)
            same = ["digest", "copies"]
            fresh = batch.join(held.join(state, same, "left_anti"), "digest").groupBy(*same).agg(*[F.any_value(c).alias(c) for c in names])
            counts = []
            for name, part in (("versions", fresh.select(*names, *same)), ("ends", state.join(held, same, "left_anti").select(*KEY))):
                folder = f"{self.path}/{name}/load={number}"
                part.write.mode("overwrite").parquet(folder)
                counts.append(self.spark.read.schema(self._types[name]).parquet(folder).count())
            done = self.spark.range(1).select(
                F.lit(at).cast("timestamp_ntz").alias("at"), *[F.lit(n).cast("bigint").alias(c) for n, c in zip((size, *counts), ("rows", "added", "ended"))]
            )
            done.write.mode("overwrite").parquet(f"{self.path}/loads/load={number}")
        return size, *counts

    def _versions(self) -> tuple[DataFrame, int]:
        last, _ = self._last()
        ends = self._read("ends", last).select(*KEY, F.col("load").alias("ended"))
        return self._read("versions", last).withColumnRenamed("load", "started").join(ends, KEY, "left"), last

    def live(self) -> DataFrame:
        """Rows of the last snapshot, copies included."""
        versions, _ = self._versions()
        return _each_copy(versions.where("ended IS NULL")).select(*self.schema.names)

    def spans(self) -> DataFrame:
        """One row for each version: its values, ``copies``, ``created_at`` and, once it is ended, ``deleted_at``."""
        return self._dated(self._versions()[0]).select(*self.schema.names, "copies", "created_at", "deleted_at")

    def history(self) -> DataFrame:
        """What ending all rows and adding the snapshot anew would have stored: each row once for each load that holds it."""
        versions, last = self._versions()
        each = F.explode(F.sequence("started", F.coalesce("ended", F.lit(last + 1)) - 1))
        held = versions.withColumn("started", each).withColumn("ended", F.col("started") + 1)
        return _each_copy(self._dated(held)).select(*self.schema.names, "created_at", "deleted_at")

    def _dated(self, versions: DataFrame) -> DataFrame:
        begun = self.loads().select(F.col("load").alias("started"), F.col("at").alias("created_at"))
        over = self.loads().select(F.col("load").alias("ended"), F.col("at").alias("deleted_at"))
        return versions.join(begun, "started").join(over, "ended", "left")


def _each_copy(versions: DataFrame) -> DataFrame:
    return versions.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies"))).drop("_copy")
