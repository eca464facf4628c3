"""Stored tables as partitioned Parquet: live rows in one part, ended rows in a part for the day they ended on.

Nothing but Spark's own files under ``<root>/<table>/part=...``. A load replaces the parts that it changes by
dynamic partition overwrite: one that only ends live rows writes the live part and the days it ends rows on.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import TABLES
from ..session import remove_path, scratch_path

LIVE = "live"
#: Ids are hex digits, which only a codec with entropy coding makes half as long.
CODEC = "zstd"
#: Repeated rows of which copies of this many hashes (8 bytes each) go to every task, at most.
REPEATS = 1 << 17


class TableStore:
    """The tables of ``schemas.TABLES`` under ``root``. One load at a time may write a table.

    A next state is computed once, into the shared folder, since it is made of the very files that it replaces.
    From there ended rows are written before the live ones that they were. So a load that breaks off leaves
    ended rows that are live as well at worst, and run again it ends them in the same way: equal rows of a day
    are one row. Spark swaps the folder of a part by a deletion and a rename; should the driver be lost between the
    two, that part is found in the shared folder only, under ``state-...``, which then stays.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _stored(self, name: str) -> DataFrame:
        """The table's rows with their ``part``; none if nothing was ever loaded."""
        stored = T.StructType([*T.StructType.fromDDL(TABLES[name]), T.StructField("part", T.StringType())])
        try:
            return self.spark.read.schema(stored).parquet(self._path(name))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in stored])

    def read(self, name: str) -> DataFrame:
        return self._stored(name).drop("part")

    def read_live(self, name: str) -> DataFrame:
        """Live rows; files of ended ones are not opened."""
        return self._stored(name).where(F.col("part") == LIVE).drop("part")

    def _typed(self, name: str, rows: DataFrame) -> DataFrame:
        columns, present = T.StructType.fromDDL(TABLES[name]), set(rows.columns)
        typed = rows.select(*[(F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name) for f in columns])
        ended = F.date_format("deleted_at", "yyyy-MM-dd") if "deleted_at" in columns.names else F.lit(None)
        return typed.withColumn("part", F.coalesce(ended, F.lit(LIVE)))

    def append(self, name: str, rows: DataFrame) -> None:
        """Add rows; nothing stored is read or written again."""
        self._typed(name, rows).write.mode("append").option("compression", CODEC).partitionBy("part").parquet(self._path(name))

    def replace_live(self, name: str, rows: DataFrame) -> None:
        """Put ``rows``, a next state of the live rows, in their place; ended ones join those of their days."""
        with self._state(name, rows) as (state, parts):
            days = [p for p in parts if p != LIVE]
            # Rows of another load of such a day, or of a try that broke off.
            earlier = self._stored(name).where(F.col("part").isin(days))
            with self._once(state.where(F.col("part") != LIVE).unionByName(earlier)) as ended:
                self._overwrite(name, ended, days)
            self._overwrite_live(name, state, parts)

    def replace(self, name: str, rows: DataFrame) -> None:
        """Put ``rows``, a next state of the whole table, in its place."""
        before = self._parts(self._stored(name))
        with self._state(name, rows) as (state, parts):
            days = [p for p in parts if p != LIVE]
            with self._once(state.where(F.col("part") != LIVE)) as ended:
                self._overwrite(name, ended, days)
            self._overwrite_live(name, state, parts)
            for part in set(before) - {LIVE, *parts}:
                remove_path(self.spark, f"{self._path(name)}/part={part}")

    @staticmethod
    def _parts(rows: DataFrame) -> list[str]:
        """The parts that rows lie in, one for each day at most."""
        return sorted(r["part"] for r in rows.select("part").distinct().collect())

    @contextmanager
    def _state(self, name: str, rows: DataFrame) -> Iterator[tuple[DataFrame, list[str]]]:
        path = scratch_path(self.spark, f"state-{name}")
        typed = self._typed(name, rows)
        typed.write.option("compression", CODEC).partitionBy("part").parquet(path)
        state = self.spark.read.schema(typed.schema).parquet(path)
        yield state, self._parts(state)
        # Not after a failure: the copy may then be the only one of a part.
        remove_path(self.spark, path)

    @contextmanager
    def _once(self, rows: DataFrame) -> Iterator[DataFrame]:
        """Each of the rows once. Hashes are moved to find repeats, and of the rows only those whose hash comes again, while such hashes are few."""
        path, columns = scratch_path(self.spark, "repeats"), rows.columns
        hashed = rows.withColumn("_hash", F.xxhash64(*columns))
        hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_hash").write.parquet(path)
        again = self.spark.read.schema("_hash bigint").parquet(path)
        repeats = again.count()
        if repeats > REPEATS:
            yield rows.distinct()
        elif repeats:
            found = lambda how: hashed.join(F.broadcast(again), "_hash", how).select(*columns)
            yield found("left_anti").unionByName(found("left_semi").distinct())
        else:
            yield rows
        remove_path(self.spark, path)

    def _overwrite(self, name: str, rows: DataFrame, parts: list[str]) -> None:
        """Replace ``parts``, those that ``rows`` lie in."""
        if parts:
            writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", CODEC)
            writer.partitionBy("part").parquet(self._path(name))

    def _overwrite_live(self, name: str, state: DataFrame, parts: list[str]) -> None:
        if LIVE in parts:
            self._overwrite(name, state.where(F.col("part") == LIVE), [LIVE])
        else:
            # An overwrite without rows leaves the part as it is.
            remove_path(self.spark, f"{self._path(name)}/part={LIVE}")
