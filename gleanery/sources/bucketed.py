"""A table of unique keys as Parquet, partitioned by a hash of the key, with a Bloom sketch for each part.

Nothing but Spark's own files: rows under ``rows/bucket=...``, the sketches' words under ``sketch/bucket=...``.
A batch is held against the sketches first, and only the buckets that may hold one of its keys are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import latest_per_key

WORD = 64
#: Bits of a sketch that each key sets.
HASHES = 4
SKETCH = "word bigint, bits bigint, bucket int"


class BucketedTable:
    """``buckets`` parts by the hash of ``key``, each with a sketch of ``bits`` bits.

    A sketch has no false negatives; of keys that are not stored it takes a share of
    ``(1 - exp(-4 * keys / bits)) ** 4`` for stored ones, ``keys`` being those of a bucket, so about ten bits
    a key keep that at one in a hundred. Sketches merge by OR: every load adds its words, and readers merge
    them. Both numbers must stay the same over a table's life.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, buckets: int = 64, bits: int = 1 << 20):
        self.spark, self.path, self.key, self.buckets, self.bits = spark, path.rstrip("/"), key, buckets, bits
        self.schema = T.StructType.fromDDL(schema)
        for name, columns in (("rows", T.StructType([*self.schema, T.StructField("bucket", T.IntegerType())])), ("sketch", T.StructType.fromDDL(SKETCH))):
            empty = spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in columns])
            empty.write.mode("append").parquet(f"{self.path}/{name}")

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _bits(self, keys: DataFrame) -> DataFrame:
        """``key, bucket, word, mask`` for each bit that a key sets."""
        places = [F.pmod(F.xxhash64(F.lit(i), F.col("key")), F.lit(self.bits)) for i in range(HASHES)]
        each = keys.select("key", self._bucket(F.col("key")).alias("bucket"), F.explode(F.array_distinct(F.array(*places))).alias("place"))
        mask = F.expr(f"shiftleft(1L, cast(place % {WORD} AS INT))")
        return each.select("key", "bucket", F.expr(f"place div {WORD}").alias("word"), mask.alias("mask"))

    def _stored(self, name: str, schema: T.StructType) -> DataFrame:
        typed = T.StructType([*[f for f in schema if f.name != "bucket"], T.StructField("bucket", T.IntegerType())])
        return self.spark.read.schema(typed).parquet(f"{self.path}/{name}")

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """All rows, or those of some buckets: other buckets' files are not opened."""
        rows = self._stored("rows", self.schema)
        if buckets is not None:
            rows = rows.where(F.col("bucket").isin(buckets))
        return rows.select(*self.schema.names)

    def buckets_of(self, keys: DataFrame) -> list[int]:
        """Buckets that may hold one of the ``keys`` (a column ``key``); no more than the table has."""
        wanted = self._bits(keys.distinct())
        words = self._stored("sketch", T.StructType.fromDDL(SKETCH)).groupBy("bucket", "word").agg(F.bit_or("bits").alias("bits"))
        is_set = F.coalesce(F.col("bits").bitwiseAND(F.col("mask")), F.lit(0)) != 0
        held = wanted.join(words, ["bucket", "word"], "left").groupBy("key", "bucket").agg(F.bool_and(is_set).alias("held"))
        held = held.where("held").select("bucket").distinct()
        return sorted(r["bucket"] for r in held.collect())

    def new_rows(self, rows: DataFrame, *order: Column) -> DataFrame:
        """Rows whose key the table does not hold, the first one per key in the given order. A NULL key is a key."""
        first = latest_per_key(rows, [self.key], *order)
        buckets = self.buckets_of(rows.select(F.col(self.key).alias("key")))
        known = self.read(buckets).select(F.col(self.key).alias("_known")).distinct()
        return first.join(known, F.col(self.key).eqNullSafe(F.col("_known")), "left_anti")

    def insert_ignore(self, rows: DataFrame, *order: Column) -> None:
        """Add the rows whose key is new.

        The sketch is written before the rows, so a load that breaks off leaves bits without keys at worst,
        and one that is run again adds nothing twice. One load at a time may write.
        """
        present = set(rows.columns)
        fresh = self.new_rows(rows, *order)
        typed = fresh.select(*[(F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.schema])
        typed = typed.withColumn("bucket", self._bucket(F.col(self.key))).persist()
        try:
            set_bits = self._bits(typed.select(F.col(self.key).alias("key"))).groupBy("bucket", "word").agg(F.bit_or("mask").alias("bits"))
            set_bits.repartition("bucket").write.mode("append").partitionBy("bucket").parquet(f"{self.path}/sketch")
            typed.repartition("bucket").write.mode("append").partitionBy("bucket").parquet(f"{self.path}/rows")
        finally:
            typed.unpersist()
