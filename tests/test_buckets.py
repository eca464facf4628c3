import datetime as dt
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from gleanery.checks import storage
from gleanery.sources import BucketedTable
from gleanery.streaming import first_of_keys

SCHEMA = "key string, n int"


def bag(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def table(spark, tmp_path):
    return BucketedTable(spark, str(tmp_path / "table"), SCHEMA, "key", buckets=16, bits=1 << 12)


def given(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_loads_against_a_dictionary(spark, table):
    """Repeated and NULL keys, one key with most rows, batches that overlap, an empty batch."""
    draw, want = random.Random(1), {}
    for load in range(4):
        rows = [(draw.choice(["hot", None, f"k{draw.randrange(60)}"]), load * 1000 + i) for i in range(draw.choice([0, 50, 90]) if load else 80)]
        for _ in range(2):  # a load that is run again adds nothing
            table.insert_ignore(given(spark, rows), F.col("n"))
        for key, n in sorted(rows, key=lambda r: r[1]):
            want.setdefault(key, n)
        assert bag(table.read()) == sorted(want.items(), key=repr)


def test_a_batch_reads_its_buckets_only(spark, table):
    table.insert_ignore(given(spark, [(f"k{i}", i) for i in range(400)]), F.col("n"))
    assert len(table.buckets_of(given(spark, [(f"k{i}", 0) for i in range(400)]).select("key"))) == 16
    assert table.buckets_of(given(spark, [("k7", 0)]).select("key")) == [table.read().where("key = 'k7'").select(table._bucket(F.col("key"))).first()[0]]
    unknown = given(spark, [(f"other{i}", 0) for i in range(20)])
    assert len(table.buckets_of(unknown.select("key"))) <= 2  # false positives are rare
    files = lambda df: {r[0] for r in df.select(F.input_file_name()).distinct().collect()}
    one, all_ = files(table.read([3])), files(table.read())
    assert all("bucket=3/" in f for f in one) and 0 < len(one) < len(all_) / 8
    plan = table.new_rows(given(spark, [("k7", 9), ("new", 9)]), F.col("n"))._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^]]*bucket#", plan)
    assert bag(table.new_rows(given(spark, [("k7", 9), ("new", 9)]), F.col("n"))) == [("new", 9)]


def test_a_full_sketch_costs_reading_only(spark, tmp_path):
    small = BucketedTable(spark, str(tmp_path / "small"), SCHEMA, "key", buckets=2, bits=64)
    small.insert_ignore(given(spark, [(f"k{i}", i) for i in range(300)]), F.col("n"))
    small.insert_ignore(given(spark, [(f"k{i}", -1) for i in range(290, 310)]), F.col("n"))
    assert bag(small.read()) == sorted(((f"k{i}", i if i < 300 else -1) for i in range(310)), key=repr)


def test_a_load_that_broke_off(spark, table, tmp_path):
    """Its bits are there, its rows are not: the next load adds them."""
    bits = table._bits(given(spark, [("a", 1)]).select("key")).groupBy("bucket", "word").agg(F.bit_or("mask").alias("bits"))
    bits.write.mode("append").partitionBy("bucket").parquet(str(tmp_path / "table" / "sketch"))
    table.insert_ignore(given(spark, [("a", 1)]), F.col("n"))
    again = BucketedTable(spark, table.path, SCHEMA, "key", buckets=16, bits=1 << 12)  # opened anew
    assert bag(again.read()) == [("a", 1)]


def test_first_of_keys_over_restarts(spark, tmp_path):
    """Repeats in one and in later micro-batches, after a restart, and after the key's time has run out."""
    schema, day = "key string, n int, ts timestamp", lambda d, h=0: dt.datetime(2024, 1, d, h)
    landed, out, state = (str(tmp_path / f) for f in ("in", "out", "state"))

    def run(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landed)
        found = first_of_keys(stream, "key", "ts", ["n"], "1 day", 2 * 86_400_000)
        found.writeStream.trigger(availableNow=True).option("checkpointLocation", state).format("parquet").start(out).awaitTermination()
        return sorted((r.key or "", r.n) for r in spark.read.schema(schema).parquet(out).collect())

    assert run(("a", 2, day(1)), ("a", 1, day(1, 5)), ("b", 3, day(1)), (None, 4, day(1))) == [("", 4), ("a", 1), ("b", 3)]
    assert run(("a", 0, day(1, 9)), ("c", 5, day(2)), (None, 0, day(2))) == [("", 4), ("a", 1), ("b", 3), ("c", 5)]
    # The watermark moves to the ninth; all the state before it expires.
    assert run(("d", 6, day(10))) == [("", 4), ("a", 1), ("b", 3), ("c", 5), ("d", 6)]
    # Too late to count, and met again after its time.
    assert run(("x", 7, day(3)), ("a", 8, day(10, 1))) == [("", 4), ("a", 1), ("a", 8), ("b", 3), ("c", 5), ("d", 6)]
    assert run(("a", 9, day(10, 2))) == [("", 4), ("a", 1), ("a", 8), ("b", 3), ("c", 5), ("d", 6)]


def test_first_of_keys_with_many_keys_in_a_group(spark, tmp_path, monkeypatch):
    """Keys share a state: each has its own time, and a group of Arrow batches is one group."""
    monkeypatch.setattr("gleanery.streaming.dedupe.GROUPS", 2)
    schema, day = "key string, n int, ts timestamp", lambda d: dt.datetime(2024, 1, d)
    landed, out, state = (str(tmp_path / f) for f in ("in", "out", "state"))
    seen = []

    def run(*rows):
        spark.createDataFrame(list(rows), schema).repartition(3).write.mode("append").parquet(landed)
        found = first_of_keys(spark.readStream.schema(schema).parquet(landed), "key", "ts", ["n"], "1 day", 2 * 86_400_000)
        query = found.writeStream.trigger(availableNow=True).option("checkpointLocation", state).format("parquet").start(out)
        query.awaitTermination()
        seen.append(max(p["stateOperators"][0]["numRowsTotal"] for p in map(lambda p: json.loads(p.json), query.recentProgress) if p["stateOperators"]))
        return sorted((r.key or "", r.n) for r in spark.read.schema(schema).parquet(out).collect())

    want = [("", 0), *((f"k{i:03d}", i) for i in range(300))]
    assert run(*[(f"k{i:03d}", i + m, day(1)) for m in (5, 0, 9) for i in range(300)], (None, 3, day(1)), (None, 0, day(1))) == want
    # As many states as groups, not as keys.
    assert seen[-1] <= 2
    # One key goes on, the others' time runs out.
    assert run(("k007", 0, day(3))) == want
    assert run(("z", 1, day(5))) == [*want, ("z", 1)]
    assert run(("k007", 0, day(5)), ("k008", 1, day(5)), (None, 7, day(5))) == sorted([*want, ("z", 1), ("k008", 1), ("", 7)])


def test_stream_first_events_without_times(spark, tmp_path):
    """A key whose only row has no time is remembered up to the next part, as in one run over all parts."""
    at, least = dt.datetime(2024, 1, 5), {}
    events = [(0, None, "a", 1), (1, at, "a", 1), (2, at, "b", 2), (3, at, "c", 3), (4, at, "c", 3), (5, at, "a", 1), (6, at, "c", 3)]
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, event_type string, user_id long").repartition(2).write.parquet(str(tmp_path / "events.parquet"))
    for event, _, kind, user in sorted(events, key=lambda e: (e[0] % 3, e[0])):
        least.setdefault(f"{kind}-{user}", (event, event % 3))
    found = storage.stream_first_events(spark, str(tmp_path))
    assert sorted(map(tuple, found.collect())) == sorted((k, *v) for k, v in least.items())
