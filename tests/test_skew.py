"""A third of all rows under one key: results stay whole and the joins split the hot partition."""

import pytest
from pyspark.sql import functions as F

from gleanery import operators as op

ROWS = 60_000
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture
def skewed(spark):
    before = {k: spark.conf.get(k) for k in SETTINGS}
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    for key, value in {**SETTINGS, "spark.sql.shuffle.partitions": "16"}.items():
        spark.conf.set(key, value)
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5000))
    yield spark.range(0, ROWS, 1, 8).select("id", key.alias("key"), F.md5(F.col("id").cast("string")).alias("body"))
    for k, v in {**before, "spark.sql.shuffle.partitions": partitions}.items():
        spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_keyed_replace(skewed):
    table = skewed.withColumns({c: F.lit(None).cast("timestamp_ntz") for c in ("created_at", "updated_at", "deleted_at")})
    batch = skewed.where("id % 2 = 0").withColumn("created_at", F.lit("2023-01-01").cast("timestamp_ntz"))
    state = op.keyed_replace(table, batch, "key", "2023-01-01")
    assert "skew=true" in final_plan(state)
    live = state.where("deleted_at IS NULL")
    assert state.count() == ROWS + ROWS // 2
    assert live.where("key = 'hot'").count() == ROWS // 6


def test_lookup(skewed):
    dictionary = skewed.groupBy("key").agg(F.max("body").alias("title"))
    found, rejects = op.lookup(skewed, dictionary, "key", "key", {"title": "title"})
    assert "skew=true" in final_plan(found)
    assert found.where("title IS NOT NULL").count() == ROWS and rejects.isEmpty()


def test_lookup_of_missing_keys(skewed):
    """NULL as the hot key."""
    facts = skewed.withColumn("key", F.nullif("key", F.lit("hot")))
    dictionary = skewed.groupBy("key").agg(F.max("body").alias("title"))
    found, _ = op.lookup(facts, dictionary, "key", "key", {"title": "title"})
    assert "skew=true" in final_plan(found)
    assert found.where("title IS NULL").count() == ROWS // 3


def test_latest_moves_few_rows(skewed):
    newest = op.latest_per_key(skewed, ["key"], F.col("id").desc())
    assert "WindowGroupLimit" in final_plan(newest)
    assert newest.where("key = 'hot'").first().id == ROWS - 3


def test_insert_ignore(skewed):
    table = skewed.where("key = 'hot'").limit(1).select("id", "key")
    state = op.insert_ignore(table, skewed.select("id", "key"), "key", F.col("id"))
    assert state.count() == state.select("key").distinct().count() == skewed.select("key").distinct().count()


def test_fetch(skewed):
    entries = skewed.select("id", F.col("key").alias("url"))
    manifest = entries.select("url", F.lit(200).alias("status"), F.concat(F.lit("html/"), "url").alias("s3_key"))
    fetched = op.with_fetch(entries, manifest)
    assert "skew=true" in final_plan(fetched)
    assert fetched.where("s3_key = 'html/' || url").count() == ROWS


def test_children_of_one_parent(skewed):
    children = skewed.withColumnRenamed("key", "parent")
    stored = children.where("parent = 'hot'").union(children.where("parent = 'hot'"))
    fresh = op.not_yet_stored(stored, children, "parent")
    assert "skew=true" in final_plan(fresh)
    assert fresh.count() == ROWS - ROWS // 3
