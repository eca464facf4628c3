"""Atom feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import ATOM_ENTRY

# Content is stored as it came, so the reader must not trim it.
ATOM_OPTIONS = {"rowTag": "entry", "ignoreSurroundingSpaces": "false", "mode": "FAILFAST"}


def read_atom(spark: SparkSession, path: str) -> DataFrame:
    """One row per feed entry: ``feed_path, feed_file, entry_no, href, published, title, content``.

    Entities are decoded once, so escaped markup comes out as markup text. ``published`` stays
    text: a parsed timestamp would lose the offset.
    """
    return numbered(entry_columns(spark.read.schema(ATOM_ENTRY).options(**ATOM_OPTIONS).xml(path)))


def numbered(entries: DataFrame) -> DataFrame:
    """Entries with ``entry_no``, their 0-based place in their feed file.

    A file is read by one task from start to end, so the order of its rows is that of its entries.
    For a stream, number each micro-batch.
    """
    read = entries.withColumn("_at", F.monotonically_increasing_id())
    place = F.row_number().over(Window.partitionBy("feed_path").orderBy("_at")) - 1
    return read.withColumn("entry_no", place).drop("_at")


def entry_columns(entries: DataFrame) -> DataFrame:
    return entries.select(
        F.col("_metadata.file_path").alias("feed_path"),
        F.col("_metadata.file_name").alias("feed_file"),
        *fields_of(F.struct("link", "published", "title", "content")),
    )


def fields_of(entry: Column) -> list[Column]:
    return [
        entry["link"]["_href"].alias("href"),
        entry["published"].alias("published"),
        entry["title"]["_VALUE"].alias("title"),
        entry["content"]["_VALUE"].alias("content"),
    ]


def expand_feeds(config: DataFrame, topic_ordinal: str = "topic_no") -> DataFrame:
    """One row per feed of each topic, with a key that is unique over (topic, feed).

    ``feed_file`` is the name the feed is landed under.
    """
    key = F.concat_ws("-", topic_ordinal, "feed_no")
    return config.select(topic_ordinal, "topic", F.posexplode("feeds").alias("feed_no", "feed")).select(
        "topic",
        F.col("feed.keyword").alias("keyword"),
        F.col("feed.url").alias("feed"),
        topic_ordinal,
        "feed_no",
        key.alias("feed_key"),
        F.concat(F.lit("feed-"), key, F.lit(".xml")).alias("feed_file"),
    )
