"""News: feed entries to an insert-ignore table and a monthly report."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    falsy_to_null,
    local_date,
    md5_key,
    naive_timestamp,
    storage_link,
    strip_ws,
    trailing_month,
    unwrap_redirect,
    url_domain,
)
from ..operators import counted, new_rows, surrogate_key, with_fetch
from ..sources import TableStore, stage

TABLE = "google_alerts_newsfeed"


def entries_of_feeds(entries: DataFrame, feeds: DataFrame) -> DataFrame:
    """Give each entry the topic, keyword and place of its feed, by the name of the landed file."""
    return entries.join(feeds.select("feed_file", "topic", "keyword", "topic_no", "feed_no", "feed_key"), "feed_file")


def transform_news(
    entries: DataFrame, manifest: DataFrame, interval_end: str, bucket: str
) -> DataFrame:
    """News rows from entries as ``entries_of_feeds`` gives them.

    Fetches are those of the run that ends at ``interval_end``, by feed and entry: an article that
    another run fetched too has another key there.
    """
    rows = entries.select(
        F.struct("topic_no", "feed_no", "entry_no").alias("place"),
        "feed_key",
        "entry_no",
        "topic",
        "keyword",
        unwrap_redirect(strip_ws(F.col("href"))).alias("url"),
        local_date(F.col("published")).alias("date"),
        strip_ws(F.col("title")).alias("title"),
        "content",
    )
    fetched = with_fetch(rows, manifest, ("feed_key", "entry_no"), interval_end).drop("feed_key", "entry_no").withColumns(
        {
            "created_at": naive_timestamp(F.lit(interval_end)),
            "hash": md5_key(F.col("topic"), F.col("keyword"), F.col("url")),
            "domain": url_domain(F.col("url")),
            "s3_bucket": F.lit(bucket),
        }
    )
    keyed = fetched.withColumn("id", surrogate_key("hash"))
    return falsy_to_null(keyed, ["domain", "content", "s3_key"])


def first_entry() -> list[Column]:
    """Order of the entries of one batch that share a hash: that of the feeds and of the entries in them."""
    return [F.col(c).asc_nulls_last() for c in ("place", "date", "title", "content")]


def load_news(store: TableStore, rows: DataFrame) -> tuple[int, int]:
    """Add the rows with a new hash; returns the batch's size, on which a report is refreshed, and how many were new."""
    with stage(rows, "news") as (batch, size):
        fresh, seen = counted(new_rows(store.read(TABLE), batch, "hash", *first_entry()))
        store.append(TABLE, fresh)
        return size, seen.get["rows"]


def news_report(table: DataFrame, now: datetime | str) -> DataFrame:
    """Live news of the trailing month."""
    recent = trailing_month(table, "date", now).where("deleted_at IS NULL")
    link = storage_link(F.col("s3_bucket"), F.col("s3_key")).alias("s3")
    return recent.select("id", "topic", "keyword", "date", "domain", "url", "title", "content", link)
