"""Load semantics, one row per key, reports over periods."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import latest_period
from ..operators import (
    agg_codes,
    agg_text,
    append_rows,
    insert_ignore,
    keyed_replace,
    latest_per_key,
    snapshot_replace,
    split_parent_child,
    with_children,
)
from .base import Registry, table

checks = Registry()
QUERIES, ORACLES = checks.queries, checks.oracles

NOW = "2023-03-31 10:30:00"


# Stored: the first event of each key until the 16th; batch: all events from the 10th on.
@checks.add("""
    WITH keyed AS (
        SELECT event_id, ts, event_type || '-' || user_id || '-' || hour(ts) AS event_key FROM events),
    stored AS (
        SELECT DISTINCT ON (event_key) event_key, event_id, CASE WHEN event_id % 4 = 0 THEN ts END AS deleted_at
        FROM keyed WHERE ts < '2024-01-16' ORDER BY event_key, event_id),
    fresh AS (
        SELECT DISTINCT ON (event_key) event_key, event_id, CAST(NULL AS TIMESTAMP) AS deleted_at
        FROM keyed WHERE ts >= '2024-01-10' AND event_key NOT IN (SELECT event_key FROM stored)
        ORDER BY event_key, event_id)
    FROM stored UNION ALL FROM fresh
""")
def insert_ignore_events(spark, sf_dir):
    key = F.concat_ws("-", "event_type", "user_id", F.hour("ts"))
    events = table(spark, sf_dir, "events").select(key.alias("event_key"), "event_id", "ts")
    first = latest_per_key(events.where("ts < timestamp_ntz'2024-01-16'"), ["event_key"], F.col("event_id"))
    stored = first.select(
        "event_key", "event_id", F.when(F.pmod("event_id", F.lit(4)) == 0, F.col("ts")).alias("deleted_at")
    )
    batch = events.where("ts >= timestamp_ntz'2024-01-10'").select("event_key", "event_id")
    return insert_ignore(stored, batch, "event_key", F.col("event_id"))


def _versions(df):
    """Rows as stored versions; those of one kind were ended earlier."""
    return df.withColumns(
        {
            "created_at": F.lit("2023-01-01").cast("timestamp_ntz"),
            "updated_at": F.lit(None).cast("timestamp_ntz"),
        }
    )


@checks.add(f"""
    SELECT c_custkey, TIMESTAMP '2023-01-01' AS created_at,
        CASE WHEN c_mktsegment = 'MACHINERY' THEN TIMESTAMP '2023-02-01' ELSE TIMESTAMP '{NOW}' END AS deleted_at,
        CASE WHEN c_mktsegment <> 'MACHINERY' THEN TIMESTAMP '{NOW}' END AS updated_at
    FROM customer
    UNION ALL
    SELECT c_custkey, TIMESTAMP '{NOW}', NULL, NULL FROM customer WHERE c_acctbal > 0
""")
def snapshot_replace_customers(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    ended = F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("2023-02-01").cast("timestamp_ntz"))
    stored = _versions(customers.select("c_custkey", ended.alias("deleted_at")))
    batch = customers.where("c_acctbal > 0").select(
        "c_custkey", F.lit(NOW).cast("timestamp_ntz").alias("created_at")
    )
    return snapshot_replace(stored, batch, NOW)


def _keyed(spark, sf_dir, only_live):
    orders = table(spark, sf_dir, "orders")
    ended = F.when(F.col("o_orderstatus") == "F", F.lit("2023-02-01").cast("timestamp_ntz"))
    before = orders.where("o_orderdate < timestamp_ntz'2001-01-01'")
    stored = _versions(before.select("o_orderkey", "o_custkey", ended.alias("deleted_at")))
    batch = orders.where("o_orderdate >= timestamp_ntz'2001-01-01'").select(
        "o_orderkey", "o_custkey", F.lit(NOW).cast("timestamp_ntz").alias("created_at")
    )
    return keyed_replace(stored, batch, "o_custkey", NOW, only_live)


def _keyed_sql(hit: str) -> str:
    return f"""
    WITH batch AS (SELECT * FROM orders WHERE o_orderdate >= '2001-01-01'),
    stored AS (
        SELECT o_orderkey, o_custkey, o_custkey IN (SELECT o_custkey FROM batch) AND {hit} AS hit,
            CASE WHEN o_orderstatus = 'F' THEN TIMESTAMP '2023-02-01' END AS old
        FROM orders WHERE o_orderdate < '2001-01-01')
    SELECT o_orderkey, o_custkey, TIMESTAMP '2023-01-01' AS created_at,
        CASE WHEN hit THEN TIMESTAMP '{NOW}' END AS updated_at,
        CASE WHEN hit THEN TIMESTAMP '{NOW}' ELSE old END AS deleted_at
    FROM stored
    UNION ALL SELECT o_orderkey, o_custkey, TIMESTAMP '{NOW}', NULL, NULL FROM batch
    """


@checks.add(_keyed_sql("true"))
def keyed_replace_orders(spark, sf_dir):
    return _keyed(spark, sf_dir, only_live=False)


@checks.add(_keyed_sql("o_orderstatus <> 'F'"))
def keyed_replace_live_orders(spark, sf_dir):
    return _keyed(spark, sf_dir, only_live=True)


@checks.add(f"""
    SELECT s_suppkey, s_name, s_acctbal, CAST(NULL AS TIMESTAMP) AS created_at FROM supplier
    UNION ALL SELECT s_suppkey, s_name, NULL, TIMESTAMP '{NOW}' FROM supplier
""")
def append_suppliers(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier")
    stored = suppliers.select("s_suppkey", "s_name", "s_acctbal", F.lit(None).cast("timestamp_ntz").alias("created_at"))
    batch = suppliers.select("s_suppkey", "s_name", F.lit(NOW).cast("timestamp_ntz").alias("created_at"))
    return append_rows(stored, batch)


@checks.add("""
    SELECT doc_id, CAST(unnest(range(len(lines))) AS INTEGER) AS ordinal, unnest(lines) AS title
    FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)
""")
def parent_child(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("title"))).alias("lines")
    )
    parents, children = split_parent_child(documents, ["doc_id"], {"lines": ["title"]}, "document_id")
    lines = children["lines"]
    return lines.join(parents, lines["document_id"] == parents["id"]).select("doc_id", "ordinal", "title")


@checks.add("""
    SELECT DISTINCT p_partkey, word AS code
    FROM (SELECT p_partkey, unnest(string_split(p_name || ' ' || p_type, ' ')) AS word FROM part)
""")
def parent_bridge(spark, sf_dir):
    words = F.split(F.concat_ws(" ", "p_name", "p_type"), " ")
    parts = table(spark, sf_dir, "part").select("p_partkey", F.array_distinct(words).alias("codes"))
    parents, children = split_parent_child(parts, ["p_partkey"], {"codes": ["code"]}, "part_id")
    bridge = children["codes"]
    return bridge.join(parents, bridge["part_id"] == parents["id"]).select("p_partkey", "code")


@checks.add("""
    SELECT DISTINCT ON (user_id) user_id, event_id, ts, event_type FROM events
    ORDER BY user_id, ts DESC, event_id DESC
""")
def latest_event_per_user(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    return latest_per_key(events, ["user_id"], F.col("ts").desc_nulls_first(), F.col("event_id").desc())


@checks.add("""
    SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, o_orderdate, n_name, r_name
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
        JOIN region ON r_regionkey = n_regionkey
    WHERE o_orderdate >= '1996-01-01' AND r_name <> 'ASIA'
    ORDER BY o_custkey, o_orderdate DESC, o_orderkey DESC
""")
def latest_after_join(spark, sf_dir):
    joined = (
        table(spark, sf_dir, "orders")
        .where("o_orderdate >= timestamp_ntz'1996-01-01'")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region").where("r_name <> 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("o_custkey", "o_orderkey", "o_orderdate", "n_name", "r_name")
    )
    return latest_per_key(joined, ["o_custkey"], F.col("o_orderdate").desc_nulls_first(), F.col("o_orderkey").desc())


@checks.add("SELECT DISTINCT ON (p_name) p_name, p_partkey FROM part ORDER BY p_name, p_partkey")
def distinct_dictionary(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_name", "p_partkey")
    return latest_per_key(parts, ["p_name"], F.col("p_partkey").asc())


@checks.add("""
    SELECT o_orderkey, o_orderdate, titles FROM orders JOIN (
        SELECT l_orderkey, string_agg(p_name, '; ' ORDER BY p_name) AS titles
        FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey) ON l_orderkey = o_orderkey
""")
def string_agg_children(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    titles = agg_text(lines.select(F.col("l_orderkey").alias("o_orderkey"), "p_name"), ["o_orderkey"], "p_name", "titles")
    return with_children(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), titles, on="o_orderkey")


@checks.add("""
    SELECT l_orderkey, string_agg(concat(code, ' - ', p_name), '; ' ORDER BY concat(code, ' - ', p_name)) AS oecd
    FROM lineitem JOIN (
        SELECT p_partkey, p_name, CASE WHEN p_size % 5 <> 0 THEN p_brand END AS code FROM part) ON p_partkey = l_partkey
    GROUP BY l_orderkey
""")
def coded_string_agg(spark, sf_dir):
    codes = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(F.pmod("p_size", F.lit(5)) != 0, F.col("p_brand")).alias("code"),
        F.col("p_name").alias("title"),
    )
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    return agg_codes(lines, codes, F.col("l_partkey") == F.col("p_partkey"), ["l_orderkey"], "oecd")


_PERIOD_SQL = """
    SELECT o_orderkey, o_orderdate, c_name, n_name, lines FROM orders
        JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
        JOIN (SELECT l_orderkey, string_agg(concat(p_brand, ' - ', p_name), '; ' ORDER BY concat(p_brand, ' - ', p_name)) AS lines
            FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey) ON l_orderkey = o_orderkey
    WHERE o_orderdate >= {lower} AND o_orderdate <= last_day((SELECT max(o_orderdate) FROM orders))
"""


def period_report(spark, sf_dir, from_month_start):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    period = latest_period(orders, "o_orderdate", from_month_start=from_month_start)
    codes = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("code"), F.col("p_name").alias("title"))
    # Lines of reported orders only, so the aggregate is as small as the period.
    lines = (
        table(spark, sf_dir, "lineitem")
        .select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
        .join(period.select("o_orderkey"), "o_orderkey", "left_semi")
    )
    texts = agg_codes(lines, codes, F.col("l_partkey") == F.col("p_partkey"), ["o_orderkey"], "lines")
    named = period.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return with_children(named.select("o_orderkey", "o_orderdate", "c_name", "n_name"), texts, on="o_orderkey")


@checks.add(_PERIOD_SQL.format(lower="(SELECT max(o_orderdate) FROM orders)"))
def latest_period_report(spark, sf_dir):
    return period_report(spark, sf_dir, from_month_start=False)


@checks.add(_PERIOD_SQL.format(lower="date_trunc('month', (SELECT max(o_orderdate) FROM orders))"))
def latest_month_report(spark, sf_dir):
    return period_report(spark, sf_dir, from_month_start=True)
