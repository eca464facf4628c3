"""Loads that store what changed, reports that refresh what changed, and input of which some is broken."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import agg_text, text_of_segments, text_segments
from ..plans.monthly import MonthlyReport, write_months
from ..session import scratch_path
from ..sources import SnapshotHistory, split_atom, split_documents
from .base import Registry, table

checks = Registry()
QUERIES, ORACLES = checks.queries, checks.oracles

DAYS = ("2023-03-01", "2023-03-08", "2023-03-15")


def _snapshots(spark, sf_dir, *columns: str) -> SnapshotHistory:
    """Three snapshots: all customers; without those in debt, every tenth renamed; all again. The second is run twice."""
    customers = table(spark, sf_dir, "customer")
    title = F.when(F.pmod("c_custkey", F.lit(10)) == 0, "new").otherwise("old")
    second = customers.where("c_acctbal >= 0").withColumn("title", title)
    first = customers.withColumn("title", F.lit("old"))
    types = {"c_custkey": "bigint", "c_nationkey": "int", "c_mktsegment": "string", "title": "string"}
    history = SnapshotHistory(spark, scratch_path(spark, "snapshots"), ", ".join(f"{c} {types[c]}" for c in columns))
    for day, batch in zip((DAYS[0], DAYS[1], DAYS[1], DAYS[2]), (first, customers.limit(0).withColumn("title", title), second, first)):
        history.load(batch.select(*columns), f"{day} 00:00:00")
    return history


_SQL_RENAMED = "CASE WHEN c_custkey % 10 = 0 THEN 'new' ELSE 'old' END"


@checks.add(f"""
    SELECT c_nationkey, c_mktsegment, 'old' AS title, TIMESTAMP '{DAYS[0]}' AS created_at, TIMESTAMP '{DAYS[1]}' AS deleted_at FROM customer
    UNION ALL SELECT c_nationkey, c_mktsegment, {_SQL_RENAMED}, TIMESTAMP '{DAYS[1]}', TIMESTAMP '{DAYS[2]}' FROM customer WHERE c_acctbal >= 0
    UNION ALL SELECT c_nationkey, c_mktsegment, 'old', TIMESTAMP '{DAYS[2]}', NULL FROM customer
""")
def snapshot_history(spark, sf_dir):
    """Rows without a key, many of them equal: each once for each load, as if every load had stored its rows anew."""
    return _snapshots(spark, sf_dir, "c_nationkey", "c_mktsegment", "title").history()


@checks.add(f"""
    SELECT 1 AS load, count(*) AS rows, count(*) AS added, 0::BIGINT AS ended FROM customer
    UNION ALL SELECT 2, count(*) FILTER (c_acctbal >= 0), count(*) FILTER (c_acctbal >= 0 AND c_custkey % 10 = 0),
        count(*) FILTER (c_acctbal < 0 OR c_custkey % 10 = 0) FROM customer
    UNION ALL SELECT 3, count(*), count(*) FILTER (c_acctbal < 0 OR c_custkey % 10 = 0), count(*) FILTER (c_acctbal >= 0 AND c_custkey % 10 = 0) FROM customer
""")
def snapshot_writes(spark, sf_dir):
    """What each load wrote: its changes."""
    return _snapshots(spark, sf_dir, "c_custkey", "title").loads().select("load", "rows", "added", "ended")


@checks.add(f"""
    SELECT c_custkey, 'old' AS title, TIMESTAMP '{DAYS[0]}' AS created_at, TIMESTAMP '{DAYS[1]}' AS deleted_at FROM customer
    WHERE c_acctbal < 0 OR c_custkey % 10 = 0
    UNION ALL SELECT c_custkey, 'old', TIMESTAMP '{DAYS[0]}', NULL FROM customer WHERE c_acctbal >= 0 AND c_custkey % 10 <> 0
    UNION ALL SELECT c_custkey, 'new', TIMESTAMP '{DAYS[1]}', TIMESTAMP '{DAYS[2]}' FROM customer WHERE c_acctbal >= 0 AND c_custkey % 10 = 0
    UNION ALL SELECT c_custkey, 'old', TIMESTAMP '{DAYS[2]}', NULL FROM customer WHERE c_acctbal < 0 OR c_custkey % 10 = 0
""")
def snapshot_spans(spark, sf_dir):
    """Each version once, with the loads that brought and ended it."""
    return _snapshots(spark, sf_dir, "c_custkey", "title").spans().drop("copies")


_SQL_LINES = """
    WITH lines AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 97 = 0 THEN 'not JSON' WHEN o_orderkey % 89 = 0 THEN 'not of the schema' END AS reason,
        '{"id": ' || CASE WHEN o_orderkey % 97 <> 0 AND o_orderkey % 89 = 0 THEN '"x' || o_orderkey || '"' ELSE o_orderkey::VARCHAR END
            || ', "status": "' || o_orderstatus || '"' || CASE WHEN o_orderkey % 97 = 0 THEN '' ELSE '}' END AS record FROM orders)
"""


@checks.add(
    _SQL_LINES
    + """SELECT CASE WHEN reason IS NULL THEN o_orderkey END AS id, CASE WHEN reason IS NULL THEN o_orderstatus END AS status, reason,
        CASE WHEN reason IS NOT NULL THEN record END AS record FROM lines"""
)
def quarantine_documents(spark, sf_dir):
    """Documents by line, some cut off, some with a text for a number: sound ones and rejects together are all of them."""
    cut, typed = F.pmod("o_orderkey", F.lit(97)) == 0, F.pmod("o_orderkey", F.lit(89)) == 0
    number = F.when(~cut & typed, F.concat(F.lit('"x'), "o_orderkey", F.lit('"'))).otherwise(F.col("o_orderkey").cast("string"))
    line = F.concat(F.lit('{"id": '), number, F.lit(', "status": "'), "o_orderstatus", F.lit('"'), F.when(cut, "").otherwise("}"))
    landed, target = scratch_path(spark, "landed"), scratch_path(spark, "split")
    table(spark, sf_dir, "orders").select(line.alias("value")).write.text(landed)
    good, rejects = split_documents(spark, landed, "id BIGINT, status STRING", target, lines=True)
    nothing = F.lit(None).cast("string")
    sound = good.select("id", "status", nothing.alias("reason"), nothing.alias("record"))
    return sound.unionByName(rejects.select(F.lit(None).cast("bigint").alias("id"), nothing.alias("status"), "reason", "record"))


@checks.add("""
    SELECT 'https://example.org/' || page_id AS href, 'p' || page_id AS title, page_id % 7 = 0 AS broken FROM pages WHERE page_id % 7 <> 0
    UNION ALL SELECT NULL, NULL, true FROM pages WHERE page_id % 7 = 0
""")
def quarantine_feed(spark, sf_dir):
    """Entries of feeds, every seventh with a tag that is not closed."""
    entry = F.concat(
        F.lit('<entry><link href="https://example.org/'), "page_id", F.lit('"/><published>2023-03-01</published><title type="html">p'), "page_id",
        F.when(F.pmod("page_id", F.lit(7)) == 0, "<b></title>").otherwise("</title>"), F.lit("<content>c</content></entry>"),
    )
    landed, target = scratch_path(spark, "landed"), scratch_path(spark, "split")
    table(spark, sf_dir, "pages").select(entry.alias("value")).write.text(landed)
    good, rejects = split_atom(spark, landed, target)
    nothing = F.lit(None).cast("string")
    return good.select("href", "title", F.lit(False).alias("broken")).unionByName(rejects.select(nothing.alias("href"), nothing.alias("title"), F.lit(True).alias("broken")))


def _by_status(rows):
    by = ["month", "o_orderpriority"]
    totals = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("orders"), F.max("o_totalprice").alias("highest"))
    statuses = agg_text(rows.select(*by, "o_orderstatus").distinct(), by, "o_orderstatus", "statuses")
    return totals.join(statuses, by)


def _refreshed(spark, sf_dir):
    """Orders in three loads, the last of one year's, each followed by a refresh; gives the report and the months of each refresh."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice", "o_orderpriority")
    source = scratch_path(spark, "orders")
    schema = "o_orderkey BIGINT, o_orderdate TIMESTAMP_NTZ, o_orderstatus STRING, o_totalprice DOUBLE, o_orderpriority STRING"
    report = MonthlyReport(spark, source, scratch_path(spark, "report"), schema, _by_status)
    late = "o_orderkey % 3 = 2 AND year(o_orderdate) = 1998"
    refreshed = []
    for number, rows in enumerate(("o_orderkey % 3 = 0", f"o_orderkey % 3 <> 0 AND NOT ({late})", late), 1):
        write_months(orders.where(rows), source, "o_orderdate", str(number))
        refreshed.append(report.refresh())
    return report, refreshed


@checks.add("""
    SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderpriority, count(*) AS orders, max(o_totalprice) AS highest,
        string_agg(DISTINCT o_orderstatus, '; ' ORDER BY o_orderstatus) AS statuses
    FROM orders GROUP BY ALL
""")
def monthly_refresh(spark, sf_dir):
    """The report after three refreshes is that of all orders."""
    return _refreshed(spark, sf_dir)[0].read()


@checks.add("""
    SELECT o_orderstatus, octet_length(encode(string_agg(text, '; ' ORDER BY text))) AS bytes, string_agg(text, '; ' ORDER BY text) AS texts
    FROM (SELECT o_orderstatus, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority ELSE o_orderpriority || ' ' || o_orderkey END AS text FROM orders)
    GROUP BY o_orderstatus
""")
def hot_text_segments(spark, sf_dir):
    """The texts of three keys, each of many segments, a third of them repeats."""
    repeated = F.pmod("o_orderkey", F.lit(3)) == 0
    text = F.when(repeated, F.col("o_orderpriority")).otherwise(F.concat_ws(" ", "o_orderpriority", "o_orderkey"))
    orders = table(spark, sf_dir, "orders").select("o_orderstatus", text.alias("text"))
    segments = text_segments(orders, ["o_orderstatus"], "text", "texts", size=1 << 12)
    return text_of_segments(segments, ["o_orderstatus"], "texts").drop("segments")
