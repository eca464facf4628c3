"""Nested documents: unnesting, pages, requests, trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import const_if_present, flatten, open_items, reshape_structs, total_items, unnest_entries, unnest_map
from ..plans.backfill import with_windows
from ..sources import expand_feeds, flatten_area_tree, merge_hits, merge_pages, plan_pages, plan_requests
from ..functions.rules import RESULT_TYPES
from .base import Registry, table

checks = Registry()
QUERIES, ORACLES = checks.queries, checks.oracles


@checks.add("""
    SELECT source AS topic, lang AS keyword, unnest(string_split(text, chr(10))) AS feed, doc_id AS topic_no,
        CAST(unnest(range(len(string_split(text, chr(10))))) AS INTEGER) AS feed_no,
        doc_id || '-' || unnest(range(len(string_split(text, chr(10))))) AS feed_key,
        'feed-' || doc_id || '-' || unnest(range(len(string_split(text, chr(10))))) || '.xml' AS feed_file
    FROM documents
""")
def feed_expand(spark, sf_dir):
    config = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("topic_no"),
        F.col("source").alias("topic"),
        F.transform(
            F.split("text", "\n"), lambda line: F.struct(line.alias("url"), F.col("lang").alias("keyword"))
        ).alias("feeds"),
    )
    return expand_feeds(config)


@checks.add("""
    SELECT conv_id, turn, CAST(unnest(range(len(string_split(text, ' ')))) AS INTEGER) AS ordinal,
        unnest(string_split(text, ' ')) AS item
    FROM conversations
""")
def entry_unnest(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.split("text", " ").alias("entries"))
    return unnest_entries(turns, "entries")


@checks.add("""
    SELECT o_custkey AS hh_university_id, CAST(o_orderkey AS VARCHAR) AS id FROM orders WHERE o_orderstatus <> 'F'
    UNION ALL SELECT o_custkey, o_orderkey || '-b' FROM orders WHERE o_orderpriority <> '5-LOW'
""")
def open_list_items(spark, sf_dir):
    def item(suffix, closed):
        kind = F.struct(F.when(closed, "closed").otherwise("open").alias("id"))
        return F.struct(F.concat(F.col("o_orderkey").cast("string"), F.lit(suffix)).alias("id"), kind.alias("type"))

    lists = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("hh_university_id"),
        F.array(
            item("", F.col("o_orderstatus") == "F"), item("-b", F.col("o_orderpriority") == "5-LOW")
        ).alias("lists_of_vacancies"),
    )
    return open_items(lists).select("hh_university_id", F.col("item.id").alias("id"))


def _event_maps(spark, sf_dir):
    """One document per event: its type mapped to a few items, and another type to one."""
    item = F.struct(F.col("value").alias("name"), F.col("props").alias("extra"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.create_map(
            F.lit("seen"), F.array_repeat(item, (F.pmod("user_id", F.lit(3))).cast("int")), F.col("event_type"), F.array(item)
        ).alias("actives"),
    )


@checks.add("""
    SELECT event_id, 'seen' AS kind, CAST(unnest(range(user_id % 3)) AS INTEGER) AS ordinal, value AS name FROM events
    UNION ALL SELECT event_id, event_type, 0, value FROM events
""")
def map_unnest(spark, sf_dir):
    return unnest_map(_event_maps(spark, sf_dir), "actives").select("event_id", "kind", "ordinal", "item.name")


@checks.add("SELECT event_id, user_id % 3 + 1 AS found FROM events")
def map_totals(spark, sf_dir):
    return _event_maps(spark, sf_dir).select("event_id", total_items(F.col("actives")).alias("found"))


@checks.add("""
    SELECT p_partkey, p_name || ', ' || p_brand AS roles, CASE WHEN p_size > 10 THEN p_type END AS kind,
        CASE WHEN p_size > 10 THEN 'RUR' END AS currency
    FROM part
""")
def nested_projection(spark, sf_dir):
    role = lambda title: F.struct(F.col("p_size").alias("id"), F.col(title).alias("name"))
    documents = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.array(role("p_name"), role("p_brand")).alias("professional_roles"),
        F.when(F.col("p_size") > 10, F.struct(F.col("p_type").alias("name"))).alias("experience"),
    )
    flat = flatten(documents, {"p_partkey": "p_partkey", "roles": "professional_roles", "kind": "experience.name", "paid": "experience"})
    titles = reshape_structs(F.col("roles"), {"title": "name"})["title"]
    return flat.select(
        "p_partkey",
        F.array_join(titles, ", ").alias("roles"),
        "kind",
        const_if_present(F.col("paid"), "RUR").alias("currency"),
    )


def _landed_pages(spark, sf_dir):
    """Documents as lists of lines in pages of ten; the first page was landed twice.

    Every ninth list lacks its last page (when it has more than one).
    """
    count = F.ceil(F.size("lines") / F.lit(10)).cast("int")
    lists = table(spark, sf_dir, "documents").select("doc_id", F.split("text", "\n").alias("lines"))
    numbers = F.concat(F.array(F.lit(0)), F.sequence(F.lit(0), F.col("pages") - 1))

    def page(no):
        return F.struct(no.alias("page"), F.slice("lines", no * 10 + 1, F.lit(10)).alias("items"))

    pages = lists.withColumn("pages", count).select(
        "doc_id", "pages", F.size("lines").alias("total"), F.explode(F.transform(numbers, page)).alias("at")
    )
    landed = pages.where(
        (F.pmod("doc_id", F.lit(9)) != 0) | (F.col("pages") == 1) | (F.col("at.page") < F.col("pages") - 1)
    )
    return landed.select("doc_id", "at.page", "pages", "at.items", "total")


_SQL_LINES = """
    WITH lists AS (
        SELECT doc_id, string_split(text, chr(10)) AS lines, CAST(ceil(len(string_split(text, chr(10))) / 10.0) AS INTEGER) AS pages
        FROM documents),
    numbered AS (
        SELECT doc_id, pages, unnest(range(len(lines))) AS n, unnest(lines) AS item FROM lists),
    landed AS (
        SELECT doc_id, CAST(n // 10 AS INTEGER) AS page, CAST(n % 10 AS INTEGER) AS ordinal, item FROM numbered
        WHERE doc_id % 9 <> 0 OR pages = 1 OR n // 10 < pages - 1)
"""


@checks.add(_SQL_LINES + "SELECT doc_id, page, ordinal, item FROM landed")
def page_merge(spark, sf_dir):
    merged, _ = merge_pages(_landed_pages(spark, sf_dir), ["doc_id"])
    return merged


@checks.add(
    _SQL_LINES
    + """SELECT doc_id, CASE WHEN doc_id % 9 <> 0 OR pages = 1 THEN pages ELSE pages - 1 END AS landed,
        pages AS expected, doc_id % 9 <> 0 OR pages = 1 AS complete FROM lists"""
)
def page_completeness(spark, sf_dir):
    _, complete = merge_pages(_landed_pages(spark, sf_dir), ["doc_id"])
    return complete.select("doc_id", F.col("landed").cast("int").alias("landed"), "expected", "complete")


def _search_pages(spark, sf_dir):
    """The landed pages as search results; equal lines of a list are the same hit."""
    source = F.transform("items", lambda line: F.struct(F.md5(line).alias("_id"), line.alias("name")))
    return _landed_pages(spark, sf_dir).select(
        F.concat(F.lit("org"), "doc_id").alias("org_id"),
        F.lit("rids").alias("type"),
        (F.col("page") + 1).alias("page"),
        F.struct(
            F.struct(F.col("total").cast("bigint").alias("value")).alias("total"), source.alias("hits")
        ).alias("hits"),
    )


@checks.add(_SQL_LINES + "SELECT DISTINCT 'org' || doc_id AS org_id, 'rids' AS type, item AS name FROM landed")
def hit_merge(spark, sf_dir):
    hits, _ = merge_hits(_search_pages(spark, sf_dir))
    return hits.select("org_id", "type", F.col("hit.name").alias("name"))


@checks.add("""
    SELECT s_name AS rosrid_id, type, '2023-01-01' AS start_date, '2023-01-31' AS end_date, type = 'nioktrs' AS nioktrs,
        type = 'rids' AS rids, type = 'dissertations' AS dissertations, 'Во всех полях' AS search_area,
        CAST(unnest(range(1, CAST(ceil((s_suppkey % 40) / 10.0) AS INTEGER) + 1)) AS INTEGER) AS page
    FROM (SELECT *, unnest(['nioktrs', 'rids', 'dissertations']) AS type FROM supplier)
""")
def request_manifest(spark, sf_dir):
    orgs = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("rosrid_id"), "s_suppkey")
    requests = plan_requests(orgs, F.lit("2023-04-15"))
    totals = orgs.select("rosrid_id", F.ceil(F.pmod("s_suppkey", F.lit(40)) / F.lit(10)).cast("int").alias("pages"))
    asked = requests.withColumn("rosrid_id", F.element_at("organization", 1)).join(totals, "rosrid_id")
    return plan_pages(asked, F.lit(1), F.col("pages")).select(
        "rosrid_id", "type", "start_date", "end_date", *RESULT_TYPES, "search_area", "page"
    )


@checks.add("""
    SELECT 'c' || c_custkey AS id, NULL AS parent_id, c_name AS name FROM customer
    UNION ALL SELECT 'c' || c_custkey || part, 'c' || c_custkey, c_mktsegment
        FROM customer, (VALUES ('-1'), ('-2')) AS t(part)
    UNION ALL SELECT 'c' || c_custkey || '-1-1', 'c' || c_custkey || '-1', 'leaf' FROM customer
""")
def area_tree_flatten(spark, sf_dir):
    def node(suffix, parent, name, areas):
        key = lambda end: F.concat(F.lit("c"), "c_custkey", F.lit(end))
        return F.struct(
            key(suffix).alias("id"),
            (F.lit(None).cast("string") if parent is None else key(parent)).alias("parent_id"),
            name.alias("name"),
            areas.alias("areas"),
        )

    no_text = F.array().cast("array<string>")
    leaf = node("-1-1", "-1", F.lit("leaf"), no_text)
    first = node("-1", "", F.col("c_mktsegment"), F.array(leaf))
    second = node("-2", "", F.col("c_mktsegment"), F.filter(F.array(leaf), lambda _: F.lit(False)))
    root = node("", None, F.col("c_name"), F.array(first, second))
    trees = table(spark, sf_dir, "customer").select(F.array(root).alias("areas"))
    return flatten_area_tree(trees, depth=3)


@checks.add("""
    SELECT DISTINCT interval_end, CAST(date_trunc('month', interval_end - INTERVAL 3 MONTH) AS DATE) AS start_date,
        CAST(date_trunc('month', interval_end - INTERVAL 3 MONTH) + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE) AS end_date
    FROM (SELECT CAST(date_trunc('month', o_orderdate) + INTERVAL 14 DAY AS DATE) AS interval_end FROM orders)
""")
def backfill_windows(spark, sf_dir):
    """The window of every monthly run needed to cover the orders."""
    ends = table(spark, sf_dir, "orders").select(
        F.date_add(F.trunc(F.col("o_orderdate").cast("date"), "month"), 14).alias("interval_end")
    )
    return with_windows(ends.distinct(), F.col("interval_end"))
