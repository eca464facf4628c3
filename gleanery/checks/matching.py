"""Look-ups, hierarchies and name matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import climb_to_top, live, lookup, nearest_name, org_list, with_fetch
from .base import Registry, table

checks = Registry()
QUERIES, ORACLES = checks.queries, checks.oracles


def _coded_orders(spark, sf_dir):
    """Orders with a code that the dictionary of part types may lack."""
    code = F.when(F.col("o_orderpriority") == "1-URGENT", "PROMO").when(
        F.col("o_orderpriority") != "5-LOW", F.substring("o_orderpriority", 3, 6)
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", code.alias("code"))
    types = table(spark, sf_dir, "part").groupBy(F.col("p_type").alias("title")).agg(F.min("p_partkey").alias("id"))
    return lookup(orders, types, "code", "title", {"id": "type_id"})


_SQL_CODED = """
    WITH coded AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'PROMO'
            WHEN o_orderpriority <> '5-LOW' THEN substr(o_orderpriority, 3, 6) END AS code FROM orders),
    types AS (SELECT p_type AS title, min(p_partkey) AS id FROM part GROUP BY p_type)
"""


@checks.add(_SQL_CODED + "SELECT o_orderkey, code, id AS type_id FROM coded LEFT JOIN types ON code = title")
def dictionary_lookup(spark, sf_dir):
    return _coded_orders(spark, sf_dir)[0]


@checks.add(
    _SQL_CODED
    + """SELECT code AS key, count(*) AS rows FROM coded
    WHERE code IS NOT NULL AND code NOT IN (SELECT title FROM types) GROUP BY code"""
)
def lookup_rejects(spark, sf_dir):
    return _coded_orders(spark, sf_dir)[1]


@checks.add("""
    WITH RECURSIVE nodes AS (
        SELECT 'w' AS id, NULL AS parent_id, 'World' AS name
        UNION ALL SELECT 'x', NULL, 'Elsewhere'
        UNION ALL SELECT 'r' || r_regionkey, CASE WHEN r_name = 'ASIA' THEN 'x' ELSE 'w' END, r_name FROM region
        UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, n_name FROM nation
        UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, c_name FROM customer),
    climbed AS (
        SELECT id, CAST(NULL AS VARCHAR) AS top_name, name AS root, 0 AS depth FROM nodes WHERE parent_id IS NULL
        UNION ALL
        SELECT n.id, CASE WHEN c.depth = 0 THEN n.name ELSE c.top_name END, c.root, c.depth + 1
        FROM nodes n JOIN climbed c ON n.parent_id = c.id)
    SELECT id, CASE WHEN root = 'World' THEN top_name END AS top_name FROM climbed
""")
def hierarchy_region(spark, sf_dir):
    def level(name, prefix, key, parent, title):
        return table(spark, sf_dir, name).select(
            F.concat(F.lit(prefix), key).alias("id"), parent.alias("parent_id"), F.col(title).alias("name")
        )

    roots = spark.sql(
        "SELECT id, CAST(NULL AS STRING) AS parent_id, name FROM VALUES ('w', 'World'), ('x', 'Elsewhere') AS t(id, name)"
    )
    above = F.when(F.col("r_name") == "ASIA", "x").otherwise("w")
    nodes = (
        roots.unionByName(level("region", "r", "r_regionkey", above, "r_name"))
        .unionByName(level("nation", "n", "n_nationkey", F.concat(F.lit("r"), "n_regionkey"), "n_name"))
        .unionByName(level("customer", "c", "c_custkey", F.concat(F.lit("n"), "c_nationkey"), "c_name"))
    )
    return climb_to_top(nodes, "World")


# Each part name against one edited name per brand; the SQL fills the LCS table row by row: a
# cell is the maximum over the cells to its left and above, and one more than the diagonal on a match.
@checks.add("""
    WITH RECURSIVE names AS (SELECT DISTINCT p_name AS name FROM part),
    brands AS (SELECT CAST(substr(p_brand, 7) AS BIGINT) AS id,
        max(p_name || ' ' || p_type) AS title FROM part GROUP BY p_brand),
    steps AS (
        SELECT name, id, title, 0 AS i, list_transform(range(length(title) + 1), lambda x: 0) AS cells
        FROM names, brands
        UNION ALL
        SELECT name, id, title, i + 1, list_prepend(0, list_transform(range(1, length(title) + 1),
            lambda j: list_max(list_transform(range(1, j + 1), lambda k: greatest(cells[k + 1],
                CASE WHEN substr(title, k, 1) = substr(name, i + 1, 1) THEN cells[k] + 1 ELSE 0 END)))))
        FROM steps WHERE i < length(name)),
    scored AS (
        SELECT name, id, title, CASE WHEN name = title THEN 100 ELSE CAST(round_even(
            100.0::DOUBLE * (2.0::DOUBLE * cells[len(cells)] / (length(name) + length(title))), 0) AS INTEGER) END AS score
        FROM steps WHERE i = length(name))
    SELECT DISTINCT ON (name) name, id AS match_id, title AS match_title, score
    FROM scored ORDER BY name, score DESC, id
""")
def fuzzy_match(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    brands = parts.groupBy(F.substring("p_brand", 7, 9).cast("bigint").alias("id")).agg(
        F.max(F.concat_ws(" ", "p_name", "p_type")).alias("title")
    )
    return nearest_name(parts, "p_name", brands)


# Each supplier against all customers. A row of the LCS table is a number with a bit for each letter of the name.
@checks.add("""
    WITH RECURSIVE names AS (
        SELECT name, length(name) AS n, (1::HUGEINT << length(name)::HUGEINT) - 1 AS ones, map_from_entries(list((letter, mask))) AS masks
        FROM (SELECT name, letter, sum(1::HUGEINT << (i - 1)::HUGEINT)::HUGEINT AS mask FROM (
            SELECT name, i, substr(name, i, 1) AS letter
            FROM (SELECT name, unnest(range(1, length(name) + 1)) AS i FROM (SELECT DISTINCT s_name || ' of ' || s_nationkey AS name FROM supplier)))
            GROUP BY name, letter) GROUP BY name),
    titles AS (SELECT c_custkey AS id, c_name || ' of ' || c_nationkey AS title FROM customer),
    steps AS (
        SELECT name, id, n, ones, masks, title, 0 AS i, ones AS cells FROM names, titles
        UNION ALL
        SELECT name, id, n, ones, masks, title, i + 1, ((cells + (cells & coalesce(masks[substr(title, i + 1, 1)], 0)))
            | (cells - (cells & coalesce(masks[substr(title, i + 1, 1)], 0)))) & ones
        FROM steps WHERE i < length(title)),
    scored AS (
        SELECT name, id, title, CAST(round_even(100.0::DOUBLE * (2.0::DOUBLE * (n - bit_count(cells)) / (n + length(title))), 0) AS INTEGER) AS score
        FROM steps WHERE i = length(title))
    SELECT DISTINCT ON (name) name, id AS match_id, title AS match_title, score FROM scored ORDER BY name, score DESC, id
""")
def nearest_customer(spark, sf_dir):
    """Names and titles grow with the tables, so the dictionary has many blocks."""
    labelled = lambda name, nation: F.concat_ws(" of ", name, F.col(nation).cast("string"))
    suppliers = table(spark, sf_dir, "supplier").select(labelled("s_name", "s_nationkey").alias("name"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), labelled("c_name", "c_nationkey").alias("title"))
    return nearest_name(suppliers, "name", customers)


@checks.add("""
    SELECT page_id, url, CASE WHEN page_id % 4 <> 0 AND page_id % 7 <> 0 THEN 'html/' || page_id END AS s3_key
    FROM pages
""")
def fetch_left_join(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    # Every seventh page was never fetched, every fourth was not found.
    manifest = pages.where(F.pmod("page_id", F.lit(7)) != 0).select(
        "url",
        F.when(F.pmod("page_id", F.lit(4)) == 0, 404).otherwise(200).alias("status"),
        F.concat(F.lit("html/"), "page_id").alias("s3_key"),
    )
    return with_fetch(pages, manifest).select("page_id", "url", "s3_key")


@checks.add("""
    SELECT n_nationkey AS university_id, s_suppkey AS rosrid_university_id, s_name AS rosrid_id, n_name AS ogrn
    FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE s_acctbal >= 0 AND n_regionkey <> 2
""")
def org_lists(spark, sf_dir):
    ended = F.lit("2023-01-01").cast("timestamp_ntz")
    bridge = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.col("s_nationkey").alias("university_id"),
        F.col("s_name").alias("rosrid_id"),
        F.when(F.col("s_acctbal") < 0, ended).alias("deleted_at"),
    )
    orgs = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("id"),
        F.col("n_name").alias("ogrn"),
        F.when(F.col("n_regionkey") == 2, ended).alias("deleted_at"),
    )
    return org_list(bridge, orgs)


@checks.add("""
    SELECT c_custkey, employer_id FROM (
        SELECT c_custkey, CASE WHEN c_nationkey <> 3 THEN c_nationkey END AS employer_id FROM customer
        WHERE c_mktsegment <> 'MACHINERY') WHERE employer_id IS NOT NULL
""")
def live_rows(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_nationkey") != 3, F.col("c_nationkey")).alias("employer_id"),
        F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("2023-01-01").cast("timestamp_ntz")).alias("deleted_at"),
    )
    return live(customers, "employer_id").drop("deleted_at")
