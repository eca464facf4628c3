"""The loads, run more than once over changing batches into stored tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import climb_to_top, export_csv, paths_to_top, refresh_if_loaded
from ..operators.export import CSV_OPTIONS
from ..plans import actives, backfill, rates, vacancies
from ..session import scratch_path
from ..sources import TableStore, merge_hits
from .base import Registry, table
from .flows import _codes, _hits, _types

checks = Registry()
QUERIES, ORACLES = checks.queries, checks.oracles


@checks.add("""
    SELECT DISTINCT ON (char_code) char_code, value, loads FROM (
        SELECT p_type AS char_code, p_retailprice AS value, DATE '2023-03-01' AS date, 1 AS load FROM part
        UNION ALL SELECT p_type, p_retailprice * 2, DATE '2023-03-02', 2 FROM part WHERE p_size > 10
        UNION ALL SELECT p_type, p_retailprice * 3, DATE '2023-03-02', 3 FROM part WHERE p_size > 30),
        (SELECT count(*) + count(*) FILTER (p_size > 10) + count(*) FILTER (p_size > 30) AS loads FROM part)
    ORDER BY char_code, date DESC, load DESC, value DESC
""")
def rates_load(spark, sf_dir):
    """Two days, the second loaded twice with different values: the later load wins."""
    store = TableStore(spark, scratch_path(spark, "store"))
    parts = table(spark, sf_dir, "part")
    loads = 0
    for day, hour, size, factor in (("01", "12", 0, 1), ("02", "12", 10, 2), ("02", "13", 30, 3)):
        sheet = parts.where(F.col("p_size") > size).select(
            # The same currency and day give equal ids apart from the load; the value decides.
            F.col("p_type").alias("char_code"),
            F.col("p_type").alias("currency_id"),
            (F.col("p_retailprice") * factor).alias("value"),
            F.lit(f"2023-03-{day}").cast("date").alias("date"),
        )
        loads += rates.load_rates(store, sheet, f"2023-03-{day} {hour}:00:00")
    return rates.latest_rates(store.read(rates.TABLE)).select("char_code", "value", F.lit(loads).cast("bigint").alias("loads"))


_CHILDREN = "c_mktsegment || '; a' AS skills, 2 AS roles"


@checks.add(f"""
    SELECT c_custkey AS hh_id, 'first' AS title, TIMESTAMP '2023-03-01' AS created_at, TIMESTAMP '2023-03-08' AS deleted_at, {_CHILDREN}
    FROM customer
    UNION ALL SELECT c_custkey, 'second', TIMESTAMP '2023-03-08', NULL, {_CHILDREN} FROM customer WHERE c_acctbal > 0
""")
def vacancies_load(spark, sf_dir):
    """A snapshot load after another, the second one run twice, with the children of either."""
    store = TableStore(spark, scratch_path(spark, "store"))
    role = F.struct(F.lit("7").alias("hh_professional_role_dict_id"), F.lit("r").alias("title"))
    skill = lambda text: F.struct(text.alias("title"))
    customers = table(spark, sf_dir, "customer").select(
        "c_acctbal",
        F.col("c_custkey").alias("hh_id"),
        F.array(role, role).alias("professional_roles"),
        F.array(skill(F.col("c_mktsegment")), skill(F.lit("a"))).alias("skills"),
    )
    vacancies.load_vacancies(store, customers.withColumn("title", F.lit("first")), "2023-03-01 00:00:00")
    second = customers.where("c_acctbal > 0").withColumn("title", F.lit("second"))
    for _ in range(2):
        vacancies.load_vacancies(store, second, "2023-03-08 00:00:00")
    skills = store.read(vacancies.SKILLS).groupBy(F.col("vacancy_id").alias("id"))
    roles = store.read(vacancies.ROLES).groupBy(F.col("vacancy_id").alias("id"))
    stored = store.read(vacancies.TABLE).join(skills.agg(F.array_join(F.sort_array(F.collect_list("title")), "; ").alias("skills")), "id")
    counted = stored.join(roles.agg(F.count(F.lit(1)).cast("int").alias("roles")), "id")
    return counted.select("hh_id", "title", "created_at", "deleted_at", "skills", "roles")


@checks.add("""
    WITH codes AS (SELECT o_orderkey, p_partkey FROM orders JOIN part ON p_partkey = (o_custkey % 7) * 10 + o_orderkey % 9 AND p_size <= 40)
    SELECT CAST(o_orderkey AS VARCHAR) AS object_id, TIMESTAMP '2023-01-15' AS created_at,
        CASE WHEN o_orderstatus <> 'F' THEN TIMESTAMP '2023-02-15' END AS deleted_at, p_partkey AS oecd_id
    FROM orders LEFT JOIN codes USING (o_orderkey)
    UNION ALL SELECT CAST(o_orderkey AS VARCHAR), TIMESTAMP '2023-02-15', NULL, p_partkey
    FROM orders LEFT JOIN codes USING (o_orderkey) WHERE o_orderstatus <> 'F'
""")
def actives_load(spark, sf_dir):
    """Monthly loads by backfill; the second holds a part of the objects and ends their earlier rows."""
    store = TableStore(spark, scratch_path(spark, "store"))
    rows, _ = actives.transform_actives(_hits(spark, sf_dir), _types(spark, sf_dir), "bucket", "2023-04-15")
    codes = _codes(spark, sf_dir)

    def run(end):
        batch = rows if end.month == 1 else rows.where("kind <> 'nioktrs'")
        return actives.load_actives(store, batch, codes, str(end))

    backfill.run_intervals(spark, "2023-01-15", "2023-02-15", run)
    bridge = store.read(actives.BRIDGE).withColumnRenamed("active_id", "id")
    return store.read(actives.TABLE).join(bridge, "id", "left").select("object_id", "created_at", "deleted_at", "oecd_id")


def _chains(spark, sf_dir):
    step = F.pmod("c_custkey", F.lit(12))
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.when(step > 0, F.col("c_custkey") - 1).alias("parent_id"),
        F.when(step > 0, F.concat(F.lit("N"), "c_custkey")).otherwise("Top").alias("name"),
    )


def _backfill_sql(end: str) -> str:
    return f"""
    WITH loads AS (
        SELECT o_orderkey, o_custkey, TIMESTAMP '2021-01-15' + to_months(CAST(m AS INTEGER)) AS created_at
        FROM orders, range(24) months(m) WHERE (o_orderkey + m) % 5 = 0),
    ended AS (
        SELECT *, lead(created_at) OVER (PARTITION BY o_orderkey ORDER BY created_at) AS next,
            nullif(max(created_at) OVER (PARTITION BY o_orderkey), created_at) AS last FROM loads)
    SELECT CAST(o_orderkey AS VARCHAR) AS object_id, created_at, {end} AS deleted_at, {end} AS updated_at, p_partkey AS oecd_id
    FROM ended LEFT JOIN part ON p_partkey = (o_custkey % 7) * 10 + o_orderkey % 9 AND p_size <= 40
    """


def _backfill(spark, sf_dir, only_live):
    store = TableStore(spark, scratch_path(spark, "store"))
    rows, _ = actives.transform_actives(_hits(spark, sf_dir), _types(spark, sf_dir), "bucket", "2021-01-15")
    # Every object is found in each fifth month.
    due = F.filter(F.sequence(F.lit(0), F.lit(23)), lambda m: F.pmod(F.col("object_id").cast("bigint") + m, F.lit(5)) == 0)
    monthly = rows.withColumn("month", F.explode(due))
    created = F.expr("timestamp_ntz'2021-01-15' + make_ym_interval(0, month)")
    actives.load_actives_history(store, monthly.withColumn("created_at", created).drop("month"), _codes(spark, sf_dir), only_live)
    # Ids are hex digits: as bytes they are half as long to move.
    bridge = store.read(actives.BRIDGE).select(F.unhex("active_id").alias("id"), "oecd_id")
    return store.read(actives.TABLE).withColumn("id", F.unhex("id")).join(bridge, "id", "left").select("object_id", "created_at", "deleted_at", "updated_at", "oecd_id")


@checks.add(_backfill_sql("last"))
def actives_backfill(spark, sf_dir):
    """The loads of 24 months at once; each stamps the earlier rows of its objects again."""
    return _backfill(spark, sf_dir, only_live=False)


@checks.add(_backfill_sql("next"))
def actives_backfill_live(spark, sf_dir):
    return _backfill(spark, sf_dir, only_live=True)


@checks.add("""
    SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS row_index, c_custkey AS hh_id, 'first' AS title FROM customer
""")
def gated_export(spark, sf_dir):
    """Load, count, gate, file: the empty second load leaves the file of the first."""
    store, path = TableStore(spark, scratch_path(spark, "store")), scratch_path(spark, "csv")
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("hh_id"),
        F.lit("first").alias("title"),
        F.array().cast("array<struct<hh_professional_role_dict_id:string,title:string>>").alias("professional_roles"),
        F.array().cast("array<struct<title:string>>").alias("skills"),
    )
    for now, batch in (("2023-03-01 00:00:00", customers), ("2023-03-08 00:00:00", customers.where("hh_id IS NULL"))):
        size = vacancies.load_vacancies(store, batch, now)
        refresh_if_loaded(size, lambda: export_csv(store.read_live(vacancies.TABLE).select("hh_id", "title"), path, F.col("hh_id")))
    return spark.read.schema("row_index BIGINT, hh_id BIGINT, title STRING").options(**CSV_OPTIONS).csv(path)


@checks.add("""
    SELECT CAST(o_custkey AS VARCHAR) AS org_id, 'rids' AS type, count(*) > 0 AND o_custkey % 5 <> 0 OR ceil(count(*) / 2.0) = 1 AS complete,
        CAST(ceil(count(*) / 2.0) AS BIGINT) AS expected
    FROM orders GROUP BY o_custkey
""")
def hits_completeness(spark, sf_dir):
    """Pages of two hits; of every fifth organisation only the first page was landed."""
    orders = table(spark, sf_dir, "orders")
    numbered = orders.selectExpr("o_custkey", "o_orderkey", "row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS n", "count(*) OVER (PARTITION BY o_custkey) AS total")
    hit = F.struct(F.col("o_orderkey").cast("string").alias("_id"))
    pages = numbered.groupBy("o_custkey", "total", F.floor(F.col("n") / 2).cast("int").alias("page")).agg(F.collect_list(hit).alias("found"))
    landed = pages.where((F.pmod("o_custkey", F.lit(5)) != 0) | (F.col("page") == 0)).select(
        F.col("o_custkey").cast("string").alias("org_id"),
        F.lit("rids").alias("type"),
        "page",
        F.struct(F.struct(F.col("total").alias("value")).alias("total"), F.col("found").alias("hits")).alias("hits"),
    )
    _, completeness = merge_hits(landed, size=2)
    return completeness.select("org_id", "type", "complete", F.col("expected").cast("bigint").alias("expected"))


@checks.add("""
    SELECT CAST(o_orderkey AS VARCHAR) AS id, max(l_linenumber) AS fetched FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    WHERE o_orderstatus <> 'F' AND (o_custkey % 5 <> 0 OR (SELECT count(*) FROM orders AS o WHERE o.o_custkey = orders.o_custkey) <= 2)
    GROUP BY o_orderkey
""")
def listed_documents(spark, sf_dir):
    """From landed pages to documents: lists without a page are held back, closed items left out, the last fetch taken."""
    item = F.struct(
        F.col("o_orderkey").cast("string").alias("id"),
        F.struct(F.when(F.col("o_orderstatus") == "F", "closed").otherwise("open").alias("id")).alias("type"),
    )
    numbered = table(spark, sf_dir, "orders").selectExpr(
        "o_custkey", "o_orderkey", "o_orderstatus", "row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS n", "count(*) OVER (PARTITION BY o_custkey) AS total"
    )
    page = F.floor(F.col("n") / 2).cast("int").alias("page")
    pages = numbered.groupBy(F.col("o_custkey").alias("employer_id"), page, F.ceil(F.col("total") / 2).cast("int").alias("pages"))
    pages = pages.agg(F.collect_list(item).alias("items")).where("employer_id % 5 <> 0 OR page = 0")
    fetches = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("id"), F.col("l_linenumber").alias("fetched"))
    items, _ = vacancies.listed_vacancies(pages)
    return vacancies.documents_of_list(items, fetches, "fetched").select("id", "fetched")


@checks.add("""
    WITH RECURSIVE nodes AS (
        SELECT c_custkey AS id, CASE WHEN c_custkey % 12 > 0 THEN c_custkey - 1 END AS parent_id,
            CASE WHEN c_custkey % 12 > 0 THEN 'N' || c_custkey ELSE 'Top' END AS name FROM customer),
    -- The lowest customer may have no parent in the table.
    linked AS (SELECT id, CASE WHEN parent_id IN (SELECT id FROM nodes) THEN parent_id END AS parent_id, name FROM nodes),
    paths AS (
        SELECT id, name AS path, 1 AS depth FROM linked WHERE parent_id IS NULL
        UNION ALL SELECT n.id, p.path || '/' || n.name, p.depth + 1 FROM linked n JOIN paths p ON n.parent_id = p.id)
    SELECT id, path, CAST(depth AS INTEGER) AS depth FROM paths
""")
def hierarchy_paths(spark, sf_dir):
    """Whole paths, of twelve nodes each."""
    nodes = _chains(spark, sf_dir)
    known = nodes.select(F.col("id").alias("parent_id"), F.lit(True).alias("known"))
    linked = nodes.join(known, "parent_id", "left").withColumn("parent_id", F.when(F.col("known"), F.col("parent_id")))
    return paths_to_top(linked.select("id", "parent_id", "name")).select("id", F.array_join("path", "/").alias("path"), "depth")


@checks.add("""
    SELECT c_custkey AS id, CASE WHEN c_custkey % 12 > 0 THEN 'N' || (c_custkey - c_custkey % 12 + 1) END AS top_name FROM customer
""")
def deep_hierarchy(spark, sf_dir):
    """Paths of twelve nodes."""
    return climb_to_top(_chains(spark, sf_dir), "Top")
