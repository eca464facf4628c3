"""The four flows and their reports, fed with documents and tables derived from the supplied ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import with_fetch
from ..plans import actives, news, vacancies
from ..session import scratch_path
from ..sources import TableStore
from .base import Registry, table

checks = Registry()
QUERIES, ORACLES = checks.queries, checks.oracles

ENDED = "2023-01-01"
NEWS_INTERVAL = "2023-04-30 14:00:00+03:00"


def _ended(condition):
    return F.when(condition, F.lit(ENDED).cast("timestamp_ntz"))


# --- news ---------------------------------------------------------------------------------------


def page_entries(spark, sf_dir):
    """Pages as feed entries with topic and keyword; the links are wrapped in redirects."""
    href = F.concat(F.lit(" https://www.google.com/url?sa=t&url="), "url", F.lit("&ct=ga&cd=1 "))
    day = F.date_add(F.lit("2023-01-01").cast("date"), F.pmod("page_id", F.lit(120)).cast("int"))
    return table(spark, sf_dir, "pages").select(
        F.lit("наука").alias("topic"),
        F.lit("вуз").alias("keyword"),
        href.alias("href"),
        F.concat(day.cast("string"), F.lit("T23:30:00+03:00")).alias("published"),
        F.concat(F.lit("  "), F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1), F.lit(" ")).alias("title"),
        F.col("html").alias("content"),
        "page_id",
        F.lit(0).alias("topic_no"),
        F.lit(0).alias("feed_no"),
        F.lit("0-0").alias("feed_key"),
        F.col("page_id").cast("int").alias("entry_no"),
    )


def page_manifest(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        F.lit(NEWS_INTERVAL).alias("interval"),
        F.lit("0-0").alias("feed_key"),
        F.col("page_id").cast("int").alias("entry_no"),
        "url",
        F.when(F.pmod("page_id", F.lit(4)) == 0, 404).otherwise(200).alias("status"),
        F.concat(F.lit("html/"), "page_id").alias("s3_key"),
    )


SQL_NEWS = """
    SELECT md5('наука' || 'вуз' || url) AS hash, 'наука' AS topic, 'вуз' AS keyword, url,
        CAST(DATE '2023-01-01' + CAST(page_id % 120 AS INTEGER) AS DATE) AS date,
        regexp_replace(split_part(split_part(url, '://', 2), '/', 1), '^www[.]', '') AS domain,
        trim(regexp_extract(html, '<title>(.*?)</title>', 1, 's'), ' ' || chr(9) || chr(10) || chr(13) || chr(160)) AS title,
        nullif(html, '') AS content, CASE WHEN page_id % 4 <> 0 THEN 'html/' || page_id END AS s3_key,
        TIMESTAMP '2023-04-30 14:00:00' AS created_at
    FROM pages
"""
NEWS_COLUMNS = ("hash", "topic", "keyword", "url", "date", "domain", "title", "content", "s3_key", "created_at")


def news_rows(spark, sf_dir):
    return news.transform_news(
        page_entries(spark, sf_dir), page_manifest(spark, sf_dir), NEWS_INTERVAL, "bucket"
    )


@checks.add(f"""
    SELECT hash, topic, keyword, url, date, domain, content, s3_key, created_at,
        CASE WHEN date < DATE '2023-02-01' THEN 'stored: ' ELSE 'first: ' END || title AS title,
        CASE WHEN date < DATE '2023-02-01' AND s3_key IS NULL THEN TIMESTAMP '2023-01-01' END AS deleted_at,
        (SELECT 2 * count(*) FROM pages) AS batch
    FROM ({SQL_NEWS})
""")
def news_load(spark, sf_dir):
    """A batch in which every entry stands twice, added to a table that holds a part of the news."""
    store = TableStore(spark, scratch_path(spark, "store"))
    titled = lambda rows, text: rows.withColumn("title", F.concat(F.lit(text), "title"))
    rows = news_rows(spark, sf_dir)
    stored = titled(rows, "stored: ").where("date < date'2023-02-01'")
    store.append(news.TABLE, stored.withColumn("deleted_at", _ended(F.col("s3_key").isNull())))
    # The second copy has the smaller title, but comes from a later feed.
    later = F.struct(F.col("place.topic_no"), F.lit(1).alias("feed_no"), F.col("place.entry_no"))
    again = titled(rows, "again: ").withColumn("place", later)
    size, _ = news.load_news(store, again.unionByName(titled(rows, "first: ")))
    return store.read(news.TABLE).select(*NEWS_COLUMNS, "deleted_at", F.lit(size).cast("bigint").alias("batch"))


@checks.add("""
    SELECT page_id, url, CASE WHEN page_id % 3 <> 0 THEN 'late/' || page_id END AS s3_key FROM pages
""")
def fetch_of_two_runs(spark, sf_dir):
    """Entries that two runs fetched, under keys of either run; the earlier run's would sort first."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.lit("0-0").alias("feed_key"), F.col("page_id").cast("int").alias("entry_no"))

    def fetched(interval, prefix, status):
        return pages.select(F.lit(interval).alias("interval"), "feed_key", "entry_no", status.alias("status"), F.concat(F.lit(prefix), "page_id").alias("s3_key"))

    late = fetched("2023-02-01", "late/", F.when(F.pmod("page_id", F.lit(3)) == 0, 404).otherwise(200))
    manifest = fetched("2023-01-01", "early/", F.lit(200)).unionByName(late)
    return with_fetch(pages, manifest, ("feed_key", "entry_no"), "2023-02-01").select("page_id", "url", "s3_key")


@checks.add(f"""
    SELECT topic, keyword, date, domain, url, title, content,
        CASE WHEN s3_key IS NULL THEN '' ELSE 'https://storage.yandexcloud.net/bucket/' || s3_key END AS s3
    FROM ({SQL_NEWS}) WHERE date >= DATE '2023-02-28' AND domain NOT LIKE 'm.%'
""")
def news_report(spark, sf_dir):
    stored = news_rows(spark, sf_dir).withColumn("deleted_at", _ended(F.col("domain").startswith("m.")))
    return news.news_report(stored, "2023-03-31 12:00:00").drop("id")


# --- vacancies ----------------------------------------------------------------------------------


def _vacancy_documents(spark, sf_dir):
    """Orders as vacancies: priced in the currency of their priority, placed where the customer is."""
    currency = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "RUR")
        .when(F.col("o_orderpriority") == "2-HIGH", "PROMO")
        .otherwise("KZT")
    )
    salary = F.struct(
        F.col("o_totalprice").alias("from"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice") * 2).alias("to"),
        currency.alias("currency"),
        (F.col("o_orderstatus") == "O").alias("gross"),
    )
    named = lambda text: F.struct(text.alias("name"))
    orders = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    return orders.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("c_custkey").alias("hh_university_id"),
        F.col("o_orderdate").cast("string").alias("created_at"),
        F.col("o_orderdate").cast("string").alias("initial_created_at"),
        F.concat(F.lit("D'"), "c_name").alias("name"),
        F.col("c_mktsegment").alias("description"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", salary).alias("salary"),
        named(F.col("o_orderpriority")).alias("experience"),
        named(F.lit("")).alias("schedule"),
        named(F.col("o_orderstatus")).alias("employment"),
        # Customers in debt are in areas the tree does not have.
        F.struct(
            F.concat(F.when(F.col("c_acctbal") < 0, "?").otherwise("n"), "c_nationkey").alias("id")
        ).alias("area"),
        F.lit("https://example.org/v").alias("alternate_url"),
        F.array(F.struct(F.lit("7").alias("id"), F.col("c_mktsegment").alias("name"))).alias("professional_roles"),
        F.array(named(F.lit("a'b")), named(F.col("o_orderstatus"))).alias("key_skills"),
        F.concat(F.lit("vacancies/"), "o_orderkey").alias("s3_key"),
    )


def _areas(spark, sf_dir):
    """Country above regions above nations; one region hangs below another country."""
    roots = spark.sql(
        f"SELECT id, CAST(NULL AS STRING) AS parent_id, name FROM VALUES ('113', '{vacancies.COUNTRY}'), ('9', 'Elsewhere') AS t(id, name)"
    )
    country = F.when(F.col("r_name") == "ASIA", "9").otherwise("113")
    regions = table(spark, sf_dir, "region").select(
        F.concat(F.lit("r"), "r_regionkey").alias("id"), country.alias("parent_id"), F.col("r_name").alias("name")
    )
    nations = table(spark, sf_dir, "nation").select(
        F.concat(F.lit("n"), "n_nationkey").alias("id"),
        F.concat(F.lit("r"), "n_regionkey").alias("parent_id"),
        F.col("n_name").alias("name"),
    )
    return roots.unionByName(regions).unionByName(nations)


def _judged(spark, sf_dir):
    return _transformed(spark, sf_dir, vacancies.judged_vacancies)


def _transformed(spark, sf_dir, transform=vacancies.transform_vacancies):
    rates = spark_rates(spark, sf_dir)
    regions = table(spark, sf_dir, "region").select(
        (F.col("r_regionkey") + 1).alias("id"), F.col("r_name").alias("title"), F.lit(None).cast("timestamp_ntz").alias("deleted_at")
    )
    placed = vacancies.area_regions(_areas(spark, sf_dir), regions)
    return transform(
        _vacancy_documents(spark, sf_dir), rates, placed, "bucket", "2023-03-05 15:00:00+03:00"
    )


def spark_rates(spark, sf_dir):
    """Rates over time, one per part; the part's type stands for the currency."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_type").alias("char_code"),
        (F.col("p_retailprice") / 16).alias("value"),
        F.date_add(F.lit("2023-01-01").cast("date"), F.col("p_size")).alias("date"),
    )


@checks.add("""
    WITH rate AS (SELECT p_retailprice / 16 AS value FROM part WHERE p_type = 'PROMO' ORDER BY p_size DESC, p_partkey DESC LIMIT 1),
    paid AS (SELECT *, o_orderpriority <> '4-NOT SPECIFIED' AS has,
        CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '2-HIGH' THEN (SELECT value FROM rate) END AS rate
        FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
            JOIN region ON r_regionkey = n_regionkey)
    SELECT c_custkey AS hh_university_id, o_orderkey AS hh_id, TIMESTAMP '2023-03-05 15:00:00' AS created_at,
        o_orderdate AS hh_created_at, 'D' || c_name AS title, c_mktsegment AS description,
        CASE WHEN has THEN CASE o_orderpriority WHEN '1-URGENT' THEN o_totalprice ELSE o_totalprice * rate END END AS salary_from,
        CASE WHEN has AND o_orderstatus = 'P' THEN
            CASE o_orderpriority WHEN '1-URGENT' THEN o_totalprice * 2 ELSE o_totalprice * 2 * rate END END AS salary_to,
        CASE WHEN has THEN 'RUR' END AS salary_currency, CASE WHEN has AND o_orderstatus = 'O' THEN true END AS salary_gross,
        o_orderpriority AS experience, CAST(NULL AS VARCHAR) AS schedule, o_orderstatus AS employment,
        CASE WHEN c_acctbal >= 0 AND r_name <> 'ASIA' THEN CAST(r_regionkey + 1 AS BIGINT) END AS federal_region_id,
        'vacancies/' || o_orderkey AS s3_key, 'ab; ' || o_orderstatus AS skills, '7 ' || c_mktsegment AS roles
    FROM paid
""")
def vacancy_rows(spark, sf_dir):
    rows, _ = _transformed(spark, sf_dir)
    role = F.col("professional_roles")[0]
    return rows.select(
        *rows.drop("hh_initial_created_at", "url", "s3_bucket", "professional_roles", "skills").columns,
        F.array_join(F.col("skills")["title"], "; ").alias("skills"),
        F.concat_ws(" ", role["hh_professional_role_dict_id"], role["title"]).alias("roles"),
    )


@checks.add("""
    SELECT 'currency' AS reject, 'KZT' AS key, count(*) AS rows FROM orders
    WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '4-NOT SPECIFIED')
    UNION ALL
    SELECT 'area', '?' || c_nationkey, count(*) FROM orders JOIN customer ON c_custkey = o_custkey
    WHERE c_acctbal < 0 GROUP BY c_nationkey
""")
def vacancy_rejects(spark, sf_dir):
    """From the rows as written once; of these only the part that lacks something is read."""
    _, rejects = vacancies.split_vacancies(_judged(spark, sf_dir), scratch_path(spark, "vacancies"))
    currency = rejects["currency"].select(F.lit("currency").alias("reject"), "key", "rows")
    return currency.unionByName(rejects["area"].select(F.lit("area").alias("reject"), "key", "rows"))


@checks.add("""
    WITH versions AS (
        SELECT o_orderkey AS id, o_custkey AS hh_id, o_orderdate, o_totalprice, n_nationkey, n_name, r_name,
            row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS place
        FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
            JOIN region ON r_regionkey = (o_orderkey % 6)
        WHERE o_orderdate >= '2001-02-28'),
    lines AS (
        SELECT l_orderkey, string_agg(l_returnflag, '; ' ORDER BY l_returnflag) AS skills,
            string_agg(p_name, '; ' ORDER BY p_name) AS professional_roles
        FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey)
    SELECT id, n_nationkey AS university_id, n_nationkey AS university_one_monitoring_id, n_name AS university_title,
        n_name AS university_abbreviation, hh_id, 'https://example.org/v' AS url, CAST(o_orderdate AS DATE) AS initial_created_at,
        n_name AS title, r_name AS description, o_totalprice AS salary_from, o_totalprice AS salary_to, true AS salary_gross,
        'a' AS experience, 'b' AS schedule, 'c' AS employment, r_name AS region, skills, professional_roles,
        CASE WHEN id % 3 = 0 THEN '' ELSE 'https://storage.yandexcloud.net/bucket/v/' || id END AS s3
    FROM versions JOIN lines ON l_orderkey = id WHERE place = 1
""")
def vacancy_report(spark, sf_dir):
    """Orders as versions of their customer's vacancy; every sixth is without a region."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("university_id"))
    nations, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    orgs = nations.select(
        F.col("n_nationkey").alias("id"),
        F.col("n_nationkey").alias("mon_id"),
        F.col("n_name").alias("title_short"),
        F.col("n_name").alias("title_display"),
    )
    regions = region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("title"))
    where = customers.join(orgs, customers["university_id"] == orgs["id"]).select(
        customers["id"].alias("c_custkey"), F.col("title_short").alias("n_name")
    )
    region_no = F.pmod("o_orderkey", F.lit(6))
    # Title and description repeat joined names, so that the report's own joins can be told right from them.
    described = table(spark, sf_dir, "orders").join(where, F.col("o_custkey") == F.col("c_custkey")).join(
        region.select(F.col("r_regionkey").cast("bigint").alias("_region"), "r_name"), region_no == F.col("_region"), "left"
    )
    versions = described.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("hh_university_id"),
        F.col("o_custkey").alias("hh_id"),
        F.col("o_orderdate").alias("created_at"),
        _ended(F.col("o_orderstatus") == "F").alias("deleted_at"),
        F.col("o_orderdate").alias("hh_initial_created_at"),
        F.col("n_name").alias("title"),
        F.col("r_name").alias("description"),
        F.col("o_totalprice").alias("salary_from"),
        F.col("o_totalprice").alias("salary_to"),
        F.lit(True).alias("salary_gross"),
        F.lit("a").alias("experience"),
        F.lit("b").alias("schedule"),
        F.lit("c").alias("employment"),
        region_no.alias("federal_region_id"),
        F.lit("https://example.org/v").alias("url"),
        F.lit("bucket").alias("s3_bucket"),
        F.when(F.pmod("o_orderkey", F.lit(3)) != 0, F.concat(F.lit("v/"), "o_orderkey")).alias("s3_key"),
    )
    lines = table(spark, sf_dir, "lineitem").withColumn("vacancy_id", F.col("l_orderkey"))
    skills = lines.select("vacancy_id", F.col("l_returnflag").alias("title"))
    roles = lines.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")).select(
        "vacancy_id", F.col("p_name").alias("title")
    )
    return vacancies.vacancy_report(versions, skills, roles, customers, orgs, regions, "2001-03-31 10:00:00")


# --- research results ---------------------------------------------------------------------------


def _hits(spark, sf_dir):
    """Orders as search hits: the customer is the searched organisation."""
    kind = (
        F.when(F.col("o_orderstatus") == "F", "nioktrs").when(F.col("o_orderstatus") == "O", "rids").otherwise("dissertations")
    )
    own = F.struct(F.col("o_custkey").cast("string").alias("ogrn"))
    other = F.struct(F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey").cast("string")).alias("ogrn"))
    degree = F.when(F.col("o_orderpriority") == "2-HIGH", "Докторская").when(F.col("o_orderpriority") != "3-MEDIUM", "Кандидатская")
    dotted = lambda tail: F.struct(
        F.concat(F.pmod("o_custkey", F.lit(7)).cast("string"), F.lit("."), F.pmod("o_orderkey", F.lit(9)).cast("string"), F.lit(tail)).alias("code")
    )
    source = F.struct(
        F.concat(F.lit(" "), "o_orderpriority", F.lit(" ")).alias("name"),
        F.struct(F.col("o_orderdate").cast("date").cast("string").alias("created_date")).alias("last_status"),
        other.alias("executor"),
        F.array(own, other).alias("executors"),
        other.alias("author_organization"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.struct(degree.alias("name"))).alias("dissertation_type"),
        F.array(dotted(".EP"), dotted(".XX"), dotted("")).alias("oecds"),
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("rosrid_university_id"),
        F.col("o_custkey").cast("string").alias("university_ogrn"),
        F.lit("key").alias("s3_key"),
        kind.alias("kind"),
        F.lit(0).alias("ordinal"),
        F.struct(F.col("o_orderkey").cast("string").alias("_id"), source.alias("_source")).alias("item"),
    )


def _types(spark, sf_dir):
    """Types from the parts: every title several times, some rows ended, one title missing."""
    title = F.element_at(
        F.array(*[F.lit(t) for t in ("НИОКТР", "РИД", "ДД")]), (F.pmod("p_partkey", F.lit(3)) + 1).cast("int")
    )
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        title.alias("title_short"),
        F.col("p_name").alias("title"),
        _ended(F.col("p_size") > 25).alias("deleted_at"),
    )


_SQL_TYPES = """
    types AS (SELECT title_short, min(id) AS id FROM (
        SELECT p_partkey AS id, CASE p_partkey % 3 WHEN 0 THEN 'НИОКТР' WHEN 1 THEN 'РИД' ELSE 'ДД' END AS title_short
        FROM part WHERE p_size <= 25) GROUP BY title_short),
    hits AS (
        SELECT *, CASE o_orderstatus WHEN 'F' THEN 'nioktr' WHEN 'O' THEN 'rid' ELSE 'dissertation' END AS kind,
            CASE o_orderstatus WHEN 'F' THEN 'НИОКТР' WHEN 'O' THEN 'РИД'
                ELSE CASE o_orderpriority WHEN '2-HIGH' THEN 'ДД' ELSE 'КД' END END AS type_title
        FROM orders)
"""


@checks.add(f"""
    WITH {_SQL_TYPES}
    SELECT o_custkey AS rosrid_university_id, CAST(o_orderkey AS VARCHAR) AS object_id, CAST(o_orderdate AS DATE) AS date,
        o_orderpriority AS title, 'https://rosrid.ru/' || kind || '/detail/' || o_orderkey AS url,
        o_orderstatus = 'O' OR o_orderpriority <> '5-LOW' AS is_executor, type_title, id AS type_id,
        (o_custkey % 7) || '.' || (o_orderkey % 9) AS oecd
    FROM hits LEFT JOIN types ON title_short = type_title
""")
def actives_rows(spark, sf_dir):
    rows, _ = actives.transform_actives(_hits(spark, sf_dir), _types(spark, sf_dir), "bucket", "2023-04-15")
    kept = rows.select(
        "rosrid_university_id", "object_id", "date", "title", "url", "is_executor", "type_title", "type_id", F.array_join("oecd", "; ").alias("oecd")
    )
    return kept


@checks.add(f"""
    WITH {_SQL_TYPES}
    SELECT type_title AS key, count(*) AS rows FROM hits
    WHERE type_title NOT IN (SELECT title_short FROM types) GROUP BY type_title
""")
def actives_rejects(spark, sf_dir):
    return actives.transform_actives(_hits(spark, sf_dir), _types(spark, sf_dir), "bucket", "2023-04-15")[1]


def _codes(spark, sf_dir):
    code = F.concat(F.floor(F.col("p_partkey") / 10).cast("string"), F.lit("."), F.pmod("p_partkey", F.lit(10)).cast("string"))
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.when(F.col("p_size") > 40, F.concat(F.lit("x"), code)).otherwise(code).alias("code")
    )


@checks.add("""
    SELECT CAST(o_orderkey AS VARCHAR) AS object_id, p_partkey AS oecd_id
    FROM orders JOIN part ON p_partkey = (o_custkey % 7) * 10 + o_orderkey % 9 AND p_size <= 40
""")
def actives_bridge(spark, sf_dir):
    """Bridge rows over a dictionary with a code for each part; those of large parts are written differently."""
    rows, _ = actives.transform_actives(_hits(spark, sf_dir), _types(spark, sf_dir), "bucket", "2023-04-15")
    codes = _codes(spark, sf_dir)
    parents, bridge, _ = actives.split_actives(rows, codes)
    return bridge.join(parents, bridge["active_id"] == parents["id"]).select("object_id", "oecd_id")


_SQL_ACTIVES_REPORT = """
    SELECT o_orderkey AS id, n_nationkey AS university_id, n_nationkey AS university_one_monitoring_id,
        n_name AS university_title, n_name AS university_abbreviation, CAST(o_orderkey AS VARCHAR) AS object_id,
        r_name AS type, CAST(o_orderdate AS DATE) AS date, o_orderpriority AS title, oecd, 'u' AS url, true AS is_executor,
        'https://storage.yandexcloud.net/bucket/' AS s3
    FROM orders JOIN region ON r_regionkey = o_orderkey % 5 JOIN customer ON c_custkey = o_custkey
        JOIN nation ON n_nationkey = c_nationkey
        JOIN (SELECT l_orderkey, string_agg(concat(code, ' - ', p_name), '; ' ORDER BY concat(code, ' - ', p_name)) AS oecd
            FROM lineitem JOIN (SELECT *, CASE WHEN p_size > 5 THEN p_brand END AS code FROM part) ON p_partkey = l_partkey
            GROUP BY l_orderkey) ON l_orderkey = o_orderkey
    WHERE o_orderstatus <> 'F' AND CAST(o_orderdate AS DATE) >= {lower}
"""


def _actives_report(spark, sf_dir, from_month_start):
    results = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").alias("created_at"),
        _ended(F.col("o_orderstatus") == "F").alias("deleted_at"),
        F.col("o_custkey").alias("rosrid_university_id"),
        F.pmod("o_orderkey", F.lit(5)).alias("type_id"),
        F.col("o_orderkey").cast("string").alias("object_id"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_orderpriority").alias("title"),
        F.lit("u").alias("url"),
        F.lit(True).alias("is_executor"),
        F.lit("bucket").alias("s3_bucket"),
        F.lit(None).cast("string").alias("s3_key"),
    )
    types = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("bigint").alias("id"), F.col("r_name").alias("title"))
    registrations = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("university_id")
    )
    orgs = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("id"),
        F.col("n_nationkey").alias("mon_id"),
        F.col("n_name").alias("title_short"),
        F.col("n_name").alias("title_display"),
    )
    bridge = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("active_id"), F.col("l_partkey").alias("oecd_id"))
    codes = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.when(F.col("p_size") > 5, F.col("p_brand")).alias("code"), F.col("p_name").alias("title")
    )
    return actives.actives_report(results, types, registrations, orgs, bridge, codes, from_month_start)


@checks.add(_SQL_ACTIVES_REPORT.format(lower="(SELECT max(CAST(o_orderdate AS DATE)) FROM orders)"))
def actives_report(spark, sf_dir):
    return _actives_report(spark, sf_dir, from_month_start=False)


@checks.add(_SQL_ACTIVES_REPORT.format(lower="date_trunc('month', (SELECT max(o_orderdate) FROM orders))"))
def actives_month_report(spark, sf_dir):
    return _actives_report(spark, sf_dir, from_month_start=True)
