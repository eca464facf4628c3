"""Scalar cleaning. Variants of a value are spread over all rows; no row is left out."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import (
    active_type,
    code_prefixes,
    detail_url,
    drop_quotes,
    falsy_to_null,
    is_executor,
    lag_window,
    local_date,
    md5_key,
    naive_timestamp,
    storage_link,
    strip_ws,
    to_rubles,
    trailing_month,
    unit_rate,
    unwrap_redirect,
    url_domain,
)
from ..functions.rules import RESULT_TYPES
from ..functions.text import WHITESPACE
from ..operators import lookup, normalise_names, salary_fields
from ..plans.rates import latest_rates
from .base import Registry, table

checks = Registry()
QUERIES, ORACLES = checks.queries, checks.oracles


def variant(col: str, n: int):
    return F.pmod(F.col(col), F.lit(n))


@checks.add("""
    WITH links AS (
        SELECT page_id, CASE page_id % 3
            WHEN 0 THEN 'https://www.google.com/url?rct=j&sa=t&url=' || url || '&ct=ga&cd=1'
            WHEN 1 THEN 'https://www.google.com/search?q=' || url
            ELSE url END AS link
        FROM pages)
    SELECT page_id, CASE
        WHEN link LIKE 'https://www.google.com/%' AND instr(link, '&url=') > 0 AND instr(link, '&ct=ga') > 0
        THEN substr(link, instr(link, '&url=') + 5, instr(link, '&ct=ga') - instr(link, '&url=') - 5)
        ELSE link END AS url
    FROM links
""")
def redirect_unwrap(spark, sf_dir):
    link = (
        F.when(
            variant("page_id", 3) == 0,
            F.concat(F.lit("https://www.google.com/url?rct=j&sa=t&url="), "url", F.lit("&ct=ga&cd=1")),
        )
        .when(variant("page_id", 3) == 1, F.concat(F.lit("https://www.google.com/search?q="), "url"))
        .otherwise(F.col("url"))
    )
    return table(spark, sf_dir, "pages").select("page_id", unwrap_redirect(link).alias("url"))


@checks.add("""
    WITH links AS (
        SELECT page_id, CASE page_id % 4
            WHEN 0 THEN replace(url, '://', '://www.')
            WHEN 1 THEN 'ftp' || url
            WHEN 2 THEN replace(url, '/en/', ':8080/en/')
            ELSE url END AS link
        FROM pages), hosts AS (
        SELECT page_id, CASE WHEN link LIKE 'http://_%' OR link LIKE 'https://_%'
            THEN split_part(split_part(link, '://', 2), '/', 1) END AS host
        FROM links)
    SELECT page_id, CASE WHEN host LIKE 'www.%' THEN substr(host, 5) ELSE host END AS domain FROM hosts
""")
def url_domains(spark, sf_dir):
    link = (
        F.when(variant("page_id", 4) == 0, F.replace("url", F.lit("://"), F.lit("://www.")))
        .when(variant("page_id", 4) == 1, F.concat(F.lit("ftp"), "url"))
        .when(variant("page_id", 4) == 2, F.replace("url", F.lit("/en/"), F.lit(":8080/en/")))
        .otherwise(F.col("url"))
    )
    return table(spark, sf_dir, "pages").select("page_id", url_domain(link).alias("domain"))


@checks.add("SELECT doc_id, md5(source || lang || text) AS hash FROM documents")
def content_hash(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", md5_key(F.col("source"), F.col("lang"), F.col("text")).alias("hash"))


_SQL_BLANKS = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)


@checks.add(f"SELECT doc_id, trim(text, {_SQL_BLANKS}) AS title FROM documents")
def trim_title(spark, sf_dir):
    padding = F.lit(WHITESPACE)
    padded = F.concat(padding, F.col("text"), padding)
    return table(spark, sf_dir, "documents").select("doc_id", strip_ws(padded).alias("title"))


_OFFSETS = ("+03:00", "-11:30", "Z", "+14:00")
_SQL_ISO = """strftime(ts, '%Y-%m-%dT%H:%M:%S') ||
    (CASE user_id % 4 WHEN 0 THEN '+03:00' WHEN 1 THEN '-11:30' WHEN 2 THEN 'Z' ELSE '+14:00' END)"""


def _iso(spark, sf_dir):
    """Events with an ISO text in one of several offsets."""
    clock = F.replace(F.substring(F.col("ts").cast("string"), 1, 19), F.lit(" "), F.lit("T"))
    offset = F.element_at(F.array(*[F.lit(o) for o in _OFFSETS]), (variant("user_id", 4) + 1).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", F.concat(clock, offset).alias("published"))


@checks.add(f"SELECT event_id, CAST(substr({_SQL_ISO}, 1, 10) AS DATE) AS date FROM events")
def own_offset_date(spark, sf_dir):
    return _iso(spark, sf_dir).select("event_id", local_date(F.col("published")).alias("date"))


@checks.add(
    f"SELECT event_id, CAST(replace(substr({_SQL_ISO}, 1, 19), 'T', ' ') AS TIMESTAMP) AS created_at FROM events"
)
def drop_offset_ts(spark, sf_dir):
    return _iso(spark, sf_dir).select("event_id", naive_timestamp(F.col("published")).alias("created_at"))


@checks.add("""
    SELECT c_custkey AS currency_id, c_name AS title, c_nationkey AS num_code, c_mktsegment AS char_code,
        c_acctbal, 1 AS nominal, '2023-03-02' AS date
    FROM customer
""")
def rename_normalise(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    shouted = customers.toDF(*[c.upper() for c in customers.columns])
    renames = {
        "c_custkey": "currency_id",
        "c_name": "title",
        "c_nationkey": "num_code",
        "c_mktsegment": "char_code",
    }
    return normalise_names(shouted, renames, nominal=1, date="2023-03-02")


@checks.add("""
    SELECT p_partkey, 1 AS nominal,
        CAST(replace(replace(CAST(CAST(p_retailprice AS DECIMAL(18, 2)) AS VARCHAR), '.', ','), ',', '.') AS DOUBLE)
            / CAST(p_size AS DOUBLE) AS value
    FROM part
""")
def currency_normalise(spark, sf_dir):
    price = F.replace(F.col("p_retailprice").cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(","))
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.lit(1).alias("nominal"), unit_rate(price, F.col("p_size")).alias("value")
    )


@checks.add("""
    WITH rates AS (
        SELECT DISTINCT ON (p_type) p_type AS char_code, p_retailprice AS value
        FROM part ORDER BY p_type, DATE '2023-01-01' + p_size DESC, p_partkey DESC),
    offers AS (
        SELECT o_orderkey, o_orderpriority <> '4-NOT SPECIFIED' AS paid, o_totalprice,
            o_orderstatus = 'F' AS gross,
            CASE o_orderpriority WHEN '1-URGENT' THEN 'RUR' WHEN '2-HIGH' THEN 'PROMO'
                WHEN '3-MEDIUM' THEN 'SMALL' ELSE 'XXX' END AS currency
        FROM orders)
    SELECT o_orderkey,
        CASE WHEN NOT paid THEN NULL WHEN currency = 'RUR' THEN o_totalprice ELSE o_totalprice * value END AS salary_from,
        CAST(NULL AS DOUBLE) AS salary_to,
        CASE WHEN paid THEN 'RUR' END AS salary_currency,
        CASE WHEN paid THEN gross END AS salary_gross
    FROM offers LEFT JOIN rates ON currency = char_code
""")
def salary_convert(spark, sf_dir):
    rates = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_type").alias("char_code"),
        F.col("p_retailprice").alias("value"),
        F.date_add(F.lit("2023-01-01").cast("date"), F.col("p_size")).alias("date"),
    )
    currency = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "RUR")
        .when(F.col("o_orderpriority") == "2-HIGH", "PROMO")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "SMALL")
        .otherwise("XXX")
    )
    salary = F.struct(
        F.col("o_totalprice").alias("from"),
        F.lit(None).cast("double").alias("to"),
        currency.alias("currency"),
        (F.col("o_orderstatus") == "F").alias("gross"),
    )
    offers = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", salary).alias("salary")
    )
    coded = offers.withColumns({**salary_fields(F.col("salary")), "currency": F.col("salary.currency")})
    priced, _ = lookup(coded, latest_rates(rates), "currency", "char_code", {"value": "rate"})
    return priced.select(
        "o_orderkey",
        *[
            to_rubles(F.col(c), F.col("currency"), F.col("rate")).alias(c)
            for c in ("salary_from", "salary_to")
        ],
        "salary_currency",
        "salary_gross",
    )


@checks.add("""
    SELECT l_orderkey, l_linenumber, l_partkey, nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax,
        CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS flag,
        CASE WHEN l_linestatus = 'O' THEN true END AS is_open
    FROM lineitem
""")
def falsy_values(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_discount",
        "l_tax",
        F.when(F.col("l_returnflag") == "N", "").otherwise(F.col("l_returnflag")).alias("flag"),
        (F.col("l_linestatus") == "O").alias("is_open"),
    )
    return falsy_to_null(lines, ["l_discount", "l_tax", "flag", "is_open"])


@checks.add("SELECT doc_id, replace(replace(text, 'e', chr(39)), chr(39), '') AS description FROM documents")
def strip_apostrophes(spark, sf_dir):
    quoted = F.replace("text", F.lit("e"), F.lit("'"))
    return table(spark, sf_dir, "documents").select("doc_id", drop_quotes(quoted).alias("description"))


@checks.add("""
    SELECT o_orderkey, kind, CASE kind
            WHEN 'nioktrs' THEN o_custkey % 3 <> 0 AND o_custkey % 7 = 1
            WHEN 'rids' THEN o_custkey % 3 <> 0 AND o_custkey % 7 = 1 OR o_orderkey % 7 = 1
            WHEN 'dissertations' THEN o_orderkey % 5 <> 0 AND o_orderkey % 7 = 1
            ELSE false END AS is_executor
    FROM (SELECT *, unnest(['nioktrs', 'rids', 'dissertations', 'ikrbses']) AS kind FROM orders)
""")
def ownership_rule(spark, sf_dir):
    def ogrn(col: str, gap: int):
        code = variant(col, 7).cast("string")
        return F.named_struct(F.lit("ogrn"), F.when(variant(col, gap) != 0, code) if gap else code)

    source = F.named_struct(
        F.lit("executor"),
        ogrn("o_custkey", 3),
        F.lit("executors"),
        F.array(ogrn("o_custkey", 3), ogrn("o_orderkey", 0)),
        F.lit("author_organization"),
        ogrn("o_orderkey", 5),
    )
    kinds = F.explode(F.array(*[F.lit(k) for k in (*RESULT_TYPES, "ikrbses")]))
    hits = table(spark, sf_dir, "orders").select("o_orderkey", source.alias("source"), kinds.alias("kind"))
    return hits.select(
        "o_orderkey", "kind", is_executor(F.col("kind"), F.col("source"), F.lit("1")).alias("is_executor")
    )


@checks.add("""
    WITH kinds AS (
        SELECT p_partkey,
            CASE WHEN p_type IN ('SMALL', 'PROMO') THEN 'rids'
                WHEN p_type IN ('LARGE', 'MEDIUM') THEN 'dissertations' ELSE 'nioktrs' END AS kind,
            CASE WHEN p_size % 3 = 0 THEN 'Докторская' WHEN p_size % 3 = 1 THEN 'Кандидатская' END AS degree
        FROM part)
    SELECT p_partkey,
        CASE kind WHEN 'rids' THEN 'РИД' WHEN 'dissertations' THEN CASE WHEN degree = 'Докторская' THEN 'ДД' ELSE 'КД' END
            ELSE 'НИОКТР' END AS type_title,
        'https://rosrid.ru/' || CASE kind WHEN 'rids' THEN 'rid' WHEN 'dissertations' THEN 'dissertation' ELSE 'nioktr' END
            || '/detail/' || p_partkey AS url
    FROM kinds
""")
def type_classify(spark, sf_dir):
    kind = (
        F.when(F.col("p_type").isin("SMALL", "PROMO"), "rids")
        .when(F.col("p_type").isin("LARGE", "MEDIUM"), "dissertations")
        .otherwise("nioktrs")
    )
    degree = F.when(variant("p_size", 3) == 0, "Докторская").when(variant("p_size", 3) == 1, "Кандидатская")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        active_type(kind, degree).alias("type_title"),
        detail_url(kind, F.col("p_partkey").cast("string")).alias("url"),
    )


@checks.add("""
    SELECT doc_id, CASE WHEN length(text) = 0 THEN '' ELSE array_to_string(list_sort(list_distinct(list_transform(
        string_split(text, ' '), lambda x: array_to_string(string_split(x, '.')[1:2], '.')))), ' ') END AS codes
    FROM documents
""")
def code_prefix_set(spark, sf_dir):
    words = F.split("text", " ")
    codes = F.array_join(F.sort_array(code_prefixes(words)), " ")
    return table(spark, sf_dir, "documents").select("doc_id", codes.alias("codes"))


@checks.add("""
    SELECT page_id, CASE WHEN page_id % 3 = 0 THEN '' ELSE
        'https://storage.yandexcloud.net/' || (CASE WHEN page_id % 5 = 0 THEN '' ELSE 'bucket' END) || '/' || url END AS s3
    FROM pages
""")
def storage_links(spark, sf_dir):
    key = F.when(variant("page_id", 3) != 0, F.col("url"))
    bucket = F.when(variant("page_id", 5) != 0, "bucket")
    return table(spark, sf_dir, "pages").select("page_id", storage_link(bucket, key).alias("s3"))


@checks.add("""
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE o_orderdate >= CAST(TIMESTAMP '2001-03-31 10:30:00' - INTERVAL 1 MONTH AS DATE)
""")
def trailing_month_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return trailing_month(orders, "o_orderdate", "2001-03-31 10:30:00")


@checks.add("""
    SELECT o_orderkey, CAST(date_trunc('month', o_orderdate - INTERVAL 3 MONTH) AS DATE) AS start_date,
        CAST(date_trunc('month', o_orderdate - INTERVAL 3 MONTH) + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE) AS end_date
    FROM orders
""")
def lag_windows(spark, sf_dir):
    start, end = lag_window(F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").select("o_orderkey", start.alias("start_date"), end.alias("end_date"))
