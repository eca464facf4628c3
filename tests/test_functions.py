import datetime as dt

import pytest
from pyspark.sql import functions as F

from gleanery import functions as fn

REDIRECT = "https://www.google.com/url?rct=j&sa=t&url=https://www.example.ru:8080/a%3Fb&ct=ga&cd=1"


@pytest.mark.parametrize(
    "href, url, domain, digest",
    [
        (REDIRECT, "https://www.example.ru:8080/a%3Fb", "example.ru:8080", "b99a05ea1058e23714076c7f1e8bb951"),
        (" http://news.example.org/x ", "http://news.example.org/x", "news.example.org", "c8797022432526a8f47885263f1c4324"),
        ("ftp://example.org/x", "ftp://example.org/x", None, None),
        ("https://www.google.com/search?q=1", "https://www.google.com/search?q=1", "google.com", None),
        ("https://www.google.com/?x&ct=ga&url=", "https://www.google.com/?x&ct=ga&url=", "google.com", None),
        ("http://www./x", "http://www./x", None, None),
        ("http://user@m.example.org", "http://user@m.example.org", "user@m.example.org", None),
    ],
)
def test_news_url(one, href, url, domain, digest):
    assert one(lambda c: fn.unwrap_redirect(fn.strip_ws(c)), href) == url
    assert one(fn.url_domain, url) == domain
    if digest:
        assert one(lambda c: fn.md5_key(F.lit("наука"), F.lit("вуз"), c), url) == digest


def test_strip_removes_what_python_strip_removes(one):
    blanks = "".join(chr(i) for i in range(0x10000) if chr(i).isspace())
    assert one(fn.strip_ws, f"{blanks}a{blanks}b{blanks}") == f"{blanks}a{blanks}b{blanks}".strip()
    assert one(fn.strip_ws, "​a") == "​a"
    assert one(fn.strip_ws, blanks) == ""


@pytest.mark.parametrize(
    "published, day",
    [
        ("2022-12-23T23:30:00+03:00", dt.date(2022, 12, 23)),
        ("2022-12-24T00:30:00+03:00", dt.date(2022, 12, 24)),
        ("soon", None),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/Los_Angeles"])
def test_dates_keep_their_own_offset(spark, one, published, day, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert one(fn.local_date, published) == day
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_naive_timestamp_drops_the_offset(one):
    assert one(fn.naive_timestamp, "2022-12-23 14:00:00+03:00") == dt.datetime(2022, 12, 23, 14)
    assert one(fn.naive_timestamp, "") is None


def test_unit_rate(one):
    rate = one(lambda v, n: fn.unit_rate(v, n.cast("int")), "50,4500", "100")
    assert rate == 0.5045000000000001
    assert one(lambda v, n: fn.unit_rate(v, n.cast("int")), "n/a", "100") is None


@pytest.mark.parametrize(
    "amount, currency, rate, rubles",
    [(100.0, "USD", 75.5, 7550.0), (None, "USD", 75.5, None), (50.0, "RUR", None, 50.0), (1.0, "XXX", None, None)],
)
def test_to_rubles(one, amount, currency, rate, rubles):
    assert one(fn.to_rubles, amount, currency, rate, schema="a double, b string, c double") == rubles


def test_falsy_to_null(spark):
    rows = spark.createDataFrame(
        [("", 0, 0.0, False), ("x", 1, 2.5, True), (None, None, None, None)], "t string, i int, d double, b boolean"
    )
    cleaned = fn.falsy_to_null(rows, ["t", "i", "d", "b"])
    assert [tuple(r) for r in cleaned.collect()] == [(None,) * 4, ("x", 1, 2.5, True), (None,) * 4]


def test_code_prefixes_links_quotes(one):
    codes = one(fn.code_prefixes, ["1.02.EP", "1.02.XX", "3.1", "4"], schema="a array<string>")
    assert codes == ["1.02", "3.1", "4"]
    assert one(fn.drop_quotes, "D'Ar't") == "DArt"
    assert one(fn.storage_link, "b", None) == ""
    assert one(fn.storage_link, None, "k") == "https://storage.yandexcloud.net//k"
    assert one(lambda c, t: fn.concat_skip_null(c, F.lit(" - "), t), None, "T") == " - T"


@pytest.mark.parametrize(
    "kind, degree, title, path",
    [
        ("nioktrs", None, "НИОКТР", "nioktr"),
        ("rids", None, "РИД", "rid"),
        ("dissertations", "Докторская", "ДД", "dissertation"),
        ("dissertations", "Кандидатская", "КД", "dissertation"),
        ("dissertations", None, "КД", "dissertation"),
        ("ikrbses", None, "НИОКТР", "ikrbse"),
    ],
)
def test_types(one, kind, degree, title, path):
    assert one(fn.active_type, kind, degree) == title
    assert one(lambda k: fn.detail_url(k, F.lit("A1")), kind) == f"https://rosrid.ru/{path}/detail/A1"


SOURCE = """kind string, source struct<executor: struct<ogrn: string>, executors: array<struct<ogrn: string>>,
    author_organization: struct<ogrn: string>>"""


@pytest.mark.parametrize(
    "kind, source, own",
    [
        ("nioktrs", (("111",), None, None), True),
        ("nioktrs", ((None,), [("111",)], ("111",)), False),
        ("nioktrs", (None, None, None), False),
        ("rids", (None, [("222",), ("111",)], None), True),
        ("rids", (None, [(None,)], None), False),
        ("rids", (None, [(None,), ("111",)], None), True),
        ("rids", (None, None, None), False),
        ("dissertations", (("111",), None, ("222",)), False),
        ("dissertations", (None, None, ("111",)), True),
        ("ikrbses", (("111",), [("111",)], ("111",)), False),
    ],
)
def test_is_executor(one, kind, source, own):
    assert one(lambda k, s: fn.is_executor(k, s, F.lit("111")), kind, source, schema=SOURCE) is own


def test_periods(spark, one):
    start, end = fn.lag_window(F.lit("2023-04-15"))
    row = spark.range(1).select(start.alias("s"), end.alias("e")).first()
    assert (row.s, row.e) == (dt.date(2023, 1, 1), dt.date(2023, 1, 31))
    days = spark.createDataFrame([(dt.date(2023, 2, 27),), (dt.date(2023, 2, 28),)], "day date")
    assert [r.day for r in fn.trailing_month(days, "day", "2023-03-31 09:00:00").collect()] == [dt.date(2023, 2, 28)]


def test_latest_period(spark):
    day = lambda n, m=1: dt.date(2023, m, n)
    table = spark.createDataFrame([(1, day(20), True), (2, day(31), True)], "id int, date date, live boolean")
    live = lambda t: t.where("live")
    ids = lambda df: sorted(r.id for r in df.collect())
    assert ids(fn.latest_period(live(table), "date", of=table)) == [2]
    assert ids(fn.latest_period(live(table), "date", of=table, from_month_start=True)) == [1, 2]
    deleted = table.union(spark.createDataFrame([(3, day(1, 2), False)], table.schema))
    assert ids(fn.latest_period(live(deleted), "date", of=deleted)) == []


def brute_lcs(a: str, b: str) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        before, row = row, [0]
        for j, y in enumerate(b):
            row.append(before[j] + 1 if x == y else max(before[j + 1], row[j]))
    return row[-1]


def brute_ratio(a, b) -> int:
    if not a or not b:
        return 0
    return 100 if a == b else round(100 * (2.0 * brute_lcs(a, b) / (len(a) + len(b))))


PAIRS = [
    ("Москва", "Московская область", 50),
    ("kitten", "sitting", 62),
    ("Республика Татарстан", "Татарстан", 62),
    ("Республика Татарстан", "Республика Башкортостан", 79),
    ("Республика Татарстан", "Республика Татарстан (Татарстан)", 77),
    ("a", "a", 100),
    ("", "a", 0),
    ("", "", 0),
    (None, "a", 0),
    ("a😀b", "😀", 50),
]


@pytest.mark.parametrize("a, b, score", PAIRS)
def test_fuzz_ratio(one, a, b, score):
    assert one(fn.fuzz_ratio, a, b) == score
    assert one(fn.fuzz_ratio, b, a) == score
    assert brute_ratio(a, b) == score


def test_fuzz_ratio_against_brute_force(spark):
    """Short, long (row form) and border lengths of the bit form, over a small alphabet."""
    import random

    draw = random.Random(7)
    lengths = [0, 1, 2, 5, 13, 40, 61, 62, 63, 64, 90]
    pairs = [
        ("".join(draw.choices("abвг ", k=draw.choice(lengths))), "".join(draw.choices("abвг ", k=draw.choice(lengths))))
        for _ in range(300)
    ]
    rows = spark.createDataFrame(pairs, "a string, b string").select(
        "a", "b", fn.fuzz_ratio(F.col("a"), F.col("b")).alias("score"), fn.fuzz_ratio(F.col("b"), F.col("a")).alias("back")
    )
    for r in rows.collect():
        assert r.score == r.back == brute_ratio(r.a, r.b), (r.a, r.b)
