"""The four flows from landed documents to stored tables and reports."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gleanery import schemas
from gleanery.operators import export_csv, refresh_if_loaded
from gleanery.plans import actives, backfill, news, rates, vacancies
from gleanery.sources import TableStore, expand_feeds, flatten_area_tree, read_atom, read_documents, read_rates
from gleanery.sources.feeds import numbered
from gleanery.streaming import atom_stream, ingest

from .test_sources import SHEET, TREE, land

REDIRECT = "https://www.google.com/url?sa=t&amp;url=https://www.example.ru/a&amp;ct=ga&amp;cd=1"


def entry(href, published="2022-12-23T23:30:00+03:00", title="t", content="c"):
    return (
        f'<entry><title type="html">{title}</title><link href="{href}"/><published>{published}</published>'
        f'<content type="html">{content}</content></entry>'
    )


def topical(entries):
    """Entries of one feed."""
    return entries.selectExpr("*", "'t' AS topic", "'k' AS keyword", "0 AS topic_no", "0 AS feed_no", "'0-0' AS feed_key")


def feed(*entries):
    return f'<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom">{"".join(entries)}</feed>'


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "store"))


def fill(store, name, *rows):
    store.append(name, store.spark.createDataFrame(list(rows), schemas.TABLES[name]))


def test_news(spark, store, tmp_path):
    path = land(tmp_path / "landed", "feed-0-0.xml", feed(entry(REDIRECT, title=" it's "), entry(REDIRECT, title="later", published="2022-12-24T00:30:00+03:00"), entry("http://gone.org/x", content="")))
    land(tmp_path / "landed", "feed-1-0.xml", feed(entry("ftp://e.org/f")))
    config = spark.createDataFrame([(0, "наука", [("f0", "вуз")]), (1, "b", [("f1", "k")])], "topic_no int, " + schemas.FEED_CONFIG)
    entries = read_atom(spark, path)
    end = "2022-12-23 14:00:00+03:00"
    fetches = [(end, "0-0", 0, 200, "k1"), ("2022-12-22 14:00:00+03:00", "0-0", 0, 200, "earlier"), (end, "0-0", 2, 404, "k2"), (end, "1-0", 0, 404, "k3")]
    manifest = spark.createDataFrame(fetches, "interval string, feed_key string, entry_no int, status int, s3_key string")
    rows = news.transform_news(news.entries_of_feeds(entries, expand_feeds(config)), manifest, end, "b")
    assert news.load_news(store, rows) == (4, 3)
    assert news.load_news(store, rows) == (4, 0)
    stored = {r.url: r for r in store.read(news.TABLE).collect()}
    first = stored["https://www.example.ru/a"]
    assert (first.title, first.domain, first.s3_key, first.date) == ("it's", "example.ru", "k1", dt.date(2022, 12, 23))
    assert (first.topic, first.keyword, first.created_at) == ("наука", "вуз", dt.datetime(2022, 12, 23, 14))
    assert (stored["http://gone.org/x"].content, stored["http://gone.org/x"].s3_key) == (None, None)
    assert (stored["ftp://e.org/f"].domain, stored["ftp://e.org/f"].topic) == (None, "b")
    report = {r.url: r.s3 for r in news.news_report(store.read(news.TABLE), "2023-01-20 10:00:00").collect()}
    assert report == {"https://www.example.ru/a": "https://storage.yandexcloud.net/b/k1", "http://gone.org/x": "", "ftp://e.org/f": ""}
    assert news.news_report(store.read(news.TABLE), "2023-01-25").isEmpty()


def test_deleted_news_block_their_hash(spark, store, tmp_path):
    path = land(tmp_path / "landed", "f.xml", feed(entry("http://e.org/x")))
    rows = news.transform_news(topical(read_atom(spark, path)), spark.createDataFrame([], schemas.FETCH_MANIFEST), "2022-12-23 14:00:00", "b")
    store.append(news.TABLE, rows.withColumn("deleted_at", F.lit("2023-01-01").cast("timestamp_ntz")))
    assert news.load_news(store, rows) == (1, 0)
    assert news.news_report(store.read(news.TABLE), "2022-12-24").isEmpty()


def test_rates(spark, store, tmp_path):
    sheet = read_rates(spark, land(tmp_path / "rates", "extracted.xml", SHEET))
    day = rates.transform_rates(sheet, "2023-03-02 12:00:00")
    assert rates.load_rates(store, day.withColumn("value", F.lit(99.0)), "2023-03-02 12:10:00") == 2
    assert rates.load_rates(store, rates.transform_rates(sheet, "2023-03-01 12:00:00").withColumn("value", F.lit(1.0)), "2023-03-03 12:00:00") == 2
    assert rates.load_rates(store, day, "2023-03-02 12:20:00") == 2
    assert store.read(rates.TABLE).select("id").distinct().count() == 6
    newest = {r.char_code: r.value for r in rates.latest_rates(store.read(rates.TABLE)).collect()}
    assert newest == {"USD": 75.5, "AUD": 0.5045000000000001}


def vacancy(number, area="2079", salary=None, skills=("a'b",), name="D'Art", org=1):
    return {
        "id": str(number), "hh_university_id": org, "created_at": "2023-03-10T10:00:00+0300", "initial_created_at": "2023-03-09T10:00:00+0300",
        "name": name, "description": "it's", "salary": salary, "experience": {"name": "e"}, "schedule": {"name": ""}, "employment": None,
        "area": {"id": area}, "alternate_url": "u", "professional_roles": [{"id": "7", "name": "c'd"}], "key_skills": [{"name": s} for s in skills],
    }


def pay(low, high, currency, gross):
    return {"from": low, "to": high, "currency": currency, "gross": gross}


@pytest.fixture
def dictionaries(spark, store):
    fill(store, rates.TABLE, ("1", None, dt.date(2023, 3, 1), "", 1, 70.0, "USD", 840, "R", None), ("2", None, dt.date(2023, 3, 2), "", 1, 75.5, "USD", 840, "R", None))
    fill(store, "geo_federal_region", (10, "Московская область", None), (11, "Москва", None), (12, "Московская обл", dt.datetime(2023, 1, 1)))
    fill(store, "hh_hh_university", (1, 5, 100, None))
    fill(store, "university_university", (100, "111", 9, "short", "display", None))
    return store


def transform(spark, store, tmp_path, folder, *documents):
    for v in documents:
        path = land(tmp_path / folder, f"{v['id']}.json", v)
    tree = land(tmp_path / "tree", "areas.json", {"areas": [TREE, {"id": "1001", "parent_id": None, "name": "Другие", "areas": []}]})
    areas = flatten_area_tree(read_documents(spark, tree, f"areas {schemas.area_tree(5)}"))
    regions = vacancies.area_regions(areas, store.read("geo_federal_region"))
    documents = read_documents(spark, path, schemas.VACANCY)
    return vacancies.transform_vacancies(documents, store.read(rates.TABLE), regions, "b", "2023-03-12 15:00:00")


def report(store, now="2023-03-31 10:00:00"):
    read = store.read
    return vacancies.vacancy_report(
        read(vacancies.TABLE), read(vacancies.SKILLS), read(vacancies.ROLES),
        read("hh_hh_university"), read("university_university"), read("geo_federal_region"), now,
    )


def test_vacancies(spark, dictionaries, tmp_path):
    store = dictionaries
    rows, rejects = transform(
        spark, store, tmp_path, "first",
        vacancy(1, salary=pay(100, None, "USD", False), skills=("z", "a'b")),
        vacancy(2, salary=pay(0, 50, "RUR", True), area="1"),
        vacancy(3, salary=pay(1, None, "KZT", True), area="1001", skills=()),
        vacancy(4, area="113"),
        vacancy(5, salary=pay(None, None, "KZT", True), area="404"),
    )
    assert vacancies.load_vacancies(store, rows, "2023-03-12 15:00:00") == 5
    by_id = {r.hh_id: r for r in store.read(vacancies.TABLE).collect()}
    money = {i: (r.salary_from, r.salary_to, r.salary_currency, r.salary_gross) for i, r in by_id.items()}
    assert money == {1: (7550.0, None, "RUR", None), 2: (None, 50.0, "RUR", True), 3: (None, None, "RUR", True), 4: (None,) * 4, 5: (None, None, "RUR", True)}
    assert {i: r.federal_region_id for i, r in by_id.items()} == {1: 10, 2: 11, 3: None, 4: None, 5: None}
    assert (by_id[1].title, by_id[1].description, by_id[1].schedule, by_id[1].employment) == ("DArt", "its", None, None)
    assert by_id[1].hh_created_at == dt.datetime(2023, 3, 10, 10)
    assert [(r.key, r.rows) for r in rejects["currency"].collect()] == [("KZT", 1)]
    assert [(r.key, r.rows) for r in rejects["area"].collect()] == [("404", 1)]
    skills = {(r.vacancy_id, r.title) for r in store.read(vacancies.SKILLS).collect()}
    assert skills == {(by_id[1].id, "z"), (by_id[1].id, "ab"), *((by_id[i].id, "ab") for i in (2, 4, 5))}
    assert {r.title for r in store.read(vacancies.ROLES).collect()} == {"c'd"}

    first = {r.hh_id: r for r in report(store).collect()}
    assert set(first) == {1, 2}
    assert (first[1].skills, first[1].professional_roles, first[1].region, first[1].university_title) == ("ab; z", "c'd", "Московская область", "short")
    assert first[1].s3.startswith("https://storage.yandexcloud.net/b/") and "created_at" not in report(store).columns
    assert report(store, "2023-04-30").isEmpty()

    # The next snapshot ends all five; vacancy 1 moved where no region is, so its older version is reported.
    again, _ = transform(spark, store, tmp_path, "second", vacancy(1, area="113"), vacancy(2, area="1", name="new"))
    for _ in range(2):  # the second time as a retry
        assert vacancies.load_vacancies(store, again, "2023-03-19 15:00:00") == 2
        stored = store.read(vacancies.TABLE)
        assert stored.count() == 7 and store.read_live(vacancies.TABLE).count() == 2
        ended = stored.where("deleted_at IS NOT NULL").select("deleted_at", "updated_at").distinct().collect()
        assert [tuple(r) for r in ended] == [(dt.datetime(2023, 3, 19, 15),) * 2]
        assert store.read(vacancies.SKILLS).count() == 7
    assert {r.hh_id: r.title for r in report(store).collect()} == {1: "DArt", 2: "new"}


def test_strict_vacancies_fail(spark, dictionaries, tmp_path):
    rows, _ = transform(spark, dictionaries, tmp_path, "x", vacancy(3, salary=pay(1, None, "KZT", True)))
    assert rows.first().salary_from is None
    documents = read_documents(spark, str(tmp_path / "x"), schemas.VACANCY)
    regions = spark.createDataFrame([("2079", 10, 100)], "area_id string, federal_region_id bigint, score int")
    strict, _ = vacancies.transform_vacancies(documents, dictionaries.read(rates.TABLE), regions, "b", "2023-03-12 15:00:00", strict=True)
    with pytest.raises(Exception, match="not in the dictionary: KZT"):
        strict.collect()


def test_falsy_values_can_be_kept(spark, dictionaries, tmp_path):
    land(tmp_path / "f", "2.json", vacancy(2, salary=pay(0, 50, "RUR", False)))
    documents = read_documents(spark, str(tmp_path / "f"), schemas.VACANCY)
    regions = spark.createDataFrame([("2079", 10, 100)], "area_id string, federal_region_id bigint, score int")
    kept, _ = vacancies.transform_vacancies(documents, dictionaries.read(rates.TABLE), regions, "b", "2023-03-12 15:00:00", keep_falsy=True)
    row = kept.first()
    assert (row.salary_from, row.salary_gross, row.schedule) == (0.0, False, "")


def hit(number, date="2023-01-31", codes=("1.02.EP", "1.02.XX", "3.1"), **source):
    return {"_id": number, "_source": {"name": " n ", "last_status": {"created_date": date}, "oecds": [{"code": c} for c in codes], **source}}


def document(**kinds):
    return {
        "rosrid_id": "r1", "university_id": 100, "university_ogrn": "111", "rosrid_university_id": 1, "start_date": "2023-01-01", "end_date": "2023-01-31",
        "actives_count": sum(len(v) for v in kinds.values()), "actives": kinds,
    }


@pytest.fixture
def registry(store):
    fill(store, "rosrid_active_type", (3, "Проект", "НИОКТР", None), (1, "Проект ранний", "НИОКТР", dt.datetime(2023, 1, 1)), (4, "РИД 2", "РИД", None), (2, "РИД 1", "РИД", None), (5, "Докторская", "ДД", None), (6, "Кандидатская", "КД", None))
    fill(store, "rosrid_rosrid_university", (1, 100, "r1", None))
    fill(store, "university_university", (100, "111", 9, "short", "display", None))
    fill(store, "dict_oecd", (50, "1.02", "Математика"), (51, "3.1", None))
    return store


def actives_report(store, **options):
    read = store.read
    return actives.actives_report(
        read(actives.TABLE), read("rosrid_active_type"), read("rosrid_rosrid_university"), read("university_university"), read(actives.BRIDGE), read("dict_oecd"), **options
    )


def load_actives(spark, store, tmp_path, folder, document, now, **options):
    documents = read_documents(spark, land(tmp_path / folder, "r1.json", document), schemas.ACTIVES_DOCUMENT)
    counts = actives.checked_counts(documents).first()
    assert counts.actives_count == counts.found
    rows, missing = actives.transform_actives(actives.hits_of_documents(documents), store.read("rosrid_active_type"), "b", now)
    assert missing.isEmpty()
    return actives.load_actives(store, rows, store.read("dict_oecd"), now, **options)


@pytest.mark.parametrize("only_live", [False, True])
def test_actives(spark, registry, tmp_path, only_live):
    store = registry
    first = document(
        nioktrs=[hit("A1", executor={"ogrn": "111"}), hit("A2", executor={}, codes=("1.02", "9.9"))],
        rids=[hit("A3", executors=[{"ogrn": "222"}, {"ogrn": "111"}]), hit("A4", executors=[{}], codes=())],
        dissertations=[hit("A5", author_organization={"ogrn": "111"}, dissertation_type={"name": "Докторская"}, date="2023-01-20"), hit("A6", dissertation_type={"name": "x"})],
    )
    assert load_actives(spark, store, tmp_path, "d1", first, "2023-04-15 07:00:00", only_live=only_live) == 6
    rows = {r.object_id: r for r in store.read(actives.TABLE).collect()}
    assert {k: (r.type_id, r.is_executor) for k, r in rows.items()} == {"A1": (3, True), "A2": (3, False), "A3": (2, True), "A4": (2, False), "A5": (5, True), "A6": (6, False)}
    assert (rows["A3"].url, rows["A3"].title) == ("https://rosrid.ru/rid/detail/A3", "n")
    bridge = {(r.active_id, r.oecd_id) for r in store.read(actives.BRIDGE).collect()}
    both = {(rows[k].id, c) for k in ("A1", "A3", "A5", "A6") for c in (50, 51)}
    assert bridge == both | {(rows["A2"].id, 50)}

    newest = {r.object_id: r for r in actives_report(store).collect()}
    assert set(newest) == {"A1", "A2", "A3", "A6"}
    assert (newest["A1"].oecd, newest["A2"].oecd, newest["A1"].type) == ("1.02 - Математика; 3.1 - ", "1.02 - Математика", "Проект")
    assert {r.object_id for r in actives_report(store, from_month_start=True).collect()} == {"A1", "A2", "A3", "A5", "A6"}

    # A1 comes again twice: its stored rows are stamped each time, and only the last is live.
    second = document(nioktrs=[hit("A1", executor={"ogrn": "111"}, date="2023-02-10")])
    for folder, now in (("d2", "2023-05-15 07:00:00"), ("d3", "2023-06-15 07:00:00"), ("d3", "2023-06-15 07:00:00")):
        assert load_actives(spark, store, tmp_path, folder, second, now, only_live=only_live) == 1
    ends = sorted(str(r.deleted_at) for r in store.read(actives.TABLE).where("object_id = 'A1'").collect())
    older = "2023-05-15 07:00:00" if only_live else "2023-06-15 07:00:00"
    assert ends == sorted([older, "2023-06-15 07:00:00", "None"])
    assert store.read(actives.TABLE).count() == 8
    assert store.read(actives.BRIDGE).count() == 9 + 2 * 2
    assert [r.object_id for r in actives_report(store).collect()] == ["A1"]
    assert load_actives(spark, store, tmp_path, "d4", document(nioktrs=[]), "2023-07-15 07:00:00", only_live=only_live) == 0
    assert store.read(actives.TABLE).count() == 8


@pytest.mark.parametrize("only_live", [False, True])
def test_actives_history_is_the_loads_one_by_one(spark, registry, tmp_path, only_live):
    """Four intervals, one of them empty, on a table that holds an earlier load; then all of it again."""
    months = {
        "2023-05-15 07:00:00": [hit("A1"), hit("A2", codes=("1.02",))], "2023-06-15 07:00:00": [],
        "2023-07-15 07:00:00": [hit("A1"), hit("A1"), hit("A3", codes=())], "2023-08-15 07:00:00": [hit("A2"), hit("A3"), hit("A4")],
    }
    other = TableStore(spark, str(tmp_path / "other"))
    for name in ("rosrid_active_type", "dict_oecd"):
        other.append(name, registry.read(name))
    batches = None
    for folder, (now, hits) in enumerate(months.items()):
        for store in (registry, other):
            if not folder:
                load_actives(spark, store, tmp_path, "before", document(nioktrs=[hit("A1"), hit("A9")]), "2023-04-15 07:00:00", only_live=only_live)
        load_actives(spark, registry, tmp_path, f"m{folder}", document(nioktrs=hits), now, only_live=only_live)
        documents = read_documents(spark, land(tmp_path / f"m{folder}", "r1.json", document(nioktrs=hits)), schemas.ACTIVES_DOCUMENT)
        rows, _ = actives.transform_actives(actives.hits_of_documents(documents), other.read("rosrid_active_type"), "b", now)
        batches = rows if batches is None else batches.unionByName(rows)
    for _ in range(2):
        assert actives.load_actives_history(other, batches, other.read("dict_oecd"), only_live) == 8
        for name in (actives.TABLE, actives.BRIDGE):
            assert sorted(map(str, other.read(name).collect())) == sorted(map(str, registry.read(name).collect()))
    assert actives.load_actives_history(other, batches.limit(0), other.read("dict_oecd"), only_live) == 0


def test_code_rejects(spark, registry, tmp_path):
    path = land(tmp_path / "d", "r1.json", document(nioktrs=[hit("A1", codes=("1.02.EP", "9.9", "9.9.X"))]))
    hits = actives.hits_of_documents(read_documents(spark, path, schemas.ACTIVES_DOCUMENT))
    rows, _ = actives.transform_actives(hits, registry.read("rosrid_active_type"), "b", "2023-04-15")
    parents, bridge, rejects = actives.split_actives(rows, registry.read("dict_oecd"))
    assert (parents.count(), bridge.count(), [tuple(r) for r in rejects.collect()]) == (1, 1, [("9.9", 1)])


def test_export_only_after_a_load(spark, registry, tmp_path):
    load_actives(spark, registry, tmp_path, "d", document(rids=[hit("A3", executors=[])]), "2023-04-15 07:00:00")
    path = str(tmp_path / "report")
    write = lambda: export_csv(actives_report(registry), path, F.col("object_id"))
    assert refresh_if_loaded(1, write) and not refresh_if_loaded(0, lambda: pytest.fail("refreshed"))
    lines = [r.value for r in spark.read.text(path).collect()]
    assert lines[0].startswith("row_index|id|university_id|") and lines[1].startswith("0|")


def test_backfill(spark):
    windows = backfill.monthly_intervals(spark, "2023-01-15 07:00:00", "2023-04-15 07:00:00").orderBy("interval_end")
    assert [(str(r.interval_end), str(r.start_date), str(r.end_date)) for r in windows.collect()][::3] == [
        ("2023-01-15 07:00:00", "2022-10-01", "2022-10-31"), ("2023-04-15 07:00:00", "2023-01-01", "2023-01-31")
    ]
    order = []
    done = backfill.run_intervals(spark, "2023-01-15", "2023-03-15", lambda end: order.append(end) or len(order))
    assert [d.month for d in order] == [1, 2, 3] and list(done.values()) == [1, 2, 3]


def test_stream(spark, store, tmp_path):
    def prepare(entries):
        return news.transform_news(topical(numbered(entries)), spark.createDataFrame([], schemas.FETCH_MANIFEST), "2022-12-23 14:00:00", "b")

    def run():
        ingest(atom_stream(spark, path, 1), store, news.TABLE, "hash", news.first_entry(), str(tmp_path / "state"), prepare).awaitTermination()
        return sorted(r.url for r in store.read(news.TABLE).collect())

    path = land(tmp_path / "in", "1.xml", feed(entry("http://a.org"), entry("http://b.org")))
    land(tmp_path / "in", "2.xml", feed(entry("http://b.org"), entry("http://b.org")))
    assert run() == ["http://a.org", "http://b.org"]
    land(tmp_path / "in", "3.xml", feed(entry("http://a.org"), entry("http://c.org")))
    assert run() == ["http://a.org", "http://b.org", "http://c.org"]
    assert run() == ["http://a.org", "http://b.org", "http://c.org"]
