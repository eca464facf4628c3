import datetime as dt
import json
import re

import pytest
from pyspark.sql import functions as F

from gleanery import schemas
from gleanery import sources as src
from gleanery.plans import rates


def land(folder, name, content):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(content if isinstance(content, str) else json.dumps(content, ensure_ascii=False), encoding="utf-8")
    return str(folder)


def test_documents_keep_their_path_and_fail_when_broken(spark, tmp_path):
    path = land(tmp_path / "docs", "1.json", json.dumps({"id": "1", "name": "Ж", "salary": None}, indent=4))
    row = src.read_documents(spark, path, schemas.VACANCY).first()
    assert (row.id, row.name, row.salary) == ("1", "Ж", None) and row.s3_key.endswith("/docs/1.json")
    land(tmp_path / "docs", "2.json", "{broken")
    with pytest.raises(Exception):
        src.read_documents(spark, path, schemas.VACANCY).collect()


def test_staged_array_and_round_trip(spark, tmp_path):
    path = land(tmp_path / "array", "a.json", [{"topic": "наука", "feeds": [{"url": "u", "keyword": "k"}]}, {"topic": "t", "feeds": []}])
    staged = src.read_staged(spark, path, schemas.FEED_CONFIG, arrays=True)
    assert sorted(r.topic for r in staged.collect()) == ["t", "наука"]
    out = str(tmp_path / "out")
    src.write_staged(staged, out)
    src.write_staged(staged, out)
    assert src.read_staged(spark, out, schemas.FEED_CONFIG).count() == 2


def test_intervals_are_replaced_one_by_one(spark, tmp_path):
    at = dt.datetime(2023, 3, 1, 12)
    assert src.interval_path("s3a://b", "local", "rates", at) == "s3a://b/hosts/local/rates/interval=2023-03-01-12-00-00"
    path = str(tmp_path / "iv")
    schema = "v int, interval_end timestamp_ntz"
    src.write_intervals(spark.createDataFrame([(1, at), (2, dt.datetime(2023, 3, 2, 12))], schema), path)
    src.write_intervals(spark.createDataFrame([(3, at)], schema), path)
    assert sorted((r.v, r.interval) for r in spark.read.schema("v int, interval string").json(path).collect()) == [
        (2, "2023-03-02-12-00-00"),
        (3, "2023-03-01-12-00-00"),
    ]


def test_last_document_wins(spark, tmp_path):
    docs = spark.createDataFrame([("v1", 1, "old"), ("v1", 2, "new"), ("v2", 1, "x")], "id string, fetched int, body string")
    path = str(tmp_path / "last")
    src.write_documents(docs, path, "id", "fetched")
    back = src.read_documents(spark, path, "id string, fetched int, body string", lines=True).collect()
    assert sorted((r.id, r.body) for r in back) == [("v1", "new"), ("v2", "x")] and all(r.s3_key for r in back)


def test_many_rows_in_few_files_come_back(spark, tmp_path):
    rows, path = spark.range(100).repartition(4), str(tmp_path / "many")
    src.write_staged(rows, path)
    assert src.read_staged(spark, path, "id bigint").count() == 100
    src.write_documents(rows, path, "id", "id")
    assert src.read_documents(spark, path, "id bigint", lines=True).count() == 100


ATOM = """<?xml version="1.0" encoding="utf-8"?><feed xmlns="http://www.w3.org/2005/Atom"><title>t</title>
<entry><id>1</id><title type="html">x &lt;b&gt;y&lt;/b&gt; it's </title><link href="https://e.org/?a=1&amp;b=2"/>
<published>2022-12-23T23:30:00+03:00</published><content type="html"></content></entry>
<entry><title type="html">z</title><link href="u"/><published>2022-12-24T00:30:00Z</published>
<content type="html"> &lt;i&gt;c&lt;/i&gt; </content></entry></feed>"""


def test_atom(spark, tmp_path):
    path = land(tmp_path / "atom", "feed-0-0.xml", ATOM)
    first, second = src.read_atom(spark, path).orderBy("published").collect()
    assert (first.href, first.title, first.published) == ("https://e.org/?a=1&b=2", "x <b>y</b> it's ", "2022-12-23T23:30:00+03:00")
    assert not first.content
    assert second.content == " <i>c</i> " and second.feed_file == "feed-0-0.xml"


def test_feed_keys_are_unique(spark):
    config = spark.createDataFrame([(0, "a", [("u0", "k"), ("u1", "k")]), (1, "b", [("u2", "k")])], "topic_no int, " + schemas.FEED_CONFIG)
    feeds = src.expand_feeds(config).collect()
    assert sorted(r.feed_key for r in feeds) == ["0-0", "0-1", "1-0"]
    assert {r.feed for r in feeds} == {"u0", "u1", "u2"}


SHEET = """<?xml version="1.0" encoding="utf-8"?><ValCurs Date="02.03.2023" name="x">
<Valute ID="R01010"><NumCode>036</NumCode><CharCode>AUD</CharCode><Nominal>100</Nominal><Name>Доллар</Name><Value>50,4500</Value></Valute>
<Valute ID="R01235"><NumCode>840</NumCode><CharCode>USD</CharCode><Nominal>1</Nominal><Name>Доллар США</Name><Value>75,5</Value></Valute>
</ValCurs>"""


def test_rate_sheet(spark, tmp_path):
    path = land(tmp_path / "rates", "extracted.xml", SHEET)
    aud = rates.transform_rates(src.read_rates(spark, path), "2023-03-02 12:00:00+03:00").where("char_code = 'AUD'").first()
    assert (aud.currency_id, aud.num_code, aud.nominal, aud.value, aud.date) == ("R01010", 36, 1, 0.5045000000000001, dt.date(2023, 3, 2))
    assert aud.created_at == dt.datetime(2023, 3, 2, 12)


TREE = {"id": "113", "parent_id": None, "name": "Россия", "areas": [
    {"id": "2019", "parent_id": "113", "name": "Московская область", "areas": [{"id": "2079", "parent_id": "2019", "name": "Химки", "areas": []}]},
    {"id": "1", "parent_id": "113", "name": "Москва", "areas": []}]}


def read_tree(spark, path, depth):
    return src.read_documents(spark, path, f"areas {schemas.area_tree(depth)}")


def test_area_tree(spark, tmp_path):
    path = land(tmp_path / "tree", "areas.json", {"areas": [TREE]})
    flat = src.flatten_area_tree(read_tree(spark, path, 5))
    assert {r.id: r.parent_id for r in flat.collect()} == {"113": None, "2019": "113", "1": "113", "2079": "2019"}
    assert src.flatten_area_tree(read_tree(spark, path, 3), depth=3).count() == 4
    assert src.flatten_area_tree(read_tree(spark, path, 2), depth=2).count() == 4
    deep = []
    for i in range(12, 0, -1):
        deep = [{"id": str(i), "parent_id": str(i - 1) if i > 1 else None, "name": f"N{i}", "areas": deep}]
    chain = src.flatten_area_tree(read_tree(spark, land(tmp_path / "deep", "areas.json", {"areas": deep}), 5))
    assert {r.id: r.parent_id for r in chain.collect()} == {str(i): str(i - 1) if i > 1 else None for i in range(1, 13)}
    empty = land(tmp_path / "none", "areas.json", {"areas": []})
    with pytest.raises(ValueError, match="no nodes"):
        src.flatten_area_tree(read_tree(spark, empty, 5))


def page(number, hits, total=25):
    source = lambda i: {"_id": f"h{i}", "_source": {"name": f"n{i}"}}
    return {"org_id": "o1", "type": "rids", "page": number, "hits": {"total": {"value": total}, "hits": [source(i) for i in hits]}}


@pytest.mark.parametrize("numbers, found, complete", [((1, 2, 2, 3), 25, True), ((1, 2, 2), 20, False)])
def test_hits_of_repeated_pages(spark, tmp_path, numbers, found, complete):
    for n, number in enumerate(numbers):
        land(tmp_path / "pages", f"{n}.json", page(number, range(10 * (number - 1), min(10 * number, 25))))
    hits, state = src.merge_hits(src.read_documents(spark, str(tmp_path / "pages"), schemas.SEARCH_PAGE))
    assert hits.count() == hits.select("hit._id").distinct().count() == found
    assert state.first().complete is complete


def test_no_hits_is_complete(spark, tmp_path):
    path = land(tmp_path / "pages", "1.json", page(1, [], total=0))
    hits, state = src.merge_hits(src.read_documents(spark, path, schemas.SEARCH_PAGE))
    assert hits.isEmpty() and state.first().complete


def test_vacancy_pages(spark, tmp_path):
    item = lambda i: {"id": str(i), "type": {"id": "open"}}
    for n, (employer, number, items) in enumerate([(7, 0, [1, 2]), (7, 1, [3]), (7, 1, [3]), (8, 0, [4])]):
        land(tmp_path / "lists", f"{n}.json", {"employer_id": employer, "page": number, "pages": 2, "items": [item(i) for i in items]})
    items, state = src.merge_pages(src.read_documents(spark, str(tmp_path / "lists"), schemas.VACANCY_PAGE), ["employer_id"])
    assert sorted((r.employer_id, r.item.id) for r in items.collect()) == [(7, "1"), (7, "2"), (7, "3"), (8, "4")]
    assert {r.employer_id: r.complete for r in state.collect()} == {7: True, 8: False}


def test_requests(spark):
    orgs = spark.createDataFrame([("r1",), ("r2",)], "rosrid_id string")
    requests = src.plan_requests(orgs, F.lit("2023-04-15")).collect()
    assert len(requests) == 6
    one = next(r for r in requests if r.rids and r.organization == ["r1"])
    assert (one.nioktrs, one.dissertations, one.page, one.start_date, one.end_date) == (False, False, 1, "2023-01-01", "2023-01-31")
    assert (one.search_area, one.sort_by, one.search_query, one.rubrics, one.ikrbses) == ("Во всех полях", "Дата регистрации", None, [], False)
    totals = spark.createDataFrame([("a", 25), ("b", 0), ("c", 20)], "list string, total int")
    pages = src.plan_pages(totals, F.lit(1), src.page_count(F.col("total")).cast("int"))
    assert sorted((r.list, r.page) for r in pages.collect()) == [("a", 1), ("a", 2), ("a", 3), ("c", 1), ("c", 2)]


@pytest.fixture
def stored(spark, tmp_path):
    store, name = src.TableStore(spark, str(tmp_path / "store")), "rosrid_rosrid_university"
    rows = lambda *r: spark.createDataFrame([(i, 1, "a", e) for i, e in r], schemas.TABLES[name])
    parts = lambda: sorted(p.name for p in (tmp_path / "store" / name).iterdir() if p.name.startswith("part="))
    return store, name, rows, parts


def ids(df):
    return sorted(r.id for r in df.collect())


def test_store_parts(stored):
    store, name, rows, parts = stored
    one, other = dt.datetime(2023, 1, 1), dt.datetime(2023, 1, 2, 23)
    assert store.read(name).isEmpty() and store.read_live(name).isEmpty()
    store.append(name, rows((1, None), (2, one)))
    store.append(name, rows((3, None)))
    assert ids(store.read(name)) == [1, 2, 3] and ids(store.read_live(name)) == [1, 3]
    # A next state that is made of the rows it replaces; a day that has rows keeps them.
    ending = F.when(F.col("id") == 1, F.lit(one)).cast("timestamp_ntz")
    store.replace_live(name, store.read_live(name).withColumn("deleted_at", ending).unionByName(rows((4, None))))
    assert ids(store.read(name)) == [1, 2, 3, 4] and ids(store.read_live(name)) == [3, 4]
    assert parts() == ["part=2023-01-01", "part=live"]
    plan = store.read_live(name)._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^]]*part#", plan)
    # All parts change: one comes, one goes.
    store.replace(name, store.read(name).where("id <> 2").withColumn("deleted_at", F.when(F.col("id") < 4, F.lit(other)).cast("timestamp_ntz")))
    assert ids(store.read(name)) == [1, 3, 4] and ids(store.read_live(name)) == [4]
    assert parts() == ["part=2023-01-02", "part=live"]
    # No live rows are left.
    store.replace_live(name, store.read_live(name).withColumn("deleted_at", F.lit(other).cast("timestamp_ntz")))
    assert ids(store.read(name)) == [1, 3, 4] and store.read_live(name).isEmpty()
    store.replace(name, rows())
    assert store.read(name).isEmpty() and parts() == []


def test_store_opens_the_parts_it_changes_only(stored, tmp_path):
    store, name, rows, _ = stored
    days = [dt.datetime(2023, 1, d) for d in (1, 2, 3)]
    store.append(name, rows((1, days[0]), (2, days[1]), (3, None)))
    files = lambda part: sorted((p.name, p.stat().st_mtime_ns) for p in (tmp_path / "store" / name / f"part={part}").glob("*.parquet"))
    before = files("2023-01-01"), files("2023-01-02")
    store.replace_live(name, rows((3, days[2]), (4, None)))
    assert (files("2023-01-01"), files("2023-01-02")) == before and ids(store.read(name)) == [1, 2, 3, 4]


@pytest.mark.parametrize("whole", [False, True])
def test_a_load_that_broke_off_before_its_live_rows(stored, monkeypatch, whole):
    store, name, rows, _ = stored
    first, now = dt.datetime(2023, 1, 1), dt.datetime(2023, 2, 1)
    store.append(name, rows((1, None), (2, None), (3, first)))

    def load():
        before = store.read(name) if whole else store.read_live(name)
        again = F.when((F.col("id") != 2) if whole else (F.col("id") == 1), F.lit(now)).otherwise(F.col("deleted_at"))
        state = before.where("id < 9").withColumn("deleted_at", again.cast("timestamp_ntz")).unionByName(rows((9, None)))
        (store.replace if whole else store.replace_live)(name, state)

    with monkeypatch.context() as patched:
        patched.setattr(store, "_overwrite_live", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            load()
    assert ids(store.read_live(name)) == [1, 2]
    for _ in range(2):
        load()
        ends = {(r.id, r.deleted_at) for r in store.read(name).collect()}
        assert ends == {(1, now), (2, None), (3, now if whole else first), (9, None)}
        assert store.read(name).count() == 4


def test_gate(spark):
    items = spark.createDataFrame([(1, "a"), (2, "b")], "k int, item string")
    lists = spark.createDataFrame([(1, True), (2, False), (3, True)], "k int, complete boolean")
    whole, lacking = src.gate(items, lists, ["k"])
    assert [r.item for r in whole.collect()] == ["a"] and [r.k for r in lacking.collect()] == [2]
    assert src.gate(items, lists.where("complete"), ["k"], strict=True)[0].count() == 2
    with pytest.raises(Exception, match="pages are missing of 2"):
        src.gate(items, lists, ["k"], strict=True)[0].collect()


def test_stage_reads_what_it_wrote(spark):
    with src.stage(spark.range(5).withColumn("t", F.lit("x")), "tests") as (batch, size):
        _check_stage(batch, size)
    with pytest.raises(Exception):
        batch.collect()  # gone


def _check_stage(batch, size):
    assert size == 5 and batch.columns == ["id", "t"] and batch.count() == 5


@pytest.mark.parametrize("few", [0, 100])
def test_ended_rows_are_put_in_place_once(spark, tmp_path, monkeypatch, few):
    """Repeats are found by hashes: rows without them are not moved, whether there are some repeats or many."""
    monkeypatch.setattr("gleanery.sources.store.REPEATS", few)
    store = src.TableStore(spark, str(tmp_path / "store"))
    at, values = dt.datetime(2023, 1, 1), [("a", "x", 0), ("a", "x", 0), ("a", "y", 0), (None, "x", 0), (None, "x", 0), ("b", None, 1), ("b", None, 1)]
    rows = spark.createDataFrame([(i, t, at if not live else None) for i, t, live in values], "id string, title string, deleted_at timestamp_ntz")
    store.replace("hh_vacancy", rows)
    found = sorted(((r.id, r.title) for r in store.read("hh_vacancy").collect()), key=repr)
    assert found == sorted([("a", "x"), ("a", "y"), (None, "x"), ("b", None), ("b", None)], key=repr)
    with store._once(store.read("hh_vacancy").where("id = 'a'")) as once:
        plan = once._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan
