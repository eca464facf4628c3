"""Snapshots by changes, refreshed reports, broken input, verdicts in one pass."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gleanery.checks import flows, increments, storage
from gleanery.operators import judged_lookup, rejects_of, text_of_segments, text_segments
from gleanery.plans import vacancies
from gleanery.plans.monthly import MonthlyReport, write_months
from gleanery.session import remove_path
from gleanery.sources import SnapshotHistory, Verdicts, read_atom, split_atom, split_documents

SF_DIR = "/root/testdata/sf0.001"


def snapshot(spark, rows):
    return spark.createDataFrame(rows, "k bigint, v string, at timestamp_ntz")


def test_snapshot_history(spark, tmp_path):
    history = SnapshotHistory(spark, str(tmp_path), "k bigint, v string, at timestamp_ntz")
    at = dt.datetime(2023, 1, 1, 0, 0, 0, 1)
    assert history.history().count() == 0
    first = [(1, "a", at), (1, "a", at), (None, None, None), (2, "null", None)]
    assert history.load(snapshot(spark, first), "2023-01-01") == (4, 3, 0)
    # The same rows in another order change nothing; a microsecond, a copy or a NULL does.
    assert history.load(snapshot(spark, first[::-1]), "2023-01-02") == (4, 0, 0)
    third = [(1, "a", at), (None, None, None), (2, None, None), (1, "a", at.replace(microsecond=2))]
    assert history.load(snapshot(spark, third), "2023-01-03") == (4, 3, 2)
    assert sorted(map(str, history.live().collect())) == sorted(map(str, snapshot(spark, third).collect()))
    held = history.history().groupBy("created_at", "deleted_at").count().orderBy("created_at").collect()
    days = [dt.datetime(2023, 1, d) for d in (1, 2, 3)]
    assert [tuple(r) for r in held] == [(days[0], days[1], 4), (days[1], days[2], 4), (days[2], None, 4)]
    assert history.load(snapshot(spark, []), "2023-01-04") == (0, 0, 4)
    assert history.live().count() == 0


def test_snapshot_run_again(spark, tmp_path):
    history = SnapshotHistory(spark, str(tmp_path), "k bigint, v string")
    rows = lambda *keys: spark.createDataFrame([(k, "x") for k in keys], "k bigint, v string")
    history.load(rows(1, 2), "2023-01-01")
    history.load(rows(3), "2023-01-02")
    # The last load may come again with other rows, and a try that broke off before its last step is not seen.
    assert history.load(rows(1), "2023-01-02 00:00:00") == (1, 0, 1)
    assert [r["k"] for r in history.live().collect()] == [1]
    remove_path(spark, f"{tmp_path}/loads/load=2")
    assert sorted(r["k"] for r in history.live().collect()) == [1, 2]
    with pytest.raises(ValueError, match="later load"):
        history.load(rows(1), "2022-12-31")
    with pytest.raises(ValueError, match="itself"):
        SnapshotHistory(spark, str(tmp_path), "digest string")


def test_snapshot_hot_row(spark, tmp_path):
    history = SnapshotHistory(spark, str(tmp_path), "v string")
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("v"))
    assert history.load(rows, "2023-01-01") == (30_000, 10_001, 0)
    assert history.live().where("v = 'hot'").count() == 20_000


def test_split_documents(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    files = {"good": '{"id": 1,\n "name": "a"}', "cut": '{"id": 2,', "typed": '{"id": {"x": 1}, "name": "b"}', "blank": "\n ", "empty": "", "null": '{"name": null}'}
    for name, text in files.items():
        (landed / f"{name}.json").write_text(text)
    good, rejects = split_documents(spark, str(landed), "id bigint, name string", str(tmp_path / "split"))
    assert good.columns == ["id", "name", "s3_key"]
    assert sorted((r["s3_key"].split("/")[-1], r["id"], r["name"]) for r in good.collect()) == [("good.json", 1, "a"), ("null.json", None, None)]
    # What is wrong in a column counts for readers of the others too.
    assert good.select("name").count() == 2
    found = {r["path"].split("/")[-1]: (r["reason"], r["record"]) for r in rejects.collect()}
    assert found == {"cut.json": ("not JSON", files["cut"]), "typed.json": ("not of the schema", files["typed"]), "blank.json": ("no document", None)}
    with pytest.raises(Exception, match="(?i)malformed"):
        split_documents(spark, str(landed), "id bigint, name string", str(tmp_path / "strict"), strict=True)


def test_split_documents_all_broken(spark, tmp_path):
    (tmp_path / "landed").mkdir()
    (tmp_path / "landed" / "a.json").write_text("{")
    good, rejects = split_documents(spark, str(tmp_path / "landed"), "id bigint", str(tmp_path / "split"))
    assert good.count() == 0 and rejects.count() == 1


def test_split_atom(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    entry = '<entry><link href="{0}"/><published>2023</published><title type="html">{0}</title><content>c</content></entry>'
    (landed / "a.xml").write_text("<feed>" + entry.format("a0") + entry.format("a1").replace("</title>", "") + entry.format("a2") + "</feed>")
    (landed / "b.xml").write_text("<feed>" + entry.format("b0 &amp; &lt;i&gt;") + "</feed>")
    (landed / "c.xml").write_text("<feed>" + entry.format("c0").replace("</entry>", "") + entry.format("c1") + entry.format("c2").replace("</entry>", ""))
    (landed / "d.xml").write_text("<feed></feed>")
    good, rejects = split_atom(spark, str(landed), str(tmp_path / "split"))
    assert sorted((r["feed_file"], r["entry_no"], r["href"]) for r in good.collect()) == [("a.xml", 0, "a0"), ("a.xml", 2, "a2"), ("b.xml", 0, "b0 & <i>"), ("c.xml", 1, "c1")]
    broken = sorted((r["path"].split("/")[-1], r["entry_no"], r["reason"], r["record"][7:24]) for r in rejects.collect())
    link = '<link href="{}"/>'
    assert broken == [(f"{n[0]}.xml", int(n[1]), reason, link.format(n)) for n, reason in (("a1", "not XML"), ("c0", "not closed"), ("c2", "not closed"))]
    assert good.where("feed_file = 'b.xml'").first()["title"] == "b0 & <i>"
    with pytest.raises(Exception, match="(?i)malformed"):
        split_atom(spark, str(landed), str(tmp_path / "strict"), strict=True)


def test_split_atom_as_read(spark, tmp_path):
    """Sound feeds over many input splits come out as the plain reader gives them."""
    landed = tmp_path / "landed"
    landed.mkdir()
    entry = '<entry>\n<link href="{0}"/><published>2023</published><title type="html"> {0} &#1078;</title><content>{1}</content>\n</entry>\n'
    for name in "ab":
        (landed / f"{name}.xml").write_text("<feed>" + "".join(entry.format(f"{name}{i}", "c" * (i % 97)) for i in range(500)) + "</feed>")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        good, rejects = split_atom(spark, str(landed), str(tmp_path / "split"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    plain = read_atom(spark, str(landed))
    assert rejects.count() == 0 and good.columns == plain.columns
    assert sorted(good.collect()) == sorted(plain.collect()) and good.count() == 1000


def test_judged_lookup(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "b")], "id bigint, code string")
    codes = spark.createDataFrame([("a", 10)], "code string, value bigint")
    judged = judged_lookup(rows, codes, "code", "code", {"value": "found"}, "code")
    again = judged_lookup(judged, codes, "code", "code", {"value": "twice"}, "again")
    assert {r["id"]: (r["found"], r["twice"], r["lacking"]) for r in again.collect()} == {
        1: (10, 10, []), 2: (None, None, ["code", "again"]), 3: (None, None, []), 4: (None, None, ["code", "again"])}
    written = Verdicts(again.withColumn("verdict", F.when(F.size("lacking") > 0, "bad").otherwise("fine")), str(tmp_path / "v"))
    assert [tuple(r) for r in rejects_of(written.rows("bad"), "again", "code").collect()] == [("b", 2)]
    assert written.rows().count() == 4 and written.rows("fine").count() == 2
    # Another run leaves nothing of the first.
    assert Verdicts(again.limit(0).withColumn("verdict", F.lit("x")), str(tmp_path / "v")).rows().count() == 0


def test_vacancies_in_one_pass(spark, tmp_path):
    judged = flows._judged(spark, SF_DIR)
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("o_orderkey") > 0 and sum("Relation [" in line and "o_orderkey" in line for line in plan.splitlines()) == 1
    rows, rejects = vacancies.split_vacancies(judged, str(tmp_path / "v"))
    plain, lazy = flows._transformed(spark, SF_DIR)
    order = ["hh_id"]
    assert rows.select(plain.columns).orderBy(order).collect() == plain.orderBy(order).collect()
    for name in ("currency", "area"):
        assert sorted(rejects[name].collect()) == sorted(lazy[name].collect())
        paths = rejects[name]._jdf.queryExecution().executedPlan().toString()
        assert "verdict" in paths and "PartitionFilters: [isnotnull(verdict" in paths


def test_monthly_report(spark, tmp_path):
    source, path = str(tmp_path / "source"), str(tmp_path / "report")
    rows = lambda *days: spark.createDataFrame([(d and dt.date.fromisoformat(d),) for d in days], "day date")
    report = MonthlyReport(spark, source, path, "day date", lambda df: df.groupBy("month").agg(F.count(F.lit(1)).alias("n")).where("n < 4"))
    shown = lambda: {r["month"]: r["n"] for r in report.read().collect()}
    write_months(rows("2023-01-01", "2023-01-02", "2023-02-01", None), source, "day", "1")
    assert report.refresh() == ["2023-01", "2023-02", "none"] and shown() == {"2023-01": 2, "2023-02": 1, "none": 1}
    assert report.refresh() == []
    write_months(rows("2023-02-03", "2023-03-01"), source, "day", "2")
    # Before the refresh the report is the old one.
    assert shown() == {"2023-01": 2, "2023-02": 1, "none": 1}
    assert report.refresh() == ["2023-02", "2023-03"] and shown() == {"2023-01": 2, "2023-02": 2, "2023-03": 1, "none": 1}
    # A load run again with other rows: one month loses its source, one becomes empty in the report.
    write_months(rows("2023-01-01", "2023-01-02", "2023-01-03"), source, "day", "2")
    assert report.refresh() == ["2023-01", "2023-02", "2023-03"] and shown() == {"2023-02": 1, "none": 1}
    assert report.refresh() == []


def test_monthly_refresh_touches_changed_months(spark):
    report, (first, second, third) = increments._refreshed(spark, SF_DIR)
    assert third and all(m.startswith("1998") for m in third) and len(first) > 3 * len(third) and set(second) - set(third)
    plan = report.rows().where(F.col("month").isin(third))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "1998-01" in plan


def test_text_segments(spark):
    """A key with a third of all rows, one text with most of another key's, NULL keys and texts, against plain sorting."""
    rows = [("hot", f"t{i % 4000:05d}") for i in range(9000)] + [(f"k{i % 500}", f"x{i}") for i in range(9000)]
    rows += [("same", "again")] * 7000 + [("same", "é"), (None, "b"), (None, "a"), ("empty", None), ("", ""), ("", "")]
    df = spark.createDataFrame(rows, "k string, t string").repartition(8)
    segments = text_segments(df, ["k"], "t", "out", size=3000, parts=16)
    found = segments.collect()
    wanted = {}
    for key, text in rows:
        if text is not None:
            wanted.setdefault(key, []).append(text)
    wanted = {key: "; ".join(sorted(texts, key=str.encode)) for key, texts in wanted.items()}
    made = {}
    for r in sorted(found, key=lambda r: r["segment"]):
        made.setdefault(r["k"], []).append(r)
    assert made.keys() == wanted.keys()
    for key, parts in made.items():
        assert [r["segment"] for r in parts] == list(range(len(parts)))
        assert "; ".join(r["out"] for r in parts) == wanted[key]
        for r in parts:
            assert wanted[key][r["chars_before"]:].startswith(r["out"]) and len(r["out"]) < 2 * 3000
    assert len(made["hot"]) > 15 and len(made["same"]) > 10
    whole = {r["k"]: r for r in text_of_segments(segments, ["k"], "out", limit=50_000).collect()}
    for key, r in whole.items():
        size = len(wanted[key].encode())
        assert (r["segments"], r["bytes"], r["out"]) == (len(made[key]), size, wanted[key] if size <= 50_000 else None)
    assert whole["hot"]["out"] is None and whole["k1"]["out"] is not None


def test_text_segments_of_a_hot_key_are_spread(spark):
    """No task gets three times the rows of the median one, though half of them have one key."""
    df = spark.range(40_000).selectExpr("IF(id % 2 = 0, 'hot', CAST(id % 999 AS STRING)) AS k", "CAST(id AS STRING) AS t")
    dealt = text_segments(df, ["k"], "t", "out", size=500, parts=16)
    lengths = [r["n"] for r in dealt.where("k = 'hot'").groupBy("segment").agg(F.sum(F.length("out")).alias("n")).collect()]
    assert len(lengths) > 100 and max(lengths) < 3 * sorted(lengths)[len(lengths) // 2]
    counts = df.repartitionByRange(16, "k", "t").withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    sizes = sorted(r["count"] for r in counts)
    assert len(sizes) >= 15 and sizes[-1] < 3 * sizes[len(sizes) // 2]


def test_text_segments_of_nothing(spark):
    segments = text_segments(spark.createDataFrame([], "k string, t string"), ["k"], "t", "out")
    assert segments.count() == 0 and text_of_segments(segments, ["k"], "out").count() == 0


@pytest.mark.parametrize("query, name", [(storage.staged_roundtrip, "documents"), (storage.document_files, "conversations")])
def test_staged_rows_go_to_as_many_tasks_as_they_fill(spark, tmp_path, monkeypatch, query, name):
    """With three tasks whatever the size, one of them would read a third of the table."""
    text = F.concat(*[F.sha2(F.concat("id", F.lit(f" {i}")), 512) for i in range(10)]).alias("text")
    rows = spark.range(0, 4000, 1, 8).select(F.col("id").alias("doc_id"), F.col("id").alias("conv_id"), F.lit(0).cast("bigint").alias("turn"), F.lit("user").alias("role"), F.lit("en").alias("lang"), text)
    rows.write.parquet(str(tmp_path / f"{name}.parquet"))
    paths = []
    monkeypatch.setattr(storage, f"write_{'staged' if name == 'documents' else name.replace('conversations', 'documents')}", lambda df, path, *rest: (paths.append(path), df.write.json(path)))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        assert query(spark, str(tmp_path)).count() == 4000
        assert len(spark.read.json(paths[0]).inputFiles()) > 10
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
