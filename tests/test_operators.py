import datetime as dt
import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from gleanery import operators as op
from gleanery.functions import similarity
from gleanery.operators import nearest
from gleanery.operators.export import CSV_OPTIONS

from .test_functions import brute_ratio

T1, T2, NOW = dt.datetime(2023, 1, 1), dt.datetime(2023, 2, 1), dt.datetime(2023, 3, 1)
HISTORY = "id int, key string, created_at timestamp_ntz, updated_at timestamp_ntz, deleted_at timestamp_ntz"


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=repr)


@pytest.fixture
def table(spark):
    return spark.createDataFrame([(1, "a", T1, None, None), (2, "b", T1, T2, T2), (3, "c", T1, T1, None)], HISTORY)


@pytest.fixture
def batch(spark):
    return spark.createDataFrame([(4, "a", NOW), (5, "b", NOW), (6, "d", NOW), (7, "d", NOW)], "id int, key string, created_at timestamp_ntz")


def test_insert_ignore(table, batch):
    state = op.insert_ignore(table, batch, "key", F.col("id"))
    assert [r.id for r in state.orderBy("id").collect()] == [1, 2, 3, 6]
    again = op.insert_ignore(state, batch, "key", F.col("id"))
    assert rows(again) == rows(state)


def test_snapshot_replace(table, batch):
    state = op.snapshot_replace(table, batch, NOW)
    assert rows(state, "id", "updated_at", "deleted_at") == rows(
        table.sparkSession.createDataFrame(
            [(1, NOW, NOW), (2, T2, T2), (3, NOW, NOW)] + [(i, None, None) for i in (4, 5, 6, 7)],
            "id int, updated_at timestamp_ntz, deleted_at timestamp_ntz",
        )
    )


@pytest.mark.parametrize("only_live", [False, True])
def test_keyed_replace(table, batch, only_live):
    state = {r.id: r for r in op.keyed_replace(table, batch, "key", NOW, only_live).collect()}
    assert state[1].deleted_at == state[1].updated_at == NOW
    assert state[2].deleted_at == (T2 if only_live else NOW)
    assert (state[3].updated_at, state[3].deleted_at) == (T1, None)
    assert all(state[i].deleted_at is None for i in (4, 5, 6, 7)) and len(state) == 7


def test_replace_with_empty_batch_is_a_no_op(table, batch):
    assert rows(op.keyed_replace(table, batch.limit(0), "key", NOW)) == rows(table)
    assert rows(op.insert_ignore(table, batch.limit(0), "key", F.col("id"))) == rows(table)


def test_append_rows_repeats(table):
    assert op.append_rows(table, table).count() == 6


def test_split_parent_child(spark):
    docs = spark.createDataFrame(
        [("x", [("s1",), ("s1",)], [1, 2]), ("y", [], None)], "key string, skills array<struct<title: string>>, codes array<int>"
    )
    parents, children = op.split_parent_child(docs, ["key"], {"skills": ["title"], "codes": ["code"]}, "parent_id")
    ids = {r.key: r.id for r in parents.collect()}
    assert parents.columns == ["key", "id"] and set(ids) == {"x", "y"}
    assert rows(children["skills"], "parent_id", "title") == [(ids["x"], "s1")] * 2
    assert rows(children["codes"], "parent_id", "code") == [(ids["x"], 1), (ids["x"], 2)]


def test_not_yet_stored(spark):
    stored = spark.createDataFrame([(1, "a"), (9, "z")], "pid int, t string")
    fresh = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "pid int, t string")
    assert rows(op.not_yet_stored(stored, fresh, "pid"), "pid", "t") == [(2, "b"), (2, "c")]


def test_latest_per_key(spark):
    rates = spark.createDataFrame(
        [(1, "USD", "2023-03-01", 70.0), (2, "USD", "2023-03-02", 75.5), (3, "USD", "2023-03-02", 75.0), (4, "EUR", None, 1.0), (5, "EUR", "2023-03-02", 2.0)],
        "id int, code string, day string, value double",
    )
    newest = op.latest_per_key(rates, ["code"], F.col("day").desc_nulls_first(), F.col("id").desc())
    assert rows(newest, "code", "id") == [("EUR", 4), ("USD", 3)]


def test_agg_text(spark):
    data = [(1, "b"), (1, "a"), (1, "b"), (1, None), (2, None), (3, "x'y"), (3, "")]
    out = op.agg_text(spark.createDataFrame(data, "k int, t string"), ["k"], "t", "o")
    assert rows(out) == [(1, "a; b; b"), (2, None), (3, "; x'y")]


def test_agg_text_of_a_hot_key(spark):
    """A third of all rows in one key, in many equal texts."""
    data = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), (F.col("id") % 7).cast("string").alias("t")
    )
    hot = op.agg_text(data, ["k"], "t", "o", sep=",").where("k = -1").first().o
    assert hot == ",".join(sorted(str(i % 7) for i in range(0, 30000, 3)))


def test_agg_codes(spark):
    bridge = spark.createDataFrame([(1, 10), (1, 11), (2, 10), (3, 99)], "active_id int, oecd_id int")
    codes = spark.createDataFrame([(10, "1.02", "T"), (11, None, "T")], "id int, code string, title string")
    out = op.agg_codes(bridge, codes, F.col("oecd_id") == F.col("id"), ["active_id"], "oecd")
    assert rows(out) == [(1, " - T; 1.02 - T"), (2, "1.02 - T")]


def test_lookup_rejects_and_strict(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "z"), (3, "z"), (4, None)], "id int, code string")
    names = spark.createDataFrame([("a", "A"), ("b", "B")], "key string, title string")
    found, rejects = op.lookup(facts, names, "code", "key", {"title": "name"})
    assert rows(found, "id", "name") == [(1, "A"), (2, None), (3, None), (4, None)]
    assert rows(rejects) == [("z", 2)]
    strict, _ = op.lookup(facts, names, "code", "key", {"title": "name"}, strict=True)
    with pytest.raises(Exception, match="code not in the dictionary: z"):
        strict.collect()
    with pytest.raises(Exception, match="not in the dictionary"):
        strict.select("id").collect()
    good, _ = op.lookup(facts.where("id in (1, 4)"), names, "code", "key", {"title": "name"}, strict=True)
    assert rows(good, "id", "name") == [(1, "A"), (4, None)]


AREAS = [("113", None, "Россия"), ("2019", "113", "Московская область"), ("2079", "2019", "Химки"), ("1001", None, "Другие"), ("5", "1001", "Минск")]


def test_climb_to_top(spark):
    nodes = spark.createDataFrame(AREAS, "id string, parent_id string, name string")
    assert {r.id: r.top_name for r in op.climb_to_top(nodes, "Россия").collect()} == {
        "113": None,
        "2019": "Московская область",
        "2079": "Московская область",
        "1001": None,
        "5": None,
    }
    path = spark.createDataFrame([(str(i), str(i - 1) if i else None, f"N{i}") for i in range(40)], nodes.schema)
    assert {r.id: r.top_name for r in op.climb_to_top(path, "N0").collect()} == {str(i): "N1" if i else None for i in range(40)}
    cycle = spark.createDataFrame([("a", "b", "A"), ("b", "a", "B")], nodes.schema)
    with pytest.raises(ValueError, match="cycle"):
        op.climb_to_top(cycle, "Россия").collect()
    with pytest.raises(Exception, match="no node with id x"):
        op.climb_to_top(spark.createDataFrame([("a", "x", "A")], nodes.schema), "Россия").collect()


def test_nearest_name_keeps_the_wrong_winner(spark):
    names = spark.createDataFrame([("Республика Татарстан",), ("Москва",), (None,), ("Москва",)], "name string")
    regions = spark.createDataFrame(
        [(1, "Республика Башкортостан"), (2, "Республика Татарстан (Татарстан)"), (3, "Москва"), (4, "Москва")], "id int, title string"
    )
    best = op.nearest_name(names, "name", regions)
    assert rows(best) == [("Москва", 3, "Москва", 100), ("Республика Татарстан", 1, "Республика Башкортостан", 79)]
    assert rows(op.nearest_name(names, "name", regions, min_score=80), "name") == [("Москва",)]


@pytest.mark.parametrize("block, outlines", [(1, 4), (4, 3), (7, 512), (512, 512)])
def test_nearest_name_against_brute_force(spark, monkeypatch, block, outlines):
    """Blocks and groups of any size give the best of all pairs; some names are long, some letters share a class."""
    monkeypatch.setattr("gleanery.operators.nearest.OUTLINES", outlines)
    monkeypatch.setattr("gleanery.operators.nearest.NAMES", 9)
    draw = random.Random(3)
    word = lambda most: "".join(draw.choices("abcd!жЖ", k=draw.randint(0, most)))
    names = sorted({word(9) for _ in range(30)} | {word(80) for _ in range(4)})
    titles = [(i, word(12)) for i in range(25)]
    best = op.nearest_name(
        spark.createDataFrame([(n,) for n in names], "name string"), "name", spark.createDataFrame(titles, "id int, title string"), block=block
    )
    want = []
    for n in names:
        score, _, i, t = max((brute_ratio(n, t), -i, i, t) for i, t in titles)
        want.append((n, i, t, score))
    assert rows(best) == sorted(want, key=repr)


def test_nearest_name_broadcasts_no_exploded_side(spark, monkeypatch):
    """Spark takes the stretches of a text, and the groups of names that meet all outlines, for one row each."""
    monkeypatch.setattr("gleanery.operators.nearest.OUTLINES", 2)
    texts = [f"Customer#{i:09d} of {i % 25}" for i in range(400)]
    entries = spark.createDataFrame(list(enumerate(texts)), "id bigint, title string")
    names = spark.createDataFrame([(f"Supplier#{i * 7:09d} of {i % 25}",) for i in range(50)], "name string")
    for found, key, least in [(nearest._seeds(names, entries), "stretch", 2), (op.nearest_name(names, "name", entries, block=16), "outline_group", 1)]:
        assert found.count() <= 50 and found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count(f"SortMergeJoin [{key}#") >= least and f"BroadcastHashJoin [{key}#" not in plan


def test_nearest_name_compares_few_pairs(spark):
    draw = random.Random(5)
    syllables = ["ka", "ro", "min", "tel", "us", "bra", "ov", "sk", "en", "lu", "ti", "gor"]
    titles = [(i, " ".join("".join(draw.choices(syllables, k=4)) for _ in range(2))) for i in range(3000)]
    names = [t[:k] + t[k + 2 :] + "x" for _, t in draw.sample(titles, 150) for k in [draw.randrange(1, len(t) - 2)]]
    entries = spark.createDataFrame(titles, "id long, title string")
    found = nearest._searched(spark.createDataFrame([(n,) for n in set(names)], "name string"), entries, 64).collect()
    assert sum(r.compared for r in found) < 0.05 * len(found) * len(titles)
    for r in found:
        score, neg_id, title = max((brute_ratio(r.name, t), -i, t) for i, t in titles)
        assert (r.best.score, r.best.neg_id, r.best.match_title) == (score, neg_id, title)
    assert nearest._searched(spark.createDataFrame([("a",)], "name string"), entries.limit(0), 64).count() == 0


@pytest.mark.parametrize("known", [False, True])
def test_names_against_the_entries_of_a_block_at_once(known):
    """Names up to and beyond a machine word, equal titles, empty texts, characters that entries lack."""
    draw = random.Random(7)
    word = lambda most: "".join(draw.choices("ab!жЖ\U0001f600", k=draw.randint(0, most)))
    for size in (0, 1, 40):
        titles = [word(9) for _ in range(size)]
        ids = draw.sample(range(-50, 200), size)
        names = [word(9) for _ in range(50)] + ["", "xyz", word(64) * 7, "ab" * 32, "a" * 64, "a" * 65, "b" * 63]
        bars = [(draw.randint(0, 100), draw.randint(-200, 50)) for _ in names]
        found = similarity.Entries(ids, titles).best(names, tuple(zip(*bars)) if known else None)
        for name, bar, (winner, compared) in zip(names, bars, found, strict=True):
            want = max(((brute_ratio(name, t), -i, i, t) for i, t in zip(ids, titles)), default=None)
            assert winner == (None if want and known and want[:2] <= bar else want)
            assert compared <= size


def test_names_meet_an_open_block_together():
    """One row for a block and a group of names: a row for each name would be grouped once more, and each group given a copy of the block."""
    names, block = [f"name {i}" for i in range(600)], lambda title: similarity.letter_counts([title])[0].astype("int32")
    row = {"names": names, "scores": [50] * 600, "neg_ids": [-1] * 600, "firsts": [1] * 599 + [0], "blocks": [0, 1, 2]}
    row |= {"outlines": [block("name 0123456789"), block("name 1"), block("xyz")], "leasts": [6, 6, 3], "mosts": [8, 6, 3]}
    found = pd.concat(nearest._open_blocks(iter([pd.DataFrame([row])])))
    assert [(r.block, len(r.names)) for r in found.itertuples()] == [(0, 599), (1, 1)]
    assert [*found["names"].iloc[1]] == names[-1:]


def _by_loop(table, loads, only_live):
    """The loads one after the other, in plain Python."""
    state = [dict(r) for r in table]
    for at in sorted({r["created_at"] for r in loads}):
        batch = [r for r in loads if r["created_at"] == at]
        keys = {r["key"] for r in batch} - {None}
        for row in state:
            if row["key"] in keys and (row["deleted_at"] is None or not only_live):
                row |= {"updated_at": at, "deleted_at": at}
        state += [r | {"updated_at": None, "deleted_at": None} for r in batch]
    return sorted((tuple(r[c] for c in ("key", "n", "created_at", "updated_at", "deleted_at")) for r in state), key=repr)


@pytest.mark.parametrize("only_live", [False, True])
def test_keyed_replace_all(spark, only_live):
    """Many loads in one plan, with a key that is in most rows, repeated rows and NULL keys."""
    draw, day = random.Random(4), lambda d: datetime(2023, 1, 1) + timedelta(days=d)
    keys = ["hot"] * 5 + [f"k{i}" for i in range(6)] + [None]
    stored = [
        {"key": k, "n": n, "created_at": day(-9), "updated_at": None, "deleted_at": draw.choice([None, day(-3)])}
        for n, k in enumerate(draw.choices(keys, k=15))
    ]
    loads = [{"key": draw.choice(keys), "n": n, "created_at": day(draw.randrange(12))} for n in range(80)] + [{"key": "hot", "n": 0, "created_at": day(3)}] * 2
    schema = "key string, n int, created_at timestamp_ntz"
    table = spark.createDataFrame([tuple(r.values()) for r in stored], schema + ", updated_at timestamp_ntz, deleted_at timestamp_ntz")
    given = spark.createDataFrame([tuple(r.values()) for r in loads], schema)
    columns = ["key", "n", "created_at", "updated_at", "deleted_at"]
    found = op.keyed_replace_all(table, given, "key", only_live=only_live).select(*columns)
    assert sorted(map(tuple, found.collect()), key=repr) == _by_loop(stored, loads, only_live)
    # Loads one by one by the operator itself.
    state = table
    for at in sorted({r["created_at"] for r in loads}):
        state = op.keyed_replace(state, given.where(F.col("created_at") == F.lit(str(at)).cast("timestamp_ntz")), "key", at, only_live).checkpoint()
    assert sorted(map(tuple, state.select(*columns).collect()), key=repr) == _by_loop(stored, loads, only_live)
    same = op.keyed_replace_all(table, given.limit(0), "key", only_live=only_live)
    assert sorted(map(tuple, same.select(*columns).collect()), key=repr) == _by_loop(stored, [], only_live)


def test_paths_to_top(spark):
    schema = "id string, parent_id string, name string"
    nodes = [("r", None, "Root"), ("s", None, "Other"), *((f"n{i}", f"n{i - 1}" if i else "r", f"N{i}") for i in range(21)), ("t", "s", None)]
    found = {r.id: (r.path, r.depth) for r in op.paths_to_top(spark.createDataFrame(nodes, schema)).collect()}
    assert found["r"] == (["Root"], 1) and found["t"] == (["Other", None], 2)
    assert found["n20"] == (["Root"] + [f"N{i}" for i in range(21)], 22) and len(found) == 24
    assert op.paths_to_top(spark.createDataFrame([], schema)).count() == 0
    with pytest.raises(ValueError, match="cycle"):
        op.paths_to_top(spark.createDataFrame([("a", "b", "A"), ("b", "a", "B")], schema))
    with pytest.raises(Exception, match="no node with id x"):
        op.paths_to_top(spark.createDataFrame([("a", "x", "A")], schema)).collect()


def test_org_list_fetch_children(spark):
    bridge = spark.createDataFrame([(1, 10, "r1", None), (2, 11, "r2", T1), (3, 12, "r3", None)], "id int, university_id int, rosrid_id string, deleted_at timestamp_ntz")
    orgs = spark.createDataFrame([(10, "111", None), (11, "222", None), (12, "333", T1)], "id int, ogrn string, deleted_at timestamp_ntz")
    assert rows(op.org_list(bridge, orgs)) == [(10, 1, "r1", "111")]
    entries = spark.createDataFrame([(1, "u1"), (2, "u2"), (3, "u3")], "id int, url string")
    manifest = spark.createDataFrame([("u1", 404, "k0"), ("u1", 200, "k2"), ("u1", 200, "k1"), ("u2", 404, "k3")], "url string, status int, s3_key string")
    assert rows(op.with_fetch(entries, manifest), "id", "s3_key") == [(1, "k1"), (2, None), (3, None)]
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id int, a string")
    b = spark.createDataFrame([(1, "z")], "id int, b string")
    assert rows(op.with_children(entries.select("id"), a, b, on="id")) == [(1, "x", "z")]


def test_shapes(spark):
    lists = spark.createDataFrame(
        [(1, [("a", ("open",)), ("b", ("closed",))]), (2, [])], "hh_university_id int, lists_of_vacancies array<struct<id: string, type: struct<id: string>>>"
    )
    assert [(r[0], r.item.id) for r in op.open_items(lists).collect()] == [(1, "a")]
    sheet = spark.createDataFrame([("R1", 1)], "ID string, NumCode int")
    assert op.normalise_names(sheet, {"id": "currency_id", "numcode": "num_code"}, date="2023-03-02").columns == ["currency_id", "num_code", "date"]
    salary = spark.createDataFrame([((1.0, None, "USD", False),), (None,)], "salary struct<`from`: double, `to`: double, currency: string, gross: boolean>")
    assert rows(salary.select(*[c.alias(n) for n, c in op.salary_fields(F.col("salary")).items()])) == [(1.0, None, "RUR", False), (None,) * 4]
    maps = spark.createDataFrame([(1, {"rids": ["a", "b"], "nioktrs": []})], "id int, m map<string, array<string>>")
    assert rows(op.unnest_map(maps, "m")) == [(1, "rids", 0, "a"), (1, "rids", 1, "b")]
    assert maps.select(op.total_items(F.col("m"))).first()[0] == 2
    assert rows(op.unnest_entries(spark.createDataFrame([(1, ["a", "b"])], "id int, e array<string>"), "e")) == [(1, 0, "a"), (1, 1, "b")]


def test_row_index_and_csv(spark, tmp_path):
    texts = ["a|b", "line\nbreak", 'quo"te', " lead ", "", None]
    data = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    path = str(tmp_path / "out")
    op.export_csv(data.withColumn("deleted_at", F.lit(None)).transform(op.drop_audit), path, F.col("id").desc())
    back = spark.read.schema("row_index bigint, id int, text string").options(**CSV_OPTIONS, multiLine=True).csv(path)
    got = sorted(tuple(r) for r in back.collect())
    assert got == [(n, 5 - n, texts[5 - n] or None) for n in range(6)]


def test_row_index_over_many_partitions(spark):
    data = spark.range(0, 5000, 1, 13).select((5000 - F.col("id")).alias("v"))
    assert rows(op.with_row_index(data, F.col("v")).where("row_index <> v - 1")) == []


def test_refresh_and_counts(spark, tmp_path):
    done = []
    assert op.refresh_if_loaded(0, lambda: done.append(1)) is False and done == []
    assert op.refresh_if_loaded(2, lambda: done.append(1)) is True and done == [1]
    df, seen = op.counted(spark.range(7))
    df.write.parquet(str(tmp_path / "n"))
    assert seen.get["rows"] == 7


@pytest.mark.parametrize("partitions", ["1", "8"])
def test_results_do_not_depend_on_partitions_or_order(spark, table, batch, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        backwards = batch.repartition(3).orderBy(F.col("id").desc())
        assert rows(op.insert_ignore(table, backwards, "key", F.col("id")), "id") == [(1,), (2,), (3,), (6,)]
        text = op.agg_text(backwards, ["created_at"], "key", "o").first().o
        assert text == "a; b; d; d"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
