import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from gleanery.checks.base import table
from gleanery.llm import common, simhash
from gleanery.llm.components import components
from gleanery.llm.queries import QUERIES

from .conftest import Sets, bag

SF = "/root/testdata/sf0.001"


def fingerprint(text):
    """As stated, word by word and bit by bit."""
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [words[i : i + 3] for i in range(len(words) - 2)] if len(words) >= 3 else [words] if words else []
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reachable(fingerprints):
    """Smallest id by position, all pairs compared."""
    sets = Sets(range(len(fingerprints)))
    for i, (_, a) in enumerate(fingerprints):
        for j, (_, b) in enumerate(fingerprints[:i]):
            if (a ^ b).bit_count() <= 2:
                sets.join(i, j)
    least = {}
    for i, (doc, _) in enumerate(fingerprints):
        if doc is not None:
            least[sets.find(i)] = min(doc, least.get(sets.find(i), doc))
    return [least.get(sets.find(i)) for i in range(len(fingerprints))]


def test_query_against_all_pairs(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    prints = [(i, fingerprint(t)) for i, t in docs]
    want = [(i, f"{f:016x}", c) for (i, f), c in zip(prints, reachable(prints))]
    assert bag(QUERIES["op4_simhash_dedup"](spark, SF).collect()) == bag(want)


def test_odd_rows(spark, odd_docs, no_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    prints = [(i, simhash.simhash(t)) for i, t in docs]
    assert [f for _, f in prints][:8] == [fingerprint(t) for _, t in docs][:8]
    want = [(i, f"{f:016x}", c) for (i, f), c in zip(prints, reachable(prints))]
    assert bag(simhash.near_duplicates(odd_docs).collect()) == bag(want)
    assert simhash.near_duplicates(no_docs).count() == 0


def test_one_of_each(odd_docs, no_docs):
    kept = simhash.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    # An id with two texts is in two components, and has the smallest id of both; 5, 6 and a NULL text are like 4.
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids, key=str) == sorted([None, 1, 3, 4, 7, 8, 9, 10, 11, 11], key=str)
    assert simhash.one_of_each(no_docs).count() == 0


@pytest.mark.parametrize("paired_rows", [1, 4, 1000])
def test_links_connect_all_that_are_close(spark, paired_rows):
    """Crowded cells, searched by centres, and others, searched by pairs, connect the same."""
    rng = random.Random(paired_rows)
    values = {rng.getrandbits(64) for _ in range(40)}
    for base in list(values)[:6]:
        for _ in range(60):
            base ^= 1 << rng.randrange(64) if rng.random() < 0.6 else (1 << rng.randrange(64)) | (1 << rng.randrange(64))
            values.add(base)
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp bigint"), paired_rows=paired_rows)
    pairs = [(a % (1 << 64), b % (1 << 64)) for a, b in links.collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in pairs)
    got, want = Sets(values), Sets(values)
    for a, b in pairs:
        got.join(a, b)
    for a in values:
        for b in values:
            if a < b and (a ^ b).bit_count() <= 2:
                want.join(a, b)
    assert [got.find(v) for v in values] == [want.find(v) for v in values]


def test_components(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(300, 500)]
    links = [*chain, *star, *star, (3, 3), (None, 5), (6, None), (-9, 300)]
    random.Random(0).shuffle(links)
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {n: 100 for n in range(100, 161)} | {n: -9 for n in [-9, 7, *range(300, 500)]}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_plan_has_no_cross_join(spark):
    links = simhash.links(spark.range(3).select(F.col("id").alias("fp")))
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_no_exploded_side_is_broadcast(spark, monkeypatch):
    """Spark takes the cells, centres and edges of a few hundred fingerprints for small, whatever they explode to."""
    plans = []

    def kept(df):
        df.collect()
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    recorded = lambda df, label: common.written(kept(df), label)
    monkeypatch.setattr("gleanery.llm.simhash.written", recorded)
    monkeypatch.setattr("gleanery.llm.components.written", recorded)
    monkeypatch.setattr("gleanery.llm.components.SENT", 10)
    values = [(7 << place) + (1 << bit) for place in (28, 32, 36, 40) for bit in range(20)] + [7 << 50, (7 << 50) + 3]
    links = kept(simhash.links(spark.createDataFrame([(v,) for v in values], "fp bigint")))
    found = kept(components(links))
    assert found.select("root").distinct().count() == 5 and found.count() == len(values)
    assert sum("SortMergeJoin" in plan for plan in plans) >= 4 and not any("BroadcastHashJoin" in plan for plan in plans)


def test_of_rows_with_one_id_and_text_the_least_stays(spark):
    rows = [(1, "one two three four", source) for source in ("c", None, "b", "a", "b")] + [(None, None, "z"), (None, None, "y")]
    for parts in (1, 2, 5):
        docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(parts)
        kept = {(r.doc_id, r.source) for r in simhash.one_of_each(docs).collect()}
        assert kept == {(1, "a"), (None, "y")}
