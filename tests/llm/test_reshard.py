import itertools
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gleanery.checks.base import table
from gleanery.llm import reshard
from gleanery.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def fewest(sizes, capacities):
    """Bytes that must move, by trying which shard keeps how many in whole units."""
    options = [range(min(s, capacities[i]) + 1) if i < len(capacities) else [0] for i, s in enumerate(sizes)]
    best = None
    for kept in itertools.product(*options):
        room = sum(capacities) - sum(kept)
        moved = sum(sizes) - sum(kept)
        if moved <= room and (best is None or moved < best):
            best = moved
    return best


def test_flow_moves_the_fewest_bytes():
    rng = random.Random(1)
    for _ in range(60):
        sizes = [rng.randrange(6) for _ in range(rng.randrange(1, 5))]
        new = rng.randrange(1, 5)
        capacities = [rng.randrange(6) for _ in range(new)]
        capacities[0] += max(0, sum(sizes) - sum(capacities))
        flow = reshard.transfers(sizes, capacities)
        for i, size in enumerate(sizes):
            assert sum(n for (a, _), n in flow.items() if a == i) == size
        for j, room in enumerate(capacities):
            assert sum(n for (_, b), n in flow.items() if b == j) <= room
        assert sum(n for (a, b), n in flow.items() if a != b) == fewest(sizes, capacities)
    with pytest.raises(ValueError):
        reshard.transfers([5], [4])


def test_flow_of_very_many_shards():
    """Few transfers, and the bytes that cannot stay are those that move."""
    rng = random.Random(2)
    sizes = [rng.randrange(10**9) for _ in range(4000)]
    for new in (3000, 4000, 5000):
        capacities = reshard.even_capacities(sum(sizes), new)
        flow = reshard.transfers(sizes, capacities)
        assert len(flow) <= 2 * (len(sizes) + new) and all(n > 0 for n in flow.values())
        out, into = defaultdict(int), defaultdict(int)
        for (i, j), n in flow.items():
            out[i] += n
            into[j] += n
        assert [out[i] for i in range(len(sizes))] == sizes and [into[j] for j in range(new)] == capacities
        stay = sum(min(a, b) for a, b in zip(sizes, capacities))
        assert sum(n for (i, j), n in flow.items() if i != j) == sum(sizes) - stay


def test_query(spark):
    docs = {r.doc_id: r for r in table(spark, SF, "documents").collect()}
    rows = QUERIES["op8_min_cost_reshard"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    shards, old = defaultdict(list), defaultdict(int)
    for r in rows:
        data = (docs[r.doc_id].text or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 8, zlib.crc32(data), "bytes", None)
        shards[r.shard].append(r)
        old[zlib.crc32(docs[r.doc_id].source.encode()) % 24] += r["size"]
    assert sorted(shards) == list(range(24))
    assert all(sorted(r.slot for r in part) == list(range(len(part))) for part in shards.values())
    even = sum(old.values()) / 24
    largest = max(r["size"] for r in rows)
    assert all(abs(sum(r["size"] for r in part) - even) <= 2 * largest for part in shards.values())
    moved = sum(r["size"] for r in rows if r.shard != zlib.crc32(docs[r.doc_id].source.encode()) % 24)
    assert moved <= sum(max(0, old[i] - even) for i in range(24)) + 24 * largest


def test_shards_without_transfers_are_not_rewritten(spark, tmp_path):
    rows = spark.createDataFrame([(i, i % 4 if i < 400 else 3, "x" * 10) for i in range(600)], "doc_id bigint, old int, text string")
    path = str(tmp_path / "files")
    sharded, plan = reshard.reshard(
        rows, F.col("old"), 4, 4, F.lit(1), [F.col("doc_id")], capacities=[100, 100, 200, 200], path=path
    )
    assert plan.moved() == 100 and plan.affected(4) == [2, 3]
    assert sorted(p.name for p in (tmp_path / "files").iterdir() if p.name.startswith("shard")) == ["shard=2", "shard=3"]
    assert sorted((r.shard, r["count"]) for r in sharded.groupBy("shard").count().collect()) == [(0, 100), (1, 100), (2, 200), (3, 200)]
    assert sharded.where("old < 3 AND shard <> old").count() == 0


def test_nothing_to_do(spark):
    rows = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id bigint, old int")
    sharded, plan = reshard.reshard(rows, F.col("old"), 2, 2, F.lit(1), [F.col("doc_id")])
    assert plan.moved() == 0 and plan.affected(2) == [] and sharded.where("shard <> old").count() == 0


def test_odd_rows(spark, odd_docs, no_docs):
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 8
    for docs in (odd_docs, no_docs):
        sharded, _ = reshard.reshard(docs, F.lit(0), 1, 3, size, [F.col("doc_id"), F.col("text")])
        slots = reshard.with_slot(sharded.select("shard", "shard_key", "doc_id", "text")).collect()
        assert len(slots) == docs.count()
        by = defaultdict(list)
        for r in slots:
            by[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in by.values()) and set(by) <= {0, 1, 2}
        assert sharded.select(*docs.columns).exceptAll(docs).count() == 0


def test_slots_keep_given_columns(spark):
    rows = spark.range(50).selectExpr("id", "CAST(id % 3 AS INT) AS shard", "xxhash64(id) AS shard_key", "id AS _block", "id AS _n", "id AS _start", "'x' AS slot")
    found = reshard.with_slot(rows).collect()
    assert len(found) == 50 and all(r["_block"] == r["_n"] == r["_start"] == r["id"] for r in found)
    for shard in range(3):
        mine = sorted((r for r in found if r["shard"] == shard), key=lambda r: r["shard_key"])
        assert [r["slot"] for r in mine] == list(range(len(mine)))
