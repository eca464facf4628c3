"""Moving a sharded table into shards of new capacities with the fewest bytes moved."""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import unused

#: Blocks that an old shard is counted in; the driver sees one number for each block.
BLOCKS = 256


def transfers(sizes: list[int], capacities: list[int]) -> dict[tuple[int, int], int]:
    """Bytes to put from each old shard into each new one: a flow of minimum cost.

    Shard i stays shard i; a byte that stays costs nothing and one that moves costs one. What moves goes by way
    of a hub, so the network has a few arcs for each shard and none for each pair. Flow is sent along all
    cheapest paths of the residual network at once, until all bytes are placed. What the shards give to
    the hub is then dealt out to those that take from it. Raises ValueError if the capacities are too small.
    """
    if sum(capacities) < sum(sizes):
        raise ValueError("the new shards hold less than the old ones")
    old, new = len(sizes), len(capacities)
    hub, start, end = old + new, old + new + 1, old + new + 2
    # The arcs in pairs, each followed by its reverse; an arc's flow is the room of its reverse.
    to: list[int] = []
    room: list[int] = []
    price: list[int] = []
    leaving: list[list[int]] = [[] for _ in range(end + 1)]

    def arc(a: int, b: int, amount: int, cost: int) -> int:
        for x, y, left, c in ((a, b, amount, cost), (b, a, 0, -cost)):
            leaving[x].append(len(to))
            to.append(y)
            room.append(left)
            price.append(c)
        return len(to) - 1

    for i, amount in enumerate(sizes):
        arc(start, i, amount, 0)
    stays = [arc(i, old + i, sizes[i], 0) for i in range(min(old, new))]
    gives = [arc(i, hub, sizes[i], 1) for i in range(old)]
    takes = [arc(hub, old + j, capacities[j], 0) for j in range(new)]
    for j, amount in enumerate(capacities):
        arc(old + j, end, amount, 0)

    while True:
        distance, queue = {start: 0}, deque([start])
        while queue:
            a = queue.popleft()
            for e in leaving[a]:
                if room[e] and distance[a] + price[e] < distance.get(to[e], end):
                    distance[to[e]] = distance[a] + price[e]
                    queue.append(to[e])
        if end not in distance:
            break
        # A walk in depth over arcs of cheapest paths; each node goes on where it stopped.
        tried, path, node, walked = [0] * (end + 1), [], start, {start}
        while True:
            if node == end:
                amount = min(room[e] for e in path)
                for e in path:
                    room[e] -= amount
                    room[e ^ 1] += amount
                path, node, walked = [], start, {start}
            arcs = leaving[node]
            while tried[node] < len(arcs):
                e = arcs[tried[node]]
                if room[e] and to[e] not in walked and distance.get(to[e]) == distance[node] + price[e]:
                    break
                tried[node] += 1
            if tried[node] < len(arcs):
                path.append(e)
                node = to[e]
                walked.add(node)
            elif path:
                walked.discard(node)
                node = to[path.pop() ^ 1]
                tried[node] += 1
            else:
                break
    flow = {(i, i): room[e] for i, e in enumerate(stays) if room[e]}
    given = [[i, room[e]] for i, e in enumerate(gives) if room[e]]
    for j, e in enumerate(takes):
        wanted = room[e]
        while wanted:
            i, left = given[-1]
            amount = min(left, wanted)
            flow[i, j] = flow.get((i, j), 0) + amount
            wanted -= amount
            given[-1][1] -= amount
            if left == amount:
                given.pop()
    return flow


@dataclass(frozen=True)
class Plan:
    """Where rows go: per old shard the new shards in order, and the row keys at which they change."""

    cuts: dict[int, list[tuple[int, int]]]
    flow: dict[tuple[int, int], int]
    shards: int

    def moved(self) -> int:
        return sum(amount for (i, j), amount in self.flow.items() if i != j)

    def affected(self, old_shards: int) -> list[int]:
        """New shards whose files change: they lose or gain rows, or did not exist."""
        changed = {k for i, j in self.flow if i != j for k in (i, j)} | set(range(old_shards, self.shards))
        return sorted(k for k in changed if k < self.shards)

    def place(self, rows: DataFrame, old: str, key: str) -> DataFrame:
        """``rows`` with their new ``shard``, from the columns ``old`` (the old shard) and ``key`` alone."""
        pieces = []
        for i, steps in self.cuts.items():
            low = None
            for bound, shard in steps[:-1]:
                pieces.append((i, low, bound, shard))
                low = bound if low is None else max(low, bound)
            pieces.append((i, low, None, steps[-1][1]))
        rows = rows.drop("shard")
        of, low, high = (unused(rows, name) for name in ("_of", "_low", "_high"))
        # A row for each shard and each transfer, of which there are no more than old and new shards together.
        cuts = rows.sparkSession.createDataFrame(pieces, f"{of} int, {low} bigint, {high} bigint, shard int")
        held = (F.col(old) == F.col(of)) & (F.col(low).isNull() | (F.col(key) >= F.col(low))) & (F.col(high).isNull() | (F.col(key) < F.col(high)))
        return rows.join(F.broadcast(cuts), held, "left").drop(of, low, high)


def even_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (j < total % shards) for j in range(shards)]


def _block(key: Column, blocks: int) -> Column:
    """Blocks in the order of the key, which is an evenly spread bigint; ``blocks`` is a power of two."""
    return (F.shiftright(key, 65 - blocks.bit_length()) + blocks // 2).cast("int")


def plan(rows: DataFrame, old_shards: int, capacities: list[int] | None, new_shards: int, blocks: int = BLOCKS) -> Plan:
    """Plan the transfers of ``rows (old, key, size)``; ``key`` orders an old shard's rows evenly.

    The driver gets a size for each block of an old shard (``old_shards * blocks`` numbers) and one
    key for each place where an old shard is cut. A cut falls between rows: a shard's size is off
    its capacity by less than the size of the largest row for each cut, and rows with equal keys stay
    together. Without rows the plan is empty.
    """
    block = _block(F.col("key"), blocks)
    totals: dict[int, dict[int, int]] = {i: {} for i in range(old_shards)}
    for i, b, size in rows.groupBy("old", block.alias("block")).agg(F.sum("size").alias("size")).collect():
        totals[i][b] = size
    sizes = [sum(totals[i].values()) for i in range(old_shards)]
    flow = transfers(sizes, capacities or even_capacities(sum(sizes), new_shards))

    cuts: dict[int, list[tuple[int, int]]] = {}
    inside: list[tuple[int, int, int, int]] = []
    for i in range(old_shards):
        targets = sorted((j for a, j in flow if a == i), key=lambda j: (j != i, j))
        cuts[i] = [(0, j) for j in targets] or [(0, i % new_shards)]
        reach = 0
        for n, j in enumerate(targets[:-1]):
            reach += flow[i, j]
            before = 0
            for b in sorted(totals[i]):
                if before + totals[i][b] > reach or b == max(totals[i]):
                    inside.append((i, n, b, reach - before))
                    break
                before += totals[i][b]
    if inside:
        cut_rows = rows.sparkSession.createDataFrame(inside, "old int, cut int, block int, reach bigint")
        # A row for each transfer.
        cut_blocks = rows.withColumn("block", block).join(F.broadcast(cut_rows), ["old", "block"])
        # Equal keys cannot be parted; sums by key come first, so a key held by very many rows is one row.
        keys = cut_blocks.groupBy("old", "cut", "reach", "key").agg(F.sum("size").alias("size"))
        order = Window.partitionBy("old", "cut").orderBy("key")
        upto = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        # A row goes to the side on which more of it lies.
        middle = keys.withColumn("middle", upto - F.col("size") / 2)
        beyond = F.col("middle") > F.col("reach")
        found = middle.groupBy("old", "cut").agg(F.min(F.when(beyond, F.col("key"))).alias("first"), F.max("key").alias("last"))
        for i, n, first, last in found.collect():
            bound = first if first is not None else last + 1
            cuts[i][n] = (bound, cuts[i][n][1])
    return Plan(cuts, flow, new_shards)


def reshard(
    docs: DataFrame,
    old: Column,
    old_shards: int,
    new_shards: int,
    size: Column,
    identity: list[Column],
    capacities: list[int] | None = None,
    path: str | None = None,
) -> tuple[DataFrame, Plan]:
    """``docs`` with its new ``shard`` and ``shard_key``, and the plan that moved it.

    ``old`` is a row's old shard (0 to ``old_shards - 1``), ``size`` its bytes and ``identity`` what
    tells rows apart; without ``capacities`` the new shards get equal sizes. The files of all affected
    shards are written anew under ``path`` (one folder for each shard) and reread; rows of other shards
    come from ``docs`` itself. Rows that are equal in ``identity`` go together. Columns of ``docs`` called
    ``shard`` or ``shard_key`` are replaced. An empty table gives no rows.
    """
    old_name, key_name = unused(docs, "_old"), "shard_key"
    keyed = docs.withColumns({old_name: old.cast("int"), key_name: F.xxhash64(*identity)})
    rows = keyed.select(F.col(old_name).alias("old"), F.col(key_name).alias("key"), size.cast("bigint").alias("size"))
    made = plan(rows, old_shards, capacities, new_shards)
    placed = made.place(keyed, old_name, key_name).drop(old_name)
    affected = made.affected(old_shards)
    if not affected:
        return placed, made
    path = path or scratch_path(docs.sparkSession, "shards")
    changed = placed.where(F.col("shard").isin(affected))
    # Rows of a shard come together in files of a moderate size; a large shard has several.
    changed.hint("rebalance", "shard").write.partitionBy("shard").option("compression", "zstd").parquet(path)
    stored = docs.sparkSession.read.schema(placed.schema).parquet(path)
    return placed.where(~F.col("shard").isin(affected)).unionByName(stored), made


def with_slot(rows: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """``rows`` with ``slot``: their place in ``shard`` by ``shard_key``, from 0 and without gaps.

    Rows are numbered inside blocks of a shard, after the rows of the blocks before; no task sorts a
    whole shard. A column called ``slot`` is replaced, and left out of the order among equal keys.
    """
    part, many, start = (unused(rows, name) for name in ("_block", "_n", "_start"))
    numbered = rows.withColumn(part, _block(F.col("shard_key"), blocks))
    sizes = numbered.groupBy("shard", part).agg(F.count(F.lit(1)).alias(many))
    before = Window.partitionBy("shard").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", part, F.coalesce(F.sum(many).over(before), F.lit(0)).alias(start))
    order = Window.partitionBy("shard", part).orderBy("shard_key", *[c for c in rows.columns if c not in ("shard", "shard_key", "slot")])
    # One row for each block of a shard, so its size is bounded by shards * blocks.
    joined = numbered.join(F.broadcast(starts), ["shard", part])
    return joined.withColumn("slot", F.col(start) + F.row_number().over(order) - 1).drop(part, start)
