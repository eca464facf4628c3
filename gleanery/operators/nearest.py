"""Nearest dictionary entry by text similarity."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import Entries, fuzz_ratio, letter_counts, score_bounds
from ..session import scratch_path
from .skew import shuffled, spread

#: Entries of similar letters that lie in one block; also the bound on the arrays a task holds.
BLOCK = 256
#: Names that meet some blocks' outlines together, and blocks whose outlines are met together, about.
NAMES, OUTLINES = 256, 512
#: So many times ``NAMES`` go together where there are more groups than tasks, so that a block is read for fewer groups.
MORE = 16
#: Results that a task hands on together, about.
FOUND = 1 << 13
#: Stretches of these many characters that at most so many entries have lead to a first entry for a name.
STRETCHES, RARE = (3, 6), 64

_BEST = "score int, neg_id bigint, match_id bigint, match_title string, compared bigint"


def _blocks(entries: DataFrame, block: int) -> DataFrame:
    """The dictionary in blocks of entries of similar letters, each with an outline.

    Entries are ordered by length and then by their sorted letters. An outline is, for each class of
    characters, the most that any entry of the block has of it, and the least and most characters.
    """
    letters = F.array_join(F.array_sort(F.split("title", "")), "")
    tasks = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = entries.withColumns({"length": F.length("title"), "letters": letters})
    ordered = ordered.repartitionByRange(tasks, "length", "letters", "id").sortWithinPartitions("length", "letters", "id")

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, titles = [], []

        def one() -> pd.DataFrame:
            counts, lengths = letter_counts(titles), [len(t) for t in titles]
            row = ([*ids], [*titles], counts.max(axis=0).astype(np.int32), min(lengths), max(lengths))
            return pd.DataFrame([row], columns=["ids", "titles", "outline", "least", "most"])

        for batch in batches:
            for key, title in zip(batch["id"], batch["title"]):
                ids.append(key)
                titles.append(title)
                if len(ids) == block:
                    yield one()
                    ids.clear()
                    titles.clear()
        if ids:
            yield one()

    blocks = ordered.select("id", "title").mapInPandas(packed, "ids array<bigint>, titles array<string>, outline array<int>, least int, most int")
    # Written, since another run of the range partitioning could cut the blocks elsewhere.
    path = scratch_path(entries.sparkSession, "entries")
    blocks.withColumn("block", F.monotonically_increasing_id()).write.parquet(path)
    return entries.sparkSession.read.schema("ids array<bigint>, titles array<string>, outline array<int>, least int, most int, block bigint").parquet(path)


def _grouped(df: DataFrame, group: str, key: str, groups: int, columns: list[str]) -> DataFrame:
    """Some hundred rows in one, as parallel arrays."""
    listed = df.groupBy(F.pmod(F.xxhash64(key), F.lit(groups)).alias(group)).agg(F.collect_list(F.struct(*columns)).alias("_rows"))
    return listed.select(group, *[F.col(f"_rows.{c}").alias(f"{c}s") for c in columns])


def _outline_bounds(row) -> Iterator[tuple[int, np.ndarray]]:
    """The bounds of some hundred names of a row at a time in each of its outlines, and the place of the first name."""
    outlines, least, most = np.stack(row.outlines), np.asarray(row.leasts), np.asarray(row.mosts)
    for start in range(0, len(row.names), 256):
        names = row.names[start : start + 256]
        lengths = np.fromiter(map(len, names), np.int64, len(names))
        yield start, score_bounds(letter_counts(names), lengths, outlines, least, most)


def _first_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of the outlines in a row, the one where each name may score most."""
    for batch in batches:
        for row in batch.itertuples(index=False):
            blocks = np.asarray(row.blocks)
            for start, bounds in _outline_bounds(row):
                at = bounds.argmax(axis=1)
                yield pd.DataFrame({"name": row.names[start : start + 256], "bound": bounds.max(axis=1), "block": blocks[at]})


def _open_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each of the outlines in a row the names that may do better there than they did in their first block."""
    for batch in batches:
        for row in batch.itertuples(index=False):
            blocks, names = np.asarray(row.blocks), np.asarray(row.names, object)
            scores, neg_ids, firsts = np.asarray(row.scores), np.asarray(row.neg_ids), np.asarray(row.firsts)
            # A tie may still be won by a lower id.
            found = [
                (bounds >= scores[s : s + 256, None]) & (blocks[None, :] != firsts[s : s + 256, None]) for s, bounds in _outline_bounds(row)
            ]
            met = np.concatenate(found)
            at = [np.flatnonzero(column) for column in met.T]
            opened = [(int(b), names[a], scores[a], neg_ids[a]) for b, a in zip(blocks, at) if len(a)]
            yield pd.DataFrame(opened, columns=["block", "names", "scores", "neg_ids"])


def _compared(listed: DataFrame, blocks: DataFrame, held: int, known: bool) -> DataFrame:
    """The best entry of a block for the ``names`` of a row that meet it, if it wins over what is ``known`` of the name.

    ``held`` is the number of blocks. Names for whom no entry was compared are left out if something is known of them.
    """

    columns = {"name": "str", "block": "Int64", "score": "Int32", "neg_id": "Int64", "match_id": "Int64", "match_title": "str", "compared": "Int64"}

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = []

        def taken() -> pd.DataFrame:
            rows = pd.DataFrame(found, columns=[*columns]).astype({c: t for c, t in columns.items() if t != "str"})
            found.clear()
            return rows

        for batch in batches:
            for row in batch.itertuples(index=False):
                winners = Entries(row.ids, row.titles).best(row.names, (row.scores, row.neg_ids) if known else None)
                found += [
                    (name, int(row.block), *(winner or (None, None, None, None)), compared)
                    for name, (winner, compared) in zip(row.names, winners)
                    if compared or not known
                ]
                if len(found) >= FOUND:
                    yield taken()
        yield taken()

    # Few bytes but much work per row: a fixed number of tasks, which Spark does not merge by size. Where blocks are few, each goes
    # to several tasks.
    tasks = int(listed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = max(1, -(-2 * tasks // max(held, 1)))
    met = listed.withColumn("salt", F.pmod(F.xxhash64(F.col("names")[0]), F.lit(salts)).cast("int")).repartition(tasks, "block", "salt")
    copies = blocks.select("block", "ids", "titles", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    return met.join(copies.repartition(tasks, "block", "salt"), ["block", "salt"]).mapInPandas(best, f"name string, block bigint, {_BEST}")


def _stretches(df: DataFrame, text: str, key: str) -> DataFrame:
    """The different stretches of each text, by their hashes; some dozen rows for each of ``df``, which Spark takes for one."""

    def of(size: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(text) - (size - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.xxhash64(F.substring(F.col(text), i, F.lit(size))))

    return df.select(key, F.explode(F.array_distinct(F.concat(*map(of, STRETCHES)))).alias("stretch"))


def _seeds(names: DataFrame, entries: DataFrame) -> DataFrame:
    """For names that share rare stretches with entries: the entry with most of them, compared.

    Only where a search starts, so that common stretches need not lead anywhere.
    """
    held = _stretches(entries, "title", "id")
    rare = held.groupBy("stretch").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= RARE)
    leads = shuffled(held).join(spread(rare.select("stretch"), "stretch"), "stretch")
    shared = shuffled(_stretches(names, "name", "name")).join(leads, "stretch").groupBy("name", "id").agg(F.count(F.lit(1)).alias("n"))
    first = shared.groupBy("name").agg(F.max_by("id", F.struct("n", -F.col("id"))).alias("id"))
    titles = entries.groupBy("id").agg(F.min("title").alias("title"))
    scored = first.join(shuffled(titles), "id").withColumn("score", fuzz_ratio(F.col("name"), F.col("title")))
    return scored.select(
        "name", F.lit(-1).cast("bigint").alias("block"), "score", (-F.col("id")).alias("neg_id"), F.col("id").alias("match_id"),
        F.col("title").alias("match_title"), F.lit(1).cast("bigint").alias("compared"),
    )


def _best_of(score: Column) -> Column:
    """What ``max`` merges; NULL, which it passes over, for a block without a winner."""
    return F.when(score.isNotNull(), F.struct("score", "neg_id", "match_id", "match_title"))


def _searched(names: DataFrame, entries: DataFrame, block: int) -> DataFrame:
    """``name, best`` and how many entries the name was ``compared`` with, for distinct names."""
    blocks = _blocks(entries, block)
    held, size = blocks.count(), names.count()
    tasks = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Groups of many names where these still make some for each task.
    parts = max(1, -(-size // (NAMES * MORE)), min(tasks, -(-size // NAMES)))

    def listed(met: DataFrame) -> DataFrame:
        """Names of one block in groups, so that a block's entries are counted once for some hundred names."""
        salted = met.withColumn("part", F.pmod(F.xxhash64("name"), F.lit(parts)))
        return salted.groupBy("block", "part").agg(F.collect_list("name").alias("names")).select("block", "names")

    if held < 2:
        only = blocks.select("block").first()
        met = names.select("name", F.lit(only["block"] if only else 0).alias("block"))
        return _compared(listed(met), blocks, held, known=False).select("name", _best_of(F.col("score")).alias("best"), "compared")
    groups = -(-held // OUTLINES)
    outlined = _grouped(blocks, "outline_group", "block", groups, ["block", "outline", "least", "most"])

    def meetings(rows: DataFrame, columns: list[str]) -> DataFrame:
        grouped = _grouped(rows, "name_group", "name", parts, columns)
        met = grouped.withColumn("outline_group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<bigint>")))
        # Much work per row here too.
        return shuffled(met).join(outlined, "outline_group").repartition(tasks, "name_group", "outline_group")

    path = scratch_path(names.sparkSession, "seeds")
    _seeds(names, entries).write.parquet(path)
    seeds = names.sparkSession.read.schema(f"name string, block bigint, {_BEST}").parquet(path)
    led = names.join(shuffled(seeds.select("name")), "name", "left_anti")
    first = meetings(led, ["name"]).mapInPandas(_first_blocks, "name string, bound int, block bigint")
    if groups > 1:
        first = first.groupBy("name").agg(F.max_by("block", F.struct("bound", "block")).alias("block"))
    path = scratch_path(names.sparkSession, "first")
    _compared(listed(first.select("name", "block")), blocks, held, known=False).unionByName(seeds).write.parquet(path)
    started = names.sparkSession.read.schema(f"name string, block bigint, {_BEST}").parquet(path)
    rest = meetings(started.withColumnRenamed("block", "first"), ["name", "score", "neg_id", "first"])
    rest = rest.mapInPandas(_open_blocks, "block bigint, names array<string>, scores array<int>, neg_ids array<bigint>")
    later = _compared(rest, blocks, held, known=True)
    both = started.unionByName(later).groupBy("name")
    return both.agg(F.max(_best_of(F.col("score"))).alias("best"), F.sum("compared").alias("compared"))


def nearest_name(
    names: DataFrame,
    name: str,
    dictionary: DataFrame,
    min_score: int | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """For each distinct name the most similar entry of ``dictionary (id, title)``.

    Returns ``name, match_id, match_title, score``; on a tie the lowest id wins. There is no
    threshold unless ``min_score`` is given. Call it for the names of a dictionary or for the
    distinct names of a fact table and join the result back by name.

    A name that is itself a title is settled by an equi join. For the others the dictionary is cut into
    blocks of entries of similar letters. What a name can score in a block is bounded by the block's
    outline: counts of characters, which a common subsequence cannot exceed. Each name is compared first with an
    entry that shares rare stretches with it, or else with the block of its highest bound, and then with those
    blocks alone whose bound reaches the score found; within a block it stops at the entry whose own bound does
    not. So the result is that of all pairs, and few pairs are compared.
    """
    entries = dictionary.where("title IS NOT NULL").select(F.col("id").cast("bigint").alias("id"), "title")
    distinct = names.select(F.col(name).alias("name")).where("name IS NOT NULL").distinct()

    # A different text reaches 100 only by rounding, from 100 characters on, so an equal one wins.
    equal = entries.where("title <> ''").groupBy("title").agg(F.min("id").alias("equal_id"))
    split = distinct.join(shuffled(equal), F.col("name") == F.col("title"), "left")
    settled = F.col("equal_id").isNotNull()
    exact = split.where(settled).select("name", F.col("equal_id").alias("match_id"), F.col("title").alias("match_title"), F.lit(100).alias("score"))
    found = _searched(split.where(~settled).select("name"), entries, block)
    result = exact.unionByName(found.select("name", "best.match_id", "best.match_title", "best.score"))
    return result if min_score is None else result.where(F.col("score") >= min_score)
