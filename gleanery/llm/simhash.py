"""Near-duplicate documents by SimHash fingerprints that differ in few bits."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import shuffled, spread
from .common import unused, written
from .components import components

SEED = 42
#: Shingles turned into bits at a time.
BLOCK = 1 << 15
#: Bits of two fingerprints of a link that differ, at most. The searches below meet halfway, one step from either end.
MAX_BITS = 2
#: Parts of a fingerprint whose bits are counted.
SEGMENTS = 16
#: A cell with more fingerprints is searched by common centres instead of by pairs.
PAIRED_ROWS = 16


def simhash(text: str | None, words_per_shingle: int = 3) -> int:
    """The 64-bit fingerprint: a bit is 1 if it is set in over half the shingles' hashes.

    Shingles are runs of words of the text with A-Z lower-cased, repeats included; a text of fewer
    words is one shingle, one without words (or NULL) has fingerprint zero.
    """
    # bytes.lower() and bytes.split() know ASCII letters and the white space \x20 \x09-\x0D only.
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    width = min(words_per_shingle, len(words))
    shingles = map(b" ".join, zip(*(islice(words, i, None) for i in range(width))))
    counts, total = np.zeros(64, np.int64), 0
    while block := [xxhash.xxh64_intdigest(s, SEED) for s in islice(shingles, BLOCK)]:
        octets = np.array(block, dtype="<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(block)
    return int(np.packbits(counts * 2 > total, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", words_per_shingle: int = 3) -> DataFrame:
    """``docs`` without the text, plus ``fingerprint`` (its 64 bits as a signed bigint)."""

    def fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [simhash(t.as_py(), words_per_shingle) for t in batch.column(text)]
            column = pa.array(np.array(values, dtype=np.uint64).view(np.int64))
            kept = [i for i, name in enumerate(batch.schema.names) if name != text]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in kept] + [column], [batch.schema.names[i] for i in kept] + ["fingerprint"]
            )

    kept = [f for f in docs.schema.fields if f.name != text]
    return docs.mapInArrow(fingerprints, T.StructType([*kept, T.StructField("fingerprint", T.LongType())]))


def as_hex(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def _cells(segments: int) -> Column:
    """The grid cell of a fingerprint's bit counts by segment, and those one step away.

    A cell is one number with a digit for each segment. Fingerprints that differ in two bits have
    counts at a Manhattan distance of at most two, so there is a cell within one step of both.
    """
    bits = 64 // segments
    counts = [
        F.bit_count(F.shiftrightunsigned("fp", i * bits).bitwiseAND(F.lit((1 << bits) - 1).cast("bigint")))
        for i in range(segments)
    ]
    worth = [F.lit((bits + 1) ** i).cast("bigint") for i in range(segments)]
    home = sum((n * w for n, w in zip(counts, worth)), F.lit(0).cast("bigint"))
    down = [F.when(n > 0, -w) for n, w in zip(counts, worth)]
    up = [F.when(n < bits, w) for n, w in zip(counts, worth)]
    steps = F.array_compact(F.array(F.lit(0).cast("bigint"), *down, *up))
    return F.transform(steps, lambda step: F.col("home") + step), home


def links(fingerprints: DataFrame, segments: int = SEGMENTS, paired_rows: int = PAIRED_ROWS) -> DataFrame:
    """Links ``a, b`` between different values of ``fingerprints (fp)``, in at most ``MAX_BITS`` bits.

    Every pair that close is linked, directly or through fingerprints that are linked with both. A
    cell of the grid with few fingerprints compares its pairs. In a crowded one every fingerprint
    names itself and its 64 neighbours at one bit as centres: those with a centre in common differ
    in two bits at most, and two that differ in two bits have one in common. So all around a centre
    are linked with the least of them, and no pairs are formed. Neither cells nor centres are broadcast: there are
    33 and 65 of them for a fingerprint.
    """
    around, home = _cells(segments)
    cells = fingerprints.select("fp", home.alias("home")).select("fp", F.explode(around).alias("cell"))
    sizes = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = written(shuffled(cells).join(spread(sizes, "cell"), "cell"), "cells")
    few = shared.where(F.col("n") <= paired_rows)
    left = few.select("cell", F.col("fp").alias("a"))
    right = few.select("cell", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS
    pairs = shuffled(left).join(right, "cell").where((F.col("a") < F.col("b")) & near).select("a", "b")

    flips = F.array(F.lit(0).cast("bigint"), *[F.lit(1 << i if i < 63 else -(1 << 63)).cast("bigint") for i in range(64)])
    crowded = shared.where(F.col("n") > paired_rows).select("fp").distinct()
    centred = crowded.select("fp", F.explode(F.transform(flips, lambda x: F.col("fp").bitwiseXOR(x))).alias("centre"))
    least = centred.groupBy("centre").agg(F.min("fp").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    starred = shuffled(centred).join(spread(least, "centre"), "centre").where("fp <> least")
    return pairs.unionByName(starred.select(F.col("least").alias("a"), F.col("fp").alias("b"))).distinct()


def _classified(docs: DataFrame) -> DataFrame:
    """``docs (id, text, ...)`` without the text, plus ``fp, root, component_id``."""
    rows = written(with_fingerprint(docs).withColumnRenamed("fingerprint", "fp"), "fingerprints")
    groups = written(rows.groupBy("fp").agg(F.min("id").alias("first")), "groups")
    roots = components(links(groups.select("fp"))).withColumnRenamed("node", "fp")
    member = groups.join(shuffled(roots), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = member.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = member.join(spread(least, "root"), "root").select("fp", "root", "component_id")
    return rows.join(spread(classes, "fp"), "fp", "left")


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: its id, ``fingerprint`` (hex) and ``component_id``.

    A component holds the documents that links of fingerprints connect; its id is its smallest
    document id (NULL if none of its documents has one). NULL and empty texts have fingerprint zero and
    are linked like any other. Repeated rows are kept, each with its component. An empty table
    gives no rows. Other columns of ``docs`` are left out.
    """
    found = _classified(docs.select(F.col(id).alias("id"), F.col(text).alias("text")))
    return found.select(F.col("id").alias(id), as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the smallest id (NULL last).

    Of rows that are equal in id and text the one whose other columns are the least stays, written as JSON, so
    the result is the same in every run. All columns are returned.
    """
    content = F.xxhash64(text)
    found = _classified(docs.select(F.col(id).alias("id"), F.col(text).alias("text"), content.alias("content")))
    # Each task drops all of a component's rows but one before the shuffle.
    order = Window.partitionBy("root").orderBy(F.col("id").asc_nulls_last(), "content")
    kept = found.withColumn("rank", F.row_number().over(order)).where("rank = 1")
    key, value = unused(docs, "_content"), unused(docs, "_kept")
    kept = kept.select(F.col("id").alias(value), F.col("content").alias(key))
    rows = docs.withColumn(key, content)
    same = rows[id].eqNullSafe(kept[value]) & (rows[key] == kept[key])
    others = F.to_json(F.struct(F.lit(0).alias("_"), *[F.col(c) for c in docs.columns if c.lower() not in (id.lower(), text.lower())]))
    # Each task drops all repeats but one before the shuffle.
    place = unused(docs, "_place")
    first = F.row_number().over(Window.partitionBy(id, key).orderBy(others))
    return rows.join(kept, same, "left_semi").withColumn(place, first).where(F.col(place) == 1).drop(key, place)
