"""Text aggregates and counts."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.text import concat_skip_null
from ..session import shared_dir
from .skew import spread

#: Characters of a segment of a long text.
SEGMENT = 1 << 20
#: Bytes of a text that is put together: what readers of a row still can hold, and far below the 2 GB of a value.
CELL_BYTES = 1 << 29


def agg_text(df: DataFrame, by: list[str], col: str, out: str, sep: str = "; ", hot: bool = False) -> DataFrame:
    """Join the texts of each group, NULLs left out, repeats kept, in text order.

    Rows move once, by key. With ``hot``, for keys with very many rows, equal texts are counted first
    (combined map-side, then spread over tasks by key *and* text) and repeated only when the group's
    text is put together. A group of NULLs only gives NULL.
    """
    quoted = sep.replace("'", "''")
    if not hot:
        return df.groupBy(*by).agg(F.expr(f"listagg(`{col}`, '{quoted}') within group (order by `{col}`)").alias(out))
    counts = df.groupBy(*by, col).agg(F.count(F.lit(1)).alias("_n"))
    again = F.repeat(F.concat(F.lit(sep), F.col(col)), (F.col("_n") - 1).cast("int"))
    # Distinct texts cannot be combined any further, so they are moved by key as they are
    # instead of being put into partial lists first.
    runs = counts.withColumn("_run", F.concat(F.col(col), again)).repartition(*by)
    joined = F.expr(f"listagg(_run, '{quoted}') within group (order by `{col}`)")
    return runs.groupBy(*by).agg(joined.alias(out))


def text_segments(df: DataFrame, by: list[str], col: str, out: str, sep: str = "; ", size: int = SEGMENT, parts: int | None = None) -> DataFrame:
    """The text of ``agg_text`` in segments: ``by``, ``segment`` from 0, ``chars_before`` and ``out``; segments joined by ``sep`` are the whole.

    For keys of any size. Rows are dealt by ranges of key *and* text over ``parts`` tasks (the session's number of shuffle partitions
    without it), so a key with most rows is in many of them; each cuts its part of a key into segments of about ``size``
    characters, and only their lengths are brought together by key. A text that is there very often is several
    runs. A key of NULLs only has no segment.
    """
    shared_dir(df.sparkSession)
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.where(F.col(col).isNotNull()).groupBy(*by, F.col(col).alias("_text")).agg(F.count(F.lit(1)).alias("_n"))
    # Copies that one run of a text holds, so that no run is much longer than a segment.
    held = F.greatest(F.lit(1), F.floor(F.lit(size) / (F.length("_text") + len(sep)))).cast("bigint")
    runs = counts.withColumn("_held", held).withColumn("_run", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / F.col("_held")))))
    copies = F.least(F.col("_held"), F.col("_n") - F.col("_run") * F.col("_held")).cast("int")
    runs = runs.select(*by, "_text", "_run", copies.alias("_copies"))
    # Where the ranges end depends on a sample, so it must not be found anew after a lost executor.
    dealt = runs.repartitionByRange(parts, *by, "_text", "_run").withColumn("_part", F.spark_partition_id()).checkpoint()
    length = (F.length("_text") + len(sep)).cast("bigint") * F.col("_copies")
    before = Window.partitionBy("_part", *by).orderBy("_text", "_run").rowsBetween(Window.unboundedPreceding, -1)
    cut = dealt.withColumn("_cut", F.floor(F.coalesce(F.sum(length).over(before), F.lit(0)) / size))
    place = ["_part", *by, "_cut"]
    run = F.concat(F.col("_text"), F.repeat(F.concat(F.lit(sep), F.col("_text")), F.col("_copies") - 1))
    in_order = F.array_sort(F.collect_list(F.struct("_text", "_run", run.alias("_whole"))))
    texts = cut.groupBy(*place).agg(F.array_join(in_order["_whole"], sep).alias(out), F.sum(length).alias("_chars"))
    kept = texts.checkpoint()
    of_key = Window.partitionBy(*by).orderBy("_part", "_cut")
    so_far = F.coalesce(F.sum("_chars").over(of_key.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranks = kept.select(*place, "_chars").withColumns({"segment": F.row_number().over(of_key) - 1, "chars_before": so_far}).drop("_chars")
    ranks = ranks.select("segment", "chars_before", *[F.col(c).alias(f"_of{c}") for c in place])
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_of{c}")) for c in place])
    return kept.join(spread(ranks, "segment"), same).select(*by, "segment", "chars_before", out)


def text_of_segments(segments: DataFrame, by: list[str], out: str, sep: str = "; ", limit: int = CELL_BYTES) -> DataFrame:
    """One row for each key of ``text_segments``: ``segments``, ``bytes`` and the whole text, which is NULL beyond ``limit`` bytes.

    No value can be larger than Spark's 2 GB; the text of such a key is in its segments. They are not gathered.
    """
    sizes = segments.groupBy(*by).agg(F.count(F.lit(1)).alias("segments"), (F.sum(F.octet_length(out) + len(sep)) - len(sep)).alias("bytes"))
    small = sizes.where(F.col("bytes") <= limit).select(*[F.col(c).alias(f"_of{c}") for c in by])
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_of{c}")) for c in by])
    in_order = F.array_sort(F.collect_list(F.struct("segment", F.col(out).alias("_whole"))))
    whole = segments.join(small, same, "left_semi").groupBy(*by).agg(F.array_join(in_order["_whole"], sep).alias(out))
    whole = whole.select(out, *[F.col(c).alias(f"_of{c}") for c in by])
    return sizes.join(whole, same, "left").select(*by, "segments", "bytes", out)


def agg_codes(
    bridge: DataFrame, dictionary: DataFrame, on: Column, by: list[str], out: str, sep: str = "; "
) -> DataFrame:
    """Join ``code - title`` texts of the dictionary entries a bridge table points to."""
    text = concat_skip_null(F.col("code"), F.lit(" - "), F.col("title"))
    labelled = bridge.join(dictionary, on).select(*by, text.alias("_label"))
    return agg_text(labelled, by, "_label", out, sep)


def total_items(groups: Column) -> Column:
    """Number of items over all arrays of a map."""
    return F.aggregate(
        F.map_values(groups), F.lit(0).cast("bigint"), lambda acc, items: acc + F.size(items)
    )


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The rows plus an observation whose ``rows`` is their number once they were written."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
