"""Load semantics: each function returns rows of a table's next state and writes nothing.

Every table keeps its history: a deleted row stays, with ``deleted_at`` set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedupe import latest_per_key
from .skew import distinct_keys, spread


def append_rows(table: DataFrame, rows: DataFrame) -> DataFrame:
    return table.unionByName(rows, allowMissingColumns=True)


def new_rows(table: DataFrame, rows: DataFrame, key: str, *order: Column) -> DataFrame:
    """Rows whose key the table has never held; the first one per key in the given order.

    The stored keys that clash are found first. They are no more than the batch's keys, so the
    table's side, which holds the whole history, is read for its key column alone and moves
    over the network only when the batch is too big to broadcast. Neither side of the joins has
    a key twice.
    """
    first = latest_per_key(rows, [key], *order)
    clashes = table.select(key).join(rows.select(key).distinct(), key, "left_semi")
    return first.join(clashes, key, "left_anti").select(rows.columns)


def insert_ignore(table: DataFrame, rows: DataFrame, key: str, *order: Column) -> DataFrame:
    """The table plus the batch rows with a new key; soft-deleted rows block a key as well."""
    return append_rows(table, new_rows(table, rows, key, *order))


def _stamp(df: DataFrame, condition: Column, now) -> DataFrame:
    # As text, so that neither Python's nor the session's zone can move it.
    at = F.lit(str(now)).cast("timestamp_ntz")
    return df.withColumns(
        {c: F.when(condition, at).otherwise(F.col(c)) for c in ("updated_at", "deleted_at")}
    )


def snapshot_replace(table: DataFrame, rows: DataFrame, now) -> DataFrame:
    """Soft-delete all live rows, then add the batch: a narrow plan without a shuffle."""
    return append_rows(_stamp(table, F.col("deleted_at").isNull(), now), rows)


def keyed_replace(table: DataFrame, rows: DataFrame, key: str, now, only_live: bool = False) -> DataFrame:
    """Soft-delete the rows whose key is in the batch, then add the batch.

    Rows deleted earlier are stamped again unless ``only_live``.
    """
    keys = distinct_keys(rows, key).withColumnRenamed(key, "_key")
    marked = table.join(keys, F.col(key) == F.col("_key"), "left")
    hit = F.col("_key").isNotNull()
    if only_live:
        hit = hit & F.col("deleted_at").isNull()
    return append_rows(_stamp(marked, hit, now).drop("_key"), rows)


def keyed_replace_all(table: DataFrame, loads: DataFrame, key: str, at: str = "created_at", only_live: bool = False) -> DataFrame:
    """The table after many loads by ``keyed_replace``, one for each value of ``at`` in ``loads``, oldest first.

    All in one plan: the end of a row is the last later load that holds its key, since each of them stamps it
    again; with ``only_live`` it is the next one. Rows of ``loads`` are created by the load of their ``at``, stored
    rows before all of them. A key has one row with its loads, each once, put together before they are moved, so a key with
    most of the rows is as many times as there are loads. A NULL key is no key: such rows are never ended.
    """
    held = loads.where(F.col(key).isNotNull() & F.col(at).isNotNull()).select(F.col(key).alias("_key"), F.col(at).alias("_at"))
    ends = spread(held.groupBy("_key").agg(F.array_sort(F.collect_set("_at")).alias("_ats")), "_key")

    # The place is counted from one, so it is that of the next load, counted from zero.
    following = F.get("_ats", F.array_position("_ats", F.col(at)).cast("int"))
    end = following if only_live else F.when(F.array_max("_ats") > F.col(at), F.array_max("_ats"))
    fresh = loads.join(ends, F.col(key) == F.col("_key"), "left").withColumn("_end", F.when(F.col(at).isNotNull(), end))
    fresh = fresh.select(*[c for c in loads.columns if c not in ("deleted_at", "updated_at")], F.col("_end").alias("deleted_at"), F.col("_end").alias("updated_at"))

    stored = table.join(ends, F.col(key) == F.col("_key"), "left").withColumn("_end", F.array_min("_ats") if only_live else F.array_max("_ats"))
    hit = F.col("_end").isNotNull()
    if only_live:
        hit = hit & F.col("deleted_at").isNull()
    stamped = {c: F.when(hit, F.col("_end")).otherwise(F.col(c)) for c in ("updated_at", "deleted_at")}
    return append_rows(stored.withColumns(stamped).select(*table.columns), fresh)


def surrogate_key(*parts: str | Column) -> Column:
    """Id from the natural key: the same after a retry, with no counter shared by tasks.

    128 bits as hex digits: a collision is not to be expected at any size. Parts are delimited, and
    NULL is told apart from the empty text.
    """
    texts = [F.coalesce(F.concat(F.lit("="), F.col(p).cast("string") if isinstance(p, str) else p.cast("string")), F.lit("")) for p in parts]
    return F.md5(F.concat_ws("\x1f", *texts))


def not_yet_stored(table: DataFrame, children: DataFrame, parent_id: str) -> DataFrame:
    """Child rows of parents without stored children, so a load that is run again adds none twice."""
    stored = table.select(parent_id).join(distinct_keys(children, parent_id), parent_id, "left_semi")
    return children.join(distinct_keys(stored, parent_id), parent_id, "left_anti")


def split_parent_child(
    df: DataFrame, id_parts: list[str], children: dict[str, list[str]], parent_id: str
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Parents with an ``id`` and one child table per array column.

    ``children`` maps an array column to the columns of its table; an array of structs gives
    its fields, an array of scalars one column. Ids are set before the explode, so children
    carry their parent's. A parent without children is kept.
    """
    keyed = df.withColumn("id", surrogate_key(*id_parts))
    tables = {}
    for array, columns in children.items():
        exploded = keyed.select(F.col("id").alias(parent_id), F.posexplode(array).alias("ordinal", "_item"))
        scalar = exploded.schema["_item"].dataType.typeName() != "struct"
        fields = [F.col("_item" if scalar else f"_item.{c}").alias(c) for c in columns]
        tables[array] = exploded.select(parent_id, "ordinal", *fields)
    return keyed.drop(*children), tables
