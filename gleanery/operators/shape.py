"""Projections, unnesting and simple filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import BASE_CURRENCY


def unnest_entries(df: DataFrame, array: str, ordinal: str = "ordinal", item: str = "item") -> DataFrame:
    """One row per array element with its position."""
    return df.select(
        *[c for c in df.columns if c != array], F.posexplode(array).alias(ordinal, item)
    )


def unnest_map(df: DataFrame, groups: str, kind: str = "kind", item: str = "item") -> DataFrame:
    """One row per element of a map of arrays, with its key and position."""
    rest = [c for c in df.columns if c != groups]
    return df.select(*rest, F.explode(groups).alias(kind, "_items")).select(
        *rest, kind, F.posexplode("_items").alias("ordinal", item)
    )


def normalise_names(df: DataFrame, renames: dict[str, str], **constants) -> DataFrame:
    """Lower-case the column names, rename some, add constant columns."""
    lowered = df.toDF(*[c.lower() for c in df.columns])
    return lowered.withColumnsRenamed(renames).withColumns(
        {name: F.lit(value) for name, value in constants.items()}
    )


def const_if_present(col: Column, constant) -> Column:
    return F.when(col.isNotNull(), F.lit(constant))


def salary_fields(salary: Column) -> dict[str, Column]:
    """The four salary columns of a salary struct; all NULL without one."""
    return {
        "salary_from": salary["from"],
        "salary_to": salary["to"],
        "salary_currency": const_if_present(salary, BASE_CURRENCY),
        "salary_gross": salary["gross"],
    }


def flatten(df: DataFrame, paths: dict[str, str]) -> DataFrame:
    """Columns from nested paths, ``{column: path}``."""
    return df.select(*[F.col(path).alias(name) for name, path in paths.items()])


def reshape_structs(array: Column, mapping: dict[str, str]) -> Column:
    """Array of structs with the fields ``{new: old}`` only."""
    return F.transform(
        array, lambda x: F.struct(*[x[old].alias(new) for new, old in mapping.items()])
    )


def open_items(lists: DataFrame, array: str = "lists_of_vacancies") -> DataFrame:
    """Items of the per-organisation lists that are not closed."""
    rest = [c for c in lists.columns if c != array]
    return lists.select(*rest, F.explode(array).alias("item")).where(F.col("item.type.id") != "closed")


def live(df: DataFrame, *not_null: str) -> DataFrame:
    """Rows that are not soft-deleted and have the named columns."""
    kept = df.where(F.col("deleted_at").isNull())
    return kept.dropna(subset=list(not_null)) if not_null else kept
