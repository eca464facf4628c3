"""Paged API results, landed as one document per page, and the requests that produce them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.periods import lag_window
from ..functions.rules import RESULT_TYPES
from ..operators.dedupe import latest_per_key
from ..operators.skew import spread

# Hits per search page, and the request's default area and order.
PAGE_SIZE = 10
SEARCH_AREA, SORT_BY = "Во всех полях", "Дата регистрации"
OTHER_SWITCHES = ("ikrbses", "full_text_available", "open_license", "free_licenses", "expert_estimation_exist")
EMPTY_LISTS = ("critical_technologies", "priority_directions", "rubrics")


def page_count(total: Column, size: int = PAGE_SIZE) -> Column:
    return F.ceil(total / F.lit(size))


def _completeness(pages: DataFrame, keys: list[str], expected: Column) -> DataFrame:
    """Whether all pages of each list were landed, from page numbers alone."""
    return (
        pages.groupBy(*keys)
        .agg(F.countDistinct("page").alias("landed"), F.max(expected).alias("expected"))
        .select(*keys, "landed", "expected", (F.col("landed") >= F.col("expected")).alias("complete"))
    )


def merge_pages(
    pages: DataFrame, keys: list[str], items: str = "items", pages_col: str = "pages"
) -> tuple[DataFrame, DataFrame]:
    """Items of all pages of each list, and each list's completeness.

    A page landed twice counts once.
    """
    once = latest_per_key(pages, [*keys, "page"], F.xxhash64(items))
    merged = once.select(*keys, "page", F.posexplode(items).alias("ordinal", "item"))
    # An empty list still has its first page.
    return merged, _completeness(pages, keys, F.greatest(F.col(pages_col), F.lit(1)))


def merge_hits(pages: DataFrame, size: int = PAGE_SIZE) -> tuple[DataFrame, DataFrame]:
    """Distinct hits of each (organisation, type) and the completeness of its pages.

    A collector that starts over lands pages again, so hits are told apart by ``_id``.
    """
    keys = ["org_id", "type"]
    hits = pages.select(*keys, "page", F.posexplode("hits.hits").alias("ordinal", "hit"))
    identified = hits.withColumn("_id", F.col("hit._id"))
    first = [F.col("page"), F.col("ordinal"), F.xxhash64("hit")]
    distinct = latest_per_key(identified, [*keys, "_id"], *first).select(*keys, "hit")
    expected = F.greatest(page_count(F.col("hits.total.value"), size), F.lit(1))
    return distinct, _completeness(pages, keys, expected)


def gate(items: DataFrame, completeness: DataFrame, keys: list[str], strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Items of complete lists, and the lists that lack pages; with ``strict`` such a list fails the query."""
    lacking = completeness.where("NOT complete")
    if not strict:
        return items.join(spread(lacking.select(*keys), keys[0]), keys, "left_anti"), lacking
    message = F.concat(F.lit("pages are missing of "), F.concat_ws("/", *keys))
    failing = completeness.select(*keys, F.when(F.col("complete"), True).otherwise(F.raise_error(message).cast("boolean")).alias("_complete"))
    # In the filter, which pruning cannot drop.
    checked = items.join(spread(failing, keys[0]), keys, "left").where(F.coalesce("_complete", F.lit(True)))
    return checked.drop("_complete"), lacking


def plan_requests(orgs: DataFrame, interval_end: Column) -> DataFrame:
    """Search requests: one per organisation and result type for the interval's window.

    The types are unnested from a constant array, so the organisations are neither joined nor
    shuffled.
    """
    start, end = lag_window(interval_end)
    kinds = F.explode(F.array(*[F.lit(t) for t in RESULT_TYPES])).alias("type")
    asked = orgs.select("rosrid_id", kinds, start.alias("start"), end.alias("end"))
    return asked.select(
        F.lit(None).cast("string").alias("search_query"),
        F.lit(SEARCH_AREA).alias("search_area"),
        F.lit(SORT_BY).alias("sort_by"),
        *[(F.col("type") == t).alias(t) for t in RESULT_TYPES],
        *[F.lit(False).alias(switch) for switch in OTHER_SWITCHES],
        F.array("rosrid_id").alias("organization"),
        *[F.array().cast("array<string>").alias(name) for name in EMPTY_LISTS],
        F.lit(1).alias("page"),
        F.date_format("start", "yyyy-MM-dd").alias("start_date"),
        F.date_format("end", "yyyy-MM-dd").alias("end_date"),
        "type",
    )


def plan_pages(lists: DataFrame, first: Column, last: Column) -> DataFrame:
    """One row per page a list should have; none if ``last`` is before ``first``."""
    return lists.where(last >= first).withColumn("page", F.explode(F.sequence(first, last)))
