"""Vacancies: job documents to a snapshot table with two child tables and a monthly report."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    drop_quotes,
    falsy_to_null,
    naive_timestamp,
    storage_link,
    to_rubles,
    trailing_month,
)
from ..functions.values import BASE_CURRENCY
from ..operators import (
    agg_text,
    climb_to_top,
    drop_audit,
    judged_lookup,
    latest_per_key,
    live,
    lookup,
    nearest_name,
    not_yet_stored,
    rejects_of,
    reshape_structs,
    salary_fields,
    snapshot_replace,
    split_parent_child,
    surrogate_key,
    with_children,
)
from ..operators.dedupe import latest_document
from ..operators.skew import distinct_keys, spread
from ..sources import TableStore, Verdicts, gate, merge_pages, stage
from ..sources.verdicts import BROKEN, GOOD
from .rates import latest_rates

TABLE, SKILLS, ROLES = "hh_vacancy", "hh_skill", "hh_professional_role"

# Fixed value: name of the area tree's root whose regions are of interest.
COUNTRY = "Россия"

OPTIONAL = [
    "salary_from",
    "salary_to",
    "salary_currency",
    "salary_gross",
    "experience",
    "schedule",
    "employment",
    "federal_region_id",
]


def area_regions(areas: DataFrame, regions: DataFrame) -> DataFrame:
    """Region of each area: ``area_id, federal_region_id, score``, resolved once per name."""
    tops = climb_to_top(areas, COUNTRY)
    nearest = nearest_name(tops, "top_name", live(regions).select("id", "title"))
    matched = tops.join(spread(nearest, "name"), F.col("top_name") == F.col("name"), "left")
    return matched.select(
        F.col("id").alias("area_id"), F.col("match_id").alias("federal_region_id"), "score"
    )


def listed_vacancies(pages: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Open items of the organisations' paged lists, ``employer_id, item``, and the lists that lack pages.

    The items of such a list are held back, since a snapshot load would end the vacancies that are
    missing; with ``strict`` it fails the query.
    """
    items, completeness = merge_pages(pages, ["employer_id"])
    whole, lacking = gate(items, completeness, ["employer_id"], strict)
    return whole.where(F.col("item.type.id") != "closed").select("employer_id", "item"), lacking


def documents_of_list(items: DataFrame, documents: DataFrame, *fetch_order: str) -> DataFrame:
    """The last fetched document of each listed vacancy."""
    last = latest_document(documents, "id", *fetch_order)
    return last.join(distinct_keys(items.select(F.col("item.id").alias("id")), "id"), "id", "left_semi")


def transform_vacancies(
    documents: DataFrame,
    rates: DataFrame,
    area_region: DataFrame,
    bucket: str,
    interval_end: str,
    keep_falsy: bool = False,
    strict: bool = False,
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Vacancy rows with ``skills`` and ``professional_roles`` arrays, and the rejects.

    Rejects are the currencies without a rate and the areas not in the tree; their vacancies
    are kept with NULL in the column concerned.
    """
    flat = _with_keys(documents)
    priced, no_rate = lookup(flat, latest_rates(rates), "_currency", "char_code", {"value": "_rate"}, strict)
    placed, no_area = lookup(
        priced, area_region, "_area", "area_id", {"federal_region_id": "federal_region_id"}, strict, of=flat
    )
    rows = placed.select(*_columns(bucket, interval_end))
    return (rows if keep_falsy else falsy_to_null(rows, OPTIONAL)), {"currency": no_rate, "area": no_area}


def judged_vacancies(
    documents: DataFrame, rates: DataFrame, area_region: DataFrame, bucket: str, interval_end: str, keep_falsy: bool = False
) -> DataFrame:
    """Vacancy rows with ``currency, area`` as looked up, what they are ``lacking``, and a ``verdict``: each input is read once."""
    rate, region = {"value": "_rate"}, {"federal_region_id": "federal_region_id"}
    priced = judged_lookup(_with_keys(documents), latest_rates(rates), "_currency", "char_code", rate, "currency")
    placed = judged_lookup(priced, area_region, "_area", "area_id", region, "area")
    verdict = F.when(F.size("lacking") == 0, GOOD).otherwise(BROKEN)
    keys = [F.col("_currency").alias("currency"), F.col("_area").alias("area"), "lacking", verdict.alias("verdict")]
    rows = placed.select(*_columns(bucket, interval_end), *keys)
    return rows if keep_falsy else falsy_to_null(rows, OPTIONAL)


def split_vacancies(judged: DataFrame, path: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The result of ``transform_vacancies`` from ``judged_vacancies``, written once to ``path``.

    Rejects are counted from the part of the rows that lack something; the others are not opened for them.
    """
    written = Verdicts(judged, path)
    lacking = written.rows(BROKEN)
    return written.rows().drop("currency", "area", "lacking"), {name: rejects_of(lacking, name, name) for name in ("currency", "area")}


def _with_keys(documents: DataFrame) -> DataFrame:
    # Only an amount in another currency needs a rate.
    foreign = (F.col("salary.currency") != BASE_CURRENCY) & F.coalesce("salary.from", "salary.to").isNotNull()
    return documents.withColumns(
        {
            "_amounts": F.struct(*[c.alias(n) for n, c in salary_fields(F.col("salary")).items()]),
            "_currency": F.when(foreign, F.col("salary.currency")),
            "_area": F.col("area.id"),
        }
    )


def _columns(bucket: str, interval_end: str) -> list:
    def rubles(amount: str):
        return to_rubles(F.col(f"_amounts.{amount}"), F.col("salary.currency"), F.col("_rate"))

    return [
        "hh_university_id",
        F.col("id").cast("bigint").alias("hh_id"),
        naive_timestamp(F.lit(interval_end)).alias("created_at"),
        naive_timestamp(F.col("created_at")).alias("hh_created_at"),
        naive_timestamp(F.col("initial_created_at")).alias("hh_initial_created_at"),
        drop_quotes(F.col("name")).alias("title"),
        drop_quotes(F.col("description")).alias("description"),
        rubles("salary_from").alias("salary_from"),
        rubles("salary_to").alias("salary_to"),
        "_amounts.salary_currency",
        "_amounts.salary_gross",
        F.col("experience.name").alias("experience"),
        F.col("schedule.name").alias("schedule"),
        F.col("employment.name").alias("employment"),
        "federal_region_id",
        F.col("alternate_url").alias("url"),
        F.lit(bucket).alias("s3_bucket"),
        "s3_key",
        reshape_structs(
            F.col("professional_roles"), {"hh_professional_role_dict_id": "id", "title": "name"}
        ).alias("professional_roles"),
        F.transform("key_skills", lambda x: F.struct(drop_quotes(x["name"]).alias("title"))).alias("skills"),
    ]


def load_vacancies(store: TableStore, rows: DataFrame, now: str) -> int:
    """End all live vacancies, add the batch and its children; returns the batch's size.

    Children go first: until the parents are published nothing points to them. A load that is
    run again with the same ``now`` gives the same ids and leaves the same tables: it skips the
    children and replaces the vacancies of its first try.
    """
    at = naive_timestamp(F.lit(now))
    with stage(rows.withColumn("created_at", at), "vacancies") as (batch, size):
        parents, children = split_parent_child(
            batch,
            ["hh_id", "created_at"],
            {"skills": ["title"], "professional_roles": ["hh_professional_role_dict_id", "title"]},
            "vacancy_id",
        )
        skills = children["skills"].withColumns({"created_at": at, "id": surrogate_key("vacancy_id", "ordinal")})
        roles = children["professional_roles"].withColumn("created_at", at)
        for name, child in ((SKILLS, skills), (ROLES, roles)):
            # The filter on the load's time keeps other loads' rows out of the read.
            earlier = store.read(name).where(F.col("created_at") == at)
            store.append(name, not_yet_stored(earlier, child, "vacancy_id"))
        before = store.read_live(TABLE).where(~F.col("created_at").eqNullSafe(at))
        store.replace_live(TABLE, snapshot_replace(before, parents, now))
        return size


def vacancy_dims(
    vacancies: DataFrame, employers: DataFrame, orgs: DataFrame, regions: DataFrame
) -> DataFrame:
    """Vacancies with their organisation and region; those without either drop out."""
    e = employers.select(F.col("id").alias("hh_university_id"), "university_id")
    u = orgs.select(
        F.col("id").alias("university_id"),
        F.col("mon_id").alias("university_one_monitoring_id"),
        F.col("title_short").alias("university_title"),
        F.col("title_display").alias("university_abbreviation"),
    )
    r = regions.select(F.col("id").alias("federal_region_id"), F.col("title").alias("region"))
    return vacancies.join(e, "hh_university_id").join(u, "university_id").join(r, "federal_region_id")


def vacancy_report(
    vacancies: DataFrame,
    skills: DataFrame,
    roles: DataFrame,
    employers: DataFrame,
    orgs: DataFrame,
    regions: DataFrame,
    now: datetime | str,
) -> DataFrame:
    """Newest joinable version of each vacancy of the trailing month, with skills and roles."""
    recent = trailing_month(vacancies, "hh_initial_created_at", now)
    joined = vacancy_dims(recent, employers, orgs, regions)
    newest = latest_per_key(
        joined, ["hh_id"], F.col("created_at").desc_nulls_first(), F.col("id").desc()
    )
    # Children of reported versions only: the child tables hold the whole history.
    wanted = newest.select(F.col("id").alias("vacancy_id"))

    def texts(children: DataFrame, out: str) -> DataFrame:
        reported = children.select("vacancy_id", "title").join(wanted, "vacancy_id", "left_semi")
        return agg_text(reported, ["vacancy_id"], "title", out)

    full = with_children(
        newest.withColumn("vacancy_id", F.col("id")),
        texts(skills, "skills"),
        texts(roles, "professional_roles"),
        on="vacancy_id",
    )
    report = full.select(
        "id",
        "university_id",
        "university_one_monitoring_id",
        "university_title",
        "university_abbreviation",
        "created_at",
        "deleted_at",
        "hh_id",
        "url",
        F.to_date("hh_initial_created_at").alias("initial_created_at"),
        "title",
        "description",
        "salary_from",
        "salary_to",
        "salary_gross",
        "experience",
        "schedule",
        "employment",
        "region",
        "skills",
        "professional_roles",
        storage_link(F.col("s3_bucket"), F.col("s3_key")).alias("s3"),
    )
    return drop_audit(report)
