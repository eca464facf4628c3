"""Rules for research results: who owns one, of which type it is, where it is shown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Result types as the search service names them, in request order.
PROJECT, INVENTION, THESIS = "nioktrs", "rids", "dissertations"
RESULT_TYPES = (PROJECT, INVENTION, THESIS)

# Short titles in the type dictionary and the degree that tells theses apart.
PROJECT_TITLE, INVENTION_TITLE = "НИОКТР", "РИД"
DOCTOR_TITLE, CANDIDATE_TITLE, DOCTOR_DEGREE = "ДД", "КД", "Докторская"

# Fixed value: address of the service's detail pages.
DETAIL_BASE = "https://rosrid.ru/"


def is_executor(kind: Column, source: Column, ogrn: Column) -> Column:
    """Whether the organisation itself carried the work out; missing data count as no."""
    owner = (
        F.when(kind == PROJECT, source["executor"]["ogrn"] == ogrn)
        .when(kind == INVENTION, F.exists(source["executors"], lambda e: e["ogrn"] == ogrn))
        .when(kind == THESIS, source["author_organization"]["ogrn"] == ogrn)
    )
    return F.coalesce(owner, F.lit(False))


def active_type(kind: Column, degree: Column) -> Column:
    """Short title of the result's type; theses without a degree count as candidate's."""
    return (
        F.when(kind == INVENTION, INVENTION_TITLE)
        .when((kind == THESIS) & degree.eqNullSafe(DOCTOR_DEGREE), DOCTOR_TITLE)
        .when(kind == THESIS, CANDIDATE_TITLE)
        .otherwise(PROJECT_TITLE)
    )


def detail_url(kind: Column, object_id: Column, base: str = DETAIL_BASE) -> Column:
    """Detail page; the path has the type in the singular (its last letter dropped)."""
    singular = F.left(kind, F.char_length(kind) - 1)
    return F.concat(F.lit(base), singular, F.lit("/detail/"), object_id)
