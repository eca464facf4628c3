"""Schemas of landed documents and stored tables."""

from __future__ import annotations

FEED_CONFIG = "topic STRING, feeds ARRAY<STRUCT<url: STRING, keyword: STRING>>"

ATOM_ENTRY = """
    link STRUCT<_href: STRING>, published STRING,
    title STRUCT<_VALUE: STRING, _type: STRING>, content STRUCT<_VALUE: STRING, _type: STRING>
"""

FETCH_MANIFEST = """
    interval STRING, feed_key STRING, entry_no INT, url STRING, status INT, s3_bucket STRING, s3_key STRING
"""

RATE = "_ID STRING, NumCode INT, CharCode STRING, Nominal INT, Name STRING, Value STRING"

_LIST_ITEM = "STRUCT<id: STRING, type: STRUCT<id: STRING>>"
VACANCY_PAGE = f"employer_id BIGINT, page INT, pages INT, items ARRAY<{_LIST_ITEM}>"
VACANCY_LISTS = f"hh_university_id BIGINT, lists_of_vacancies ARRAY<{_LIST_ITEM}>"

VACANCY = """
    id STRING, hh_university_id BIGINT, created_at STRING, initial_created_at STRING,
    name STRING, description STRING,
    salary STRUCT<`from`: DOUBLE, `to`: DOUBLE, currency: STRING, gross: BOOLEAN>,
    experience STRUCT<name: STRING>, schedule STRUCT<name: STRING>, employment STRUCT<name: STRING>,
    area STRUCT<id: STRING>, alternate_url STRING,
    professional_roles ARRAY<STRUCT<id: STRING, name: STRING>>, key_skills ARRAY<STRUCT<name: STRING>>
"""

_OGRN = "STRUCT<ogrn: STRING>"
HIT = f"""STRUCT<_id: STRING, _source: STRUCT<
    name: STRING, last_status: STRUCT<created_date: STRING>,
    executor: {_OGRN}, executors: ARRAY<{_OGRN}>, author_organization: {_OGRN},
    dissertation_type: STRUCT<name: STRING>, oecds: ARRAY<STRUCT<code: STRING>>>>"""

SEARCH_PAGE = f"""
    org_id STRING, type STRING, page INT,
    hits STRUCT<total: STRUCT<value: BIGINT>, hits: ARRAY<{HIT}>>
"""

ACTIVES_DOCUMENT = f"""
    rosrid_id STRING, university_id BIGINT, university_ogrn STRING, rosrid_university_id BIGINT,
    start_date STRING, end_date STRING, actives_count BIGINT, actives MAP<STRING, ARRAY<{HIT}>>
"""


def area_tree(depth: int) -> str:
    """Schema of an area tree with ``depth`` levels; the children of the last stay raw text."""
    areas = "ARRAY<STRING>"
    for _ in range(depth):
        areas = f"ARRAY<STRUCT<id: STRING, parent_id: STRING, name: STRING, areas: {areas}>>"
    return areas


_HISTORY = "created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ, deleted_at TIMESTAMP_NTZ"

#: Stored tables. Ids of loaded rows are hashes of natural keys, see ``surrogate_key``.
TABLES = {
    "google_alerts_newsfeed": """id STRING, created_at TIMESTAMP_NTZ, deleted_at TIMESTAMP_NTZ,
        hash STRING, topic STRING, keyword STRING, date DATE, domain STRING, url STRING,
        title STRING, content STRING, s3_bucket STRING, s3_key STRING""",
    "hh_currency_exchange_rate": """id STRING, created_at TIMESTAMP_NTZ, date DATE, title STRING,
        nominal INT, value DOUBLE, char_code STRING, num_code INT, currency_id STRING,
        loaded_at TIMESTAMP_NTZ""",
    "hh_vacancy": f"""id STRING, {_HISTORY}, hh_university_id BIGINT, hh_id BIGINT,
        hh_created_at TIMESTAMP_NTZ, hh_initial_created_at TIMESTAMP_NTZ, title STRING,
        description STRING, salary_from DOUBLE, salary_to DOUBLE, salary_currency STRING,
        salary_gross BOOLEAN, experience STRING, schedule STRING, employment STRING,
        federal_region_id BIGINT, url STRING, s3_bucket STRING, s3_key STRING""",
    "hh_skill": "id STRING, created_at TIMESTAMP_NTZ, vacancy_id STRING, title STRING",
    "hh_professional_role": """created_at TIMESTAMP_NTZ, vacancy_id STRING,
        hh_professional_role_dict_id BIGINT, title STRING""",
    "hh_hh_university": "id BIGINT, employer_id BIGINT, university_id BIGINT, deleted_at TIMESTAMP_NTZ",
    "university_university": """id BIGINT, ogrn STRING, mon_id BIGINT, title_short STRING,
        title_display STRING, deleted_at TIMESTAMP_NTZ""",
    "geo_federal_region": "id BIGINT, title STRING, deleted_at TIMESTAMP_NTZ",
    "rosrid_active": f"""id STRING, {_HISTORY}, rosrid_university_id BIGINT, type_id BIGINT,
        object_id STRING, date DATE, title STRING, url STRING, is_executor BOOLEAN,
        s3_bucket STRING, s3_key STRING""",
    "rosrid_active_oecd": "active_id STRING, oecd_id BIGINT",
    "rosrid_active_type": "id BIGINT, title STRING, title_short STRING, deleted_at TIMESTAMP_NTZ",
    "rosrid_rosrid_university": """id BIGINT, university_id BIGINT, rosrid_id STRING,
        deleted_at TIMESTAMP_NTZ""",
    "dict_oecd": "id BIGINT, code STRING, title STRING",
}
