"""Research results: search documents to a keyed history table with a code bridge and a report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    active_type,
    code_prefixes,
    concat_skip_null,
    detail_url,
    is_executor,
    latest_period,
    naive_timestamp,
    strip_ws,
)
from ..functions.text import STORAGE_BASE
from ..operators import (
    agg_codes,
    drop_audit,
    keyed_replace,
    keyed_replace_all,
    latest_per_key,
    live,
    lookup,
    not_yet_stored,
    split_parent_child,
    surrogate_key,
    total_items,
    unnest_map,
)
from ..sources import TableStore, gate, merge_hits, stage

TABLE, BRIDGE = "rosrid_active", "rosrid_active_oecd"
#: What a result's id is made of.
ID_PARTS = ["object_id", "rosrid_university_id", "kind", "ordinal", "created_at"]


def documents_of_hits(requests: DataFrame, hits: DataFrame) -> DataFrame:
    """Rows ``(organisation, kind, item)`` of merged search pages.

    The hits stay rows: gathering an organisation's hits in one document would put an unbounded
    group in one task.
    """
    found = hits.select(F.col("org_id").alias("rosrid_id"), F.col("type").alias("kind"), F.col("hit").alias("item"))
    return found.join(requests, "rosrid_id")


def hits_of_pages(pages: DataFrame, requests: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows of landed search pages with their organisation, and the searches that lack pages.

    The hits of such a search are held back; with ``strict`` it fails the query.
    """
    hits, completeness = merge_hits(pages)
    whole, lacking = gate(hits, completeness, ["org_id", "type"], strict)
    return documents_of_hits(requests, whole), lacking


def hits_of_documents(documents: DataFrame) -> DataFrame:
    """Rows ``(organisation, kind, ordinal, item)`` of landed documents, one per organisation."""
    return unnest_map(documents, "actives")


def checked_counts(documents: DataFrame) -> DataFrame:
    """Each document's stated number of results beside the number it holds."""
    return documents.select("rosrid_id", "actives_count", total_items(F.col("actives")).alias("found"))


def type_dictionary(types: DataFrame) -> DataFrame:
    """One live type per short title, the lowest id."""
    return latest_per_key(live(types).select("id", "title_short"), ["title_short"], F.col("id").asc())


def transform_actives(
    hits: DataFrame, types: DataFrame, bucket: str, interval_end: str, strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Result rows with an ``oecd`` array of truncated codes, and the type titles not found."""
    source = F.col("item._source")
    classified = hits.select(
        "rosrid_university_id",
        F.col("item._id").alias("object_id"),
        source["last_status"]["created_date"].try_cast("date").alias("date"),
        strip_ws(source["name"]).alias("title"),
        detail_url(F.col("kind"), F.col("item._id")).alias("url"),
        is_executor(F.col("kind"), source, F.col("university_ogrn")).alias("is_executor"),
        active_type(F.col("kind"), source["dissertation_type"]["name"]).alias("type_title"),
        code_prefixes(source["oecds"]["code"]).alias("oecd"),
        F.lit(bucket).alias("s3_bucket"),
        "s3_key",
        "kind",
        "ordinal",
        naive_timestamp(F.lit(interval_end)).alias("created_at"),
    )
    return lookup(classified, type_dictionary(types), "type_title", "title_short", {"id": "type_id"}, strict)


def split_actives(
    rows: DataFrame, codes: DataFrame, strict: bool = False
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Parents with ids, bridge rows, and the codes the dictionary lacks.

    A result found for several organisations is there once for each.
    """
    parents, children = split_parent_child(
        rows,
        ID_PARTS,
        {"oecd": ["code"]},
        "active_id",
    )
    # Ids are hex digits: as bytes they are half as long to move.
    packed = children["oecd"].withColumn("active_id", F.unhex("active_id"))
    found, rejects = lookup(packed, codes, "code", "code", {"id": "oecd_id"}, strict)
    return parents, found.where("oecd_id IS NOT NULL").select(F.lower(F.hex("active_id")).alias("active_id"), "oecd_id"), rejects


def load_actives(
    store: TableStore, rows: DataFrame, codes: DataFrame, now: str, only_live: bool = False
) -> int:
    """Stamp the stored rows of the batch's objects, add the batch; returns the batch's size.

    An empty batch changes nothing. With ``only_live`` the archive is neither read nor written.
    A load that is run again with the same ``now`` leaves the same tables.
    """
    at = naive_timestamp(F.lit(now))
    with stage(rows.withColumn("created_at", at), "actives") as (batch, size):
        if size == 0:
            return 0
        parents, bridge, _ = split_actives(batch, codes)
        store.append(BRIDGE, not_yet_stored(store.read(BRIDGE), bridge, "active_id"))
        stored = store.read_live(TABLE) if only_live else store.read(TABLE)
        before = stored.where(~F.col("created_at").eqNullSafe(at))
        state = keyed_replace(before, parents, "object_id", now, only_live)
        if only_live:
            store.replace_live(TABLE, state)
        else:
            store.replace(TABLE, state)
        return size


def load_actives_history(store: TableStore, rows: DataFrame, codes: DataFrame, only_live: bool = False) -> int:
    """The loads of many intervals at once, one for each ``created_at`` of ``rows``; returns the number of rows.

    It leaves the tables that ``load_actives`` leaves, called once for each ``created_at``, oldest first: what one
    load ends is known from the keys of all of them, so there is one plan and one write. The table must hold
    no later loads. Run again with the same rows, it leaves the same tables.
    """
    with stage(rows, "actives") as (batch, size):
        if size == 0:
            return 0
        parents, bridge, _ = split_actives(batch, codes)
        held = store.read(BRIDGE)
        store.append(BRIDGE, bridge if held.isEmpty() else not_yet_stored(held, bridge, "active_id"))
        stored = store.read_live(TABLE) if only_live else store.read(TABLE)
        loads = batch.select("created_at").distinct()
        # Ids are 32 characters that nothing makes shorter: new rows get theirs once they have been moved.
        state = keyed_replace_all(stored.join(loads, "created_at", "left_anti"), parents.drop("id"), "object_id", only_live=only_live)
        state = state.withColumn("id", F.coalesce("id", surrogate_key(*ID_PARTS)))
        if only_live:
            # The archive stays as it is, so what an earlier try of these loads has put there is not added again.
            archived = store.read(TABLE).where("deleted_at IS NOT NULL").join(loads, "created_at", "left_semi")
            store.replace_live(TABLE, state.join(archived.select("id").distinct(), "id", "left_anti"))
        else:
            store.replace(TABLE, state)
        return size


def actives_report(
    actives: DataFrame,
    types: DataFrame,
    registrations: DataFrame,
    orgs: DataFrame,
    bridge: DataFrame,
    codes: DataFrame,
    from_month_start: bool = False,
) -> DataFrame:
    """Live results of the newest date (or its month) with type, organisation and codes."""
    period = latest_period(
        actives.where("deleted_at IS NULL"), "date", of=actives, from_month_start=from_month_start
    )
    t = types.select(F.col("id").alias("type_id"), F.col("title").alias("type"))
    reg = registrations.select(F.col("id").alias("rosrid_university_id"), "university_id")
    u = orgs.select(
        F.col("id").alias("university_id"),
        F.col("mon_id").alias("university_one_monitoring_id"),
        F.col("title_short").alias("university_title"),
        F.col("title_display").alias("university_abbreviation"),
    )
    named = period.join(t, "type_id").join(reg, "rosrid_university_id").join(u, "university_id")
    # Codes of reported results only: the bridge holds the whole history.
    links = bridge.join(period.select(F.col("id").alias("active_id")), "active_id", "left_semi")
    texts = agg_codes(links, codes, F.col("oecd_id") == codes["id"], ["active_id"], "oecd")
    report = named.join(texts, F.col("id") == F.col("active_id")).select(
        "id",
        "university_id",
        "university_one_monitoring_id",
        "university_title",
        "university_abbreviation",
        "created_at",
        "object_id",
        "type",
        "date",
        "title",
        "oecd",
        "url",
        "is_executor",
        concat_skip_null(F.lit(STORAGE_BASE), F.col("s3_bucket"), F.lit("/"), F.col("s3_key")).alias("s3"),
    )
    return drop_audit(report)
