"""Landed documents, paged results and stored tables."""

from .areas import flatten_area_tree
from .bucketed import BucketedTable
from .documents import (
    interval_path,
    read_documents,
    read_staged,
    stage,
    write_documents,
    write_intervals,
    write_staged,
)
from .feeds import expand_feeds, read_atom
from .paging import gate, merge_hits, merge_pages, page_count, plan_pages, plan_requests
from .rates import read_rates
from .snapshots import SnapshotHistory
from .store import TableStore
from .verdicts import Verdicts, split_atom, split_documents

__all__ = [
    "BucketedTable",
    "SnapshotHistory",
    "TableStore",
    "Verdicts",
    "gate",
    "expand_feeds",
    "flatten_area_tree",
    "interval_path",
    "merge_hits",
    "merge_pages",
    "page_count",
    "plan_pages",
    "plan_requests",
    "read_atom",
    "read_documents",
    "read_rates",
    "read_staged",
    "split_atom",
    "split_documents",
    "stage",
    "write_documents",
    "write_intervals",
    "write_staged",
]
