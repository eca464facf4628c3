"""DataFrame-to-DataFrame operators."""

from .aggregate import agg_codes, agg_text, counted, text_of_segments, text_segments, total_items
from .dedupe import latest_document, latest_per_key
from .export import drop_audit, export_csv, refresh_if_loaded, with_row_index
from .hierarchy import climb_to_top, paths_to_top
from .lookup import judged_lookup, lookup, org_list, rejects_of, with_children, with_fetch
from .maintain import (
    append_rows,
    insert_ignore,
    keyed_replace,
    keyed_replace_all,
    new_rows,
    not_yet_stored,
    snapshot_replace,
    split_parent_child,
    surrogate_key,
)
from .nearest import nearest_name
from .shape import (
    const_if_present,
    flatten,
    live,
    normalise_names,
    open_items,
    reshape_structs,
    salary_fields,
    unnest_entries,
    unnest_map,
)

__all__ = [
    "agg_codes",
    "agg_text",
    "append_rows",
    "climb_to_top",
    "const_if_present",
    "counted",
    "drop_audit",
    "export_csv",
    "flatten",
    "insert_ignore",
    "keyed_replace",
    "keyed_replace_all",
    "latest_document",
    "latest_per_key",
    "live",
    "judged_lookup",
    "lookup",
    "rejects_of",
    "nearest_name",
    "new_rows",
    "not_yet_stored",
    "normalise_names",
    "open_items",
    "org_list",
    "paths_to_top",
    "refresh_if_loaded",
    "reshape_structs",
    "salary_fields",
    "snapshot_replace",
    "split_parent_child",
    "surrogate_key",
    "text_of_segments",
    "text_segments",
    "total_items",
    "unnest_entries",
    "unnest_map",
    "with_children",
    "with_fetch",
    "with_row_index",
]
