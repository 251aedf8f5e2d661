"""Operators over any DataFrame."""

from lakemart.operators.ancestors import ancestors
from lakemart.operators.containment import join_path_contains
from lakemart.operators.history import (
    apply_batch,
    build_history,
    changed_versions,
    current_versions,
    lookup_current,
)
from lakemart.operators.merge import insert_newer, merge_incremental, past_marks, rows_past_watermark, upsert
from lakemart.operators.newest import current_rows, newest_per_key, stamp, union_sources

__all__ = [
    "ancestors",
    "apply_batch",
    "build_history",
    "changed_versions",
    "current_rows",
    "current_versions",
    "insert_newer",
    "join_path_contains",
    "lookup_current",
    "merge_incremental",
    "newest_per_key",
    "past_marks",
    "rows_past_watermark",
    "stamp",
    "union_sources",
    "upsert",
]
