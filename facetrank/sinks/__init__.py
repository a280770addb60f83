"""Tables and delimited text."""

from facetrank.sinks.delimited import is_writable, write_delimited
from facetrank.sinks.runs import (
    commit_run,
    committed_runs,
    input_fingerprint,
    part_paths,
    run_path,
)
from facetrank.sinks.tables import (
    append_rows,
    clean_versions,
    drop_table,
    insert_overwrite,
    merge_rows,
    overwrite_table,
    qualified,
    replace_view,
)

__all__ = [
    "append_rows",
    "clean_versions",
    "commit_run",
    "committed_runs",
    "drop_table",
    "input_fingerprint",
    "insert_overwrite",
    "is_writable",
    "merge_rows",
    "overwrite_table",
    "part_paths",
    "qualified",
    "replace_view",
    "run_path",
    "write_delimited",
]
