"""Everything that leaves data behind."""

from shelfpulse.sinks.export import ExportMismatch, export_jdbc, merge_jdbc, write_csv_backup
from shelfpulse.sinks.tables import (
    append_table,
    delete_window,
    ensure_table,
    overwrite_from_sql,
    refresh_window,
    replace_or_backup,
    replace_table,
    table_days,
    verify_count,
)

__all__ = [
    "ExportMismatch",
    "append_table",
    "delete_window",
    "ensure_table",
    "export_jdbc",
    "merge_jdbc",
    "overwrite_from_sql",
    "refresh_window",
    "replace_or_backup",
    "replace_table",
    "table_days",
    "verify_count",
    "write_csv_backup",
]
