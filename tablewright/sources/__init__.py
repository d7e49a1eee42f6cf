"""Reading raw files and tables, writing layers."""

from tablewright.sources.files import (
    infer_schema,
    ingest_quarantined,
    quarantined,
    raw_file_audit,
    read_tabular,
)
from tablewright.sources.tables import (
    current_snapshot,
    publish_snapshot,
    read_statistics,
    read_table,
    write_counted,
    write_dated,
    write_table,
)

__all__ = [
    "current_snapshot",
    "infer_schema",
    "ingest_quarantined",
    "publish_snapshot",
    "quarantined",
    "raw_file_audit",
    "read_statistics",
    "read_table",
    "read_tabular",
    "write_counted",
    "write_dated",
    "write_table",
]
