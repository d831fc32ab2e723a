"""The result store."""

from .tables import (
    WriteResult,
    append_rows,
    compact,
    drop_table,
    ensure_tables,
    expire,
    last_batch,
    read_latest,
    read_refused,
    table_path,
    vacuum,
    write_batch,
)

__all__ = [
    "WriteResult",
    "append_rows",
    "compact",
    "drop_table",
    "ensure_tables",
    "expire",
    "last_batch",
    "read_latest",
    "read_refused",
    "table_path",
    "vacuum",
    "write_batch",
]
