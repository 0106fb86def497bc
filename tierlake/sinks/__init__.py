"""Sinks: catalog tables, keyed writes, snapshots and previews."""

from tierlake.sinks.tables import (
    append_table,
    check_keys,
    ensure_schema,
    overwrite_table,
    preview,
    write_keyed_table,
    write_snapshot,
)

__all__ = ["append_table", "check_keys", "ensure_schema", "overwrite_table", "preview", "write_keyed_table", "write_snapshot"]
