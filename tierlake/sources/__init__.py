"""Sources: strict file readers, catalog tables, snapshots, lineage."""

from tierlake.sources.files import read_csv_strict, read_json_strict
from tierlake.sources.lineage import add_ingestion_meta
from tierlake.sources.tables import from_rows, read_snapshot, read_table, snapshot_versions

__all__ = ["read_csv_strict", "read_json_strict", "add_ingestion_meta", "from_rows",
           "read_snapshot", "read_table", "snapshot_versions"]
