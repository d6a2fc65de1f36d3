"""Writers, load policies, upserts, table lifecycle and physical layout."""

from starloom.sinks.files import write_csv, write_parquet, write_text
from starloom.sinks.layout import cluster, write_bucketed
from starloom.sinks.loads import conform_positions, load, load_append, load_path, load_truncate
from starloom.sinks.tables import create_tables, drop_tables, reset_tables
from starloom.sinks.upsert import (
    Conflict,
    Manifest,
    Part,
    compact,
    current_version,
    prune_versions,
    read_version,
    upsert,
    upsert_into,
)

__all__ = [name for name in dir() if not name.startswith("_")]
