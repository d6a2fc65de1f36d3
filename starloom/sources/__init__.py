"""Readers. Every reader takes a declared schema; none infers one from the data."""

from starloom.sources.files import (
    conform_types,
    cut_to_widths,
    read_csv,
    read_json,
    read_json_tree,
    read_landing,
    read_parquet,
    read_text,
    read_whole_text,
    select_positions,
    stage_json,
    table,
)
from starloom.sources.labels import inline_mapping, label_mappings, label_pairs, mapping_for

__all__ = [name for name in dir() if not name.startswith("_")]
