"""DataFrame -> DataFrame operators; each works with ``df.transform``."""

from starloom.operators.aggregate import (
    count_where,
    dedupe,
    domain_difference,
    frequency,
    group_mean,
    mark_kept,
    pivot_values,
    table_shape,
    top_values,
    union_domain,
)
from starloom.operators.joins import (
    Band,
    band_join,
    first_match_lookup,
    full_outer,
    loose_band_join,
    lookup,
    natural_key_join,
    pivot_back,
)
from starloom.operators.quality import (
    CheckFailed,
    declared_violations,
    duplicate_keys,
    length_overflow,
    non_empty,
    null_counts,
    orphans,
    threshold_checks,
)
from starloom.operators.ranking import dense_id, position_within, row_id
from starloom.operators.shape import drop_blank, point_lookup

__all__ = [name for name in dir() if not name.startswith("_")]
