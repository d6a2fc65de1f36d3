"""Column -> Column helpers. All are built-in expressions; there are no Python UDFs."""

from starloom.functions.dates import (
    calendar_parts,
    day_number_to_date,
    epoch_millis_to_timestamp,
    epoch_millis_to_second,
    parse_compact_date,
    parse_timestamp,
    text_to_date,
    time_of_day,
    timestamp_to_epoch_millis,
    weekday,
)
from starloom.functions.text import (
    after_comma,
    after_dash,
    before_comma,
    collapse_whitespace,
    extract_pairs,
    fact_key,
    full_name,
    is_blank,
    signed_coordinate,
    strip_letters,
    strip_quotes,
    text_to_double,
    truncated,
)

__all__ = [name for name in dir() if not name.startswith("_")]
