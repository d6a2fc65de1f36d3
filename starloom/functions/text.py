"""Text cleaning, tolerant casts and deterministic keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ColumnOrName = Column | str

# Fixed pattern: a code is quoted text or digits, a label is quoted text or one word.
CODE_LABEL_PATTERN = r"('[^']*'|[0-9]+)\s?=\s?('[^']*'|[a-zA-Z]+)"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: ColumnOrName) -> Column:
    """Null and the empty string mean the same: no value."""
    return _col(c).isNull() | (_col(c) == "")


def strip_letters(c: ColumnOrName) -> Column:
    return F.regexp_replace(_col(c), "[a-zA-Z]+", "")


def before_comma(c: ColumnOrName) -> Column:
    return F.regexp_replace(_col(c), ",.*", "")


def after_comma(c: ColumnOrName) -> Column:
    return F.regexp_replace(_col(c), ".*,", "")


def after_dash(c: ColumnOrName) -> Column:
    return F.regexp_replace(_col(c), ".*-", "")


def strip_quotes(c: ColumnOrName) -> Column:
    return F.regexp_replace(_col(c), "'", "")


def collapse_whitespace(c: ColumnOrName) -> Column:
    return F.trim(F.regexp_replace(_col(c), r"\s+", " "))


def text_to_double(c: ColumnOrName) -> Column:
    """Number in text form; blanks and bad values give null instead of an error."""
    return _col(c).try_cast("double")


def signed_coordinate(c: ColumnOrName) -> Column:
    """``57.05N`` to 57.05 and ``10.33W`` to -10.33."""
    value = text_to_double(strip_letters(c))
    return F.when(F.upper(_col(c)).rlike("[SW]"), -value).otherwise(value)


def full_name(first: ColumnOrName, last: ColumnOrName) -> Column:
    return F.concat_ws(" ", _col(first), _col(last))


def fact_key(session: ColumnOrName, start_time: ColumnOrName) -> Column:
    """md5 over session and second; null when either is null.

    The key depends on the row alone, so a task that is run again gives the same
    key. Generated ids do not have that property.
    """
    second = F.substring_index(_col(start_time).cast("timestamp_ntz").cast("string"), ".", 1)
    return F.md5(F.concat(_col(session).cast("string"), second))


def extract_pairs(c: ColumnOrName, pattern: str = CODE_LABEL_PATTERN) -> Column:
    """All (code, label) matches of a two-group pattern, in order of appearance."""
    codes = F.regexp_extract_all(_col(c), F.lit(pattern), F.lit(1))
    labels = F.regexp_extract_all(_col(c), F.lit(pattern), F.lit(2))
    return F.arrays_zip(codes.alias("code"), labels.alias("label"))


def truncated(c: ColumnOrName, width: int) -> Column:
    """Cut text to a declared width, in characters."""
    return F.substring(_col(c), 1, width)
