"""Epoch, calendar and tolerant date conversions.

Timestamps carry no zone (``timestamp_ntz``) and are read as UTC, so results do
not depend on the machine a task runs on.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

ColumnOrName = Column | str

# Day-number epoch, and the weekday numberings in use.
DAY_NUMBER_EPOCH = dt.date(1960, 1, 1)
WEEKDAY_STYLES = ("monday0", "sunday1", "sunday0")


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _after_epoch(seconds: Column) -> Column:
    """Zoneless arithmetic: the time zone of the session plays no part."""
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def epoch_millis_to_timestamp(ms: ColumnOrName) -> Column:
    """Epoch milliseconds to a timestamp, milliseconds kept."""
    return _after_epoch((_col(ms).cast("bigint").cast("decimal(18,3)") / 1000).cast("decimal(18,6)"))


def epoch_millis_to_second(ms: ColumnOrName) -> Column:
    """Epoch milliseconds to a timestamp cut to whole seconds (integer division)."""
    seconds = F.call_function("div", _col(ms).cast("bigint"), F.lit(1000))
    return _after_epoch(seconds.cast("decimal(18,6)"))


def timestamp_to_epoch_millis(ts: ColumnOrName) -> Column:
    """Milliseconds from the epoch to a zoneless timestamp; smaller parts are cut."""
    c = _col(ts)
    days = F.unix_date(c.cast("date")).cast("bigint")
    minutes = (days * 24 + F.hour(c)) * 60 + F.minute(c)
    return minutes * 60_000 + (F.date_part(F.lit("SECOND"), c) * 1000).cast("bigint")


def weekday(ts: ColumnOrName, style: str = "monday0") -> Column:
    """Day of the week: Monday=0, Sunday=1 or Sunday=0."""
    if style == "monday0":
        return F.weekday(_col(ts))
    if style == "sunday1":
        return F.dayofweek(_col(ts))
    if style == "sunday0":
        return F.dayofweek(_col(ts)) - 1
    raise ValueError(f"weekday style {style!r} is not one of {WEEKDAY_STYLES}")


def calendar_parts(ts: ColumnOrName, weekday_style: str = "monday0") -> dict[str, Column]:
    """hour, day, ISO week, month, year and weekday, for ``withColumns``."""
    c = _col(ts)
    return {
        "hour": F.hour(c),
        "day": F.dayofmonth(c),
        "week": F.weekofyear(c),
        "month": F.month(c),
        "year": F.year(c),
        "weekday": weekday(c, weekday_style),
    }


def time_of_day(ts: ColumnOrName) -> Column:
    """HH:mm:ss from the parts, which have no zone."""
    c = _col(ts)
    hour, minute, second = (F.lpad(part(c).cast("string"), 2, "0") for part in (F.hour, F.minute, F.second))
    return F.concat(hour, F.lit(":"), minute, F.lit(":"), second)


def day_number_to_date(days: ColumnOrName, epoch: dt.date = DAY_NUMBER_EPOCH) -> Column:
    """Days since ``epoch`` to a date; fractions are cut, unusable values give null."""
    n = _col(days).try_cast("int")
    lowest = (dt.date.min - epoch).days
    highest = (dt.date.max - epoch).days
    return F.when(n.between(lowest, highest), F.date_add(F.lit(epoch), n))


def parse_compact_date(text: ColumnOrName) -> Column:
    """Month, day and four-digit year without separators; anything else gives null.

    A leading zero of month or day may be missing, as in common date parsers. Only such
    shorter texts need the pattern.
    """
    pattern = r"^(1[0-2]|0[1-9]|[1-9])(3[01]|[12]\d|0[1-9]|[1-9])(\d{4})$"
    c = _col(text)
    month, day, year = (F.regexp_extract(c, pattern, i) for i in (1, 2, 3))
    short = F.try_to_date(F.concat_ws("-", year, month, day), "yyyy-M-d")
    full = F.try_to_date(c, "MMddyyyy")
    return F.when(F.length(c) == 8, full).when(F.length(c).between(6, 7), short)


def parse_timestamp(text: ColumnOrName, fmt: str | None = None) -> Column:
    """Text to a timestamp; unusable values give null.

    ``fmt`` must not have a zone. The text is read at offset zero and taken back from
    there, so that a clock change in the zone of the session moves nothing.
    """
    c = _col(text)
    if fmt is None:
        return c.try_cast("timestamp_ntz")
    at_zero = F.try_to_timestamp(F.concat(c, F.lit(" +0000")), F.lit(f"{fmt} Z"))
    return _after_epoch((F.unix_micros(at_zero).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)"))


def text_to_date(text: ColumnOrName) -> Column:
    return _col(text).try_cast("date")
