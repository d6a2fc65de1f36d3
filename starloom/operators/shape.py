"""Row filters. Projections and renames are plain DataFrame calls and need no helper."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from starloom.functions import is_blank


def drop_blank(df: DataFrame, *columns: str) -> DataFrame:
    """Keep rows in which every column has a value; the empty string is none."""
    return df.filter(~reduce(lambda a, b: a | b, [is_blank(c) for c in columns]))


def point_lookup(df: DataFrame, **values) -> DataFrame:
    """Rows with the given value in each column.

    All conditions reach the scan: as partition filters if the table is stored by
    that column, as pushed filters otherwise.
    """
    return df.filter(reduce(lambda a, b: a & b, [F.col(c) == F.lit(v) for c, v in values.items()]))
