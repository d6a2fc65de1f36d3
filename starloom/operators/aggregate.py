"""Grouping, deduplication, set and domain operators.

All of them combine inside each map task before the shuffle, so a key with a large
share of the rows sends one partial row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

KEEP = ("distinct", "first", "last")


def dedupe(
    df: DataFrame, keys: Sequence[str], keep: str = "first", order: Sequence[str] = ()
) -> DataFrame:
    """Remove duplicates by policy.

    ``distinct`` keeps every different row. ``first`` and ``last`` keep one row per
    key by a declared order; nulls in the order lose either way. Rows that tie are
    ranked by their other columns that have an order, so the same rows give the same
    result however they are spread. Spark cuts each map task to one row per key before
    the shuffle.
    """
    if keep == "distinct":
        return df.distinct()
    ranked = df.withColumn("_rank", _rank(df, keys, keep, order))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def mark_kept(
    df: DataFrame, marks: Mapping[str, Sequence[str]], keep: str, order: Sequence[str]
) -> DataFrame:
    """Every row, with a flag per mark (flag -> keys): whether ``dedupe`` by these keys keeps it.

    Keys that hold the keys of the first mark need no shuffle of their own, nor does the first if
    the rows lie by some of its keys already. All rows of a key meet in one task.
    """
    return df.select("*", *[
        (_rank(df, keys, keep, order) == 1).alias(flag) for flag, keys in marks.items()
    ])


def _rank(df: DataFrame, keys: Sequence[str], keep: str, order: Sequence[str]) -> Column:
    if keep not in ("first", "last"):
        raise ValueError(f"keep {keep!r} is not one of {KEEP}")
    if not order:
        raise ValueError(f"keep={keep!r} needs an order")
    rest = [
        f.name for f in df.schema.fields
        if f.name not in {*order, *keys} and not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]
    columns = [*(F.col(c) for c in order), *(F.col(f"`{c}`") for c in rest)]
    ranked = [c.asc_nulls_last() if keep == "first" else c.desc_nulls_last() for c in columns]
    return F.row_number().over(Window.partitionBy(*keys).orderBy(*ranked))


def group_mean(df: DataFrame, keys: Sequence[str], means: Mapping[str, str]) -> DataFrame:
    """Mean of several columns (column -> output name) per key."""
    return df.groupBy(*keys).agg(*[F.avg(c).alias(out) for c, out in means.items()])


def pivot_values(
    df: DataFrame, keys: Sequence[str], column: str, values: Sequence[str], value: str
) -> DataFrame:
    """Rows to columns. The value list is given, so no extra job looks for it.

    A cell with several rows takes the largest value, which does not depend on row
    order; a cell without rows is null. One conditional aggregate per value needs one
    shuffle, where a built-in pivot groups twice.
    """
    cells = [F.max(F.when(F.col(column) == v, F.col(value))).alias(str(v)) for v in values]
    return df.groupBy(*keys).agg(*cells)


def count_where(df: DataFrame, condition: Column, name: str = "n") -> DataFrame:
    return df.filter(condition).agg(F.count(F.lit(1)).alias(name))


def table_shape(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table, one row per table."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"),
            "row_count",
            F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def frequency(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Rows per value, nulls left out."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(name))


def top_values(df: DataFrame, column: str, k: int = 10, name: str = "n") -> DataFrame:
    """The k most frequent values; ties go to the smaller value."""
    return frequency(df, column, name).orderBy(F.desc(name), F.asc(column)).limit(k)


def _domain(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.select(F.col(column).alias(name)).filter(F.col(name).isNotNull())


def union_domain(left: DataFrame, left_column: str, right: DataFrame, right_column: str):
    """Different values of both columns together."""
    a = _domain(left, left_column, "value").distinct()
    return a.union(_domain(right, right_column, "value").distinct()).distinct()


def domain_difference(left: DataFrame, left_column: str, right: DataFrame, right_column: str):
    """Values on one side only, with the side they are on."""
    a = _domain(left, left_column, "value").distinct().withColumn("side", F.lit(1))
    b = _domain(right, right_column, "value").distinct().withColumn("side", F.lit(2))
    sides = a.union(b).groupBy("value").agg(F.sum("side").alias("side"))
    return sides.filter("side < 3").select(
        "value", F.when(F.col("side") == 1, "left").otherwise("right").alias("only_in")
    )
