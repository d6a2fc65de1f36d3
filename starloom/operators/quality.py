"""Data-quality jobs. Findings are DataFrames; gates raise when asked to."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

COMPARISONS = ("less", "more", "equal")


class CheckFailed(Exception):
    """Raised after all checks ran; carries every failure."""

    def __init__(self, failures: Sequence[str]):
        super().__init__("; ".join(failures))
        self.failures = list(failures)


def threshold_checks(spark: SparkSession, checks: Iterable[Mapping], fail: bool = True) -> DataFrame:
    """Compare the first value of each query with an expected number.

    A check is ``{"query", "how", "expected_value"}`` with ``how`` less, more or
    equal. A query without rows fails its check. All checks run in one job; with
    ``fail`` the failures are collected (one row per check at most) and raised.
    """
    parts = []
    for check in checks:
        how, expected = check["how"], float(check["expected_value"])
        if how not in COMPARISONS:
            raise ValueError(f"how {how!r} is not one of {COMPARISONS}")
        answer = spark.sql(check["query"]).limit(1)
        first = F.col(f"`{answer.columns[0]}`").cast("double")
        # The aggregate turns an empty answer into one row with null.
        actual = answer.agg(F.max(first).alias("actual"))
        test = {
            "less": F.col("actual") < expected,
            "more": F.col("actual") > expected,
            "equal": F.col("actual") == expected,
        }[how]
        parts.append(actual.select(
            F.lit(check["query"]).alias("query"),
            F.lit(how).alias("how"),
            F.lit(expected).alias("expected"),
            "actual",
            F.coalesce(test, F.lit(False)).alias("passed"),
        ))
    report = reduce(DataFrame.unionByName, parts)
    if fail:
        bad = report.filter(~F.col("passed")).collect()
        if bad:
            raise CheckFailed(
                [f"{r['query']}: {r['actual']} is not {r['how']} {r['expected']}" for r in bad]
            )
    return report


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column in one pass, one row per column."""
    names = list(columns or df.columns)
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in names])
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("null_count")) for c in names
    ])
    return counts.select(F.inline(pairs))


def duplicate_keys(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Keys held by more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).filter(F.col(name) > 1)


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows of the child whose key is not null and has no parent."""
    known = parent.select(F.col(parent_key).alias("_parent"))
    keyed = child.filter(F.col(child_key).isNotNull())
    return keyed.join(known, keyed[child_key] == known["_parent"], "left_anti")


def declared_violations(
    tables: Mapping[str, DataFrame],
    primary: Mapping[str, Sequence[str]],
    foreign: Iterable[tuple[str, str, str, str]] = (),
) -> DataFrame:
    """Rows that break declared keys: (table_name, rule, violations), one row per rule.

    ``primary`` maps a table to its key; null in it and repeated values both count.
    ``foreign`` lists (child, child column, parent, parent column). Rules on tables that
    are not given are left out.
    """
    def counted(df: DataFrame, name: str, rule: str) -> DataFrame:
        total = df.agg(F.count(F.lit(1)).alias("violations"))
        return total.select(
            F.lit(name).alias("table_name"), F.lit(rule).alias("rule"), "violations"
        )

    parts = []
    for name, keys in primary.items():
        if name in tables:
            missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
            label = ", ".join(keys)
            parts.append(counted(tables[name].filter(missing), name, f"not null {label}"))
            whole = tables[name].filter(~missing)
            parts.append(counted(duplicate_keys(whole, keys), name, f"unique {label}"))
    for child, child_key, parent, parent_key in foreign:
        if child in tables and parent in tables:
            lost = orphans(tables[child], child_key, tables[parent], parent_key)
            parts.append(counted(lost, child, f"{child_key} in {parent}"))
    return reduce(DataFrame.unionByName, parts)


def length_overflow(df: DataFrame, widths: Mapping[str, int]) -> DataFrame:
    """Per column: values longer than the declared width, and the longest length."""
    names = list(widths)
    aggregates = []
    for i, c in enumerate(names):
        aggregates.append(F.count_if(F.length(c) > widths[c]).alias(f"over{i}"))
        aggregates.append(F.max(F.length(c)).cast("bigint").alias(f"longest{i}"))
    rows = F.array(*[
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(widths[c]).cast("bigint").alias("width"),
            F.col(f"over{i}").alias("too_long"),
            F.col(f"longest{i}").alias("longest"),
        )
        for i, c in enumerate(names)
    ])
    return df.agg(*aggregates).select(F.inline(rows))


def non_empty(tables: Mapping[str, DataFrame], fail: bool = False) -> DataFrame:
    """Whether each table has a column and a row; reads one row per table."""
    probes = [
        df.limit(1).agg((F.count(F.lit(1)) > 0).alias("passed")).select(
            F.lit(name).alias("table_name"),
            (F.col("passed") & F.lit(len(df.columns) > 0)).alias("passed"),
        )
        for name, df in tables.items()
    ]
    report = reduce(DataFrame.unionByName, probes)
    if fail:
        bad = report.filter(~F.col("passed")).collect()
        if bad:
            raise CheckFailed([f"{r['table_name']} is empty" for r in bad])
    return report
