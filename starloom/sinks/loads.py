"""Load policies of a table: append, or truncate and insert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

OPERATIONS = ("append", "truncate")


def conform_positions(
    df: DataFrame, schema: T.StructType, columns: Sequence[str] | None = None
) -> DataFrame:
    """Name and cast columns by position, as an insert does.

    ``columns`` lists the target columns that the input fills, in input order; the
    others become null. Without it the input fills all columns.
    """
    filled = list(columns or schema.names)
    if len(df.columns) != len(filled):
        raise ValueError(f"{len(df.columns)} columns for {len(filled)} in the target")
    unknown = set(filled) - set(schema.names)
    if unknown:
        raise ValueError(f"no such columns in the target: {sorted(unknown)}")
    renamed = df.toDF(*[f"_{i}" for i in range(len(filled))])
    source = {name: F.col(f"_{i}") for i, name in enumerate(filled)}
    return renamed.select([
        source.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ])


def _check(operation: str) -> None:
    if operation not in OPERATIONS:
        raise ValueError(f"operation {operation!r} is not one of {OPERATIONS}")


def load(
    df: DataFrame, target: str, operation: str = "append", columns: Sequence[str] | None = None
) -> None:
    """Insert into a catalog table by position, after emptying it if asked to."""
    _check(operation)
    rows = conform_positions(df, df.sparkSession.table(target).schema, columns)
    rows.write.insertInto(target, overwrite=operation == "truncate")


def load_append(df: DataFrame, target: str, columns: Sequence[str] | None = None) -> None:
    load(df, target, "append", columns)


def load_truncate(df: DataFrame, target: str, columns: Sequence[str] | None = None) -> None:
    load(df, target, "truncate", columns)


def load_path(
    df: DataFrame,
    path: str,
    schema: T.StructType,
    operation: str = "append",
    columns: Sequence[str] | None = None,
) -> None:
    """The same for a parquet folder that no catalog knows."""
    _check(operation)
    mode = "overwrite" if operation == "truncate" else "append"
    conform_positions(df, schema, columns).write.mode(mode).parquet(path)
