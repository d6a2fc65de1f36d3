"""Create, drop and reset catalog tables from declared schemas."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession, types as T


def create_tables(
    spark: SparkSession,
    tables: Mapping[str, T.StructType],
    database: str = "default",
    location: str | None = None,
) -> list[str]:
    """Create each table unless it is there, in the order given."""
    for name, schema in tables.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        where = f" LOCATION '{location}/{name}'" if location else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet{where}")
    return list(tables)


def drop_tables(
    spark: SparkSession, tables: Mapping[str, T.StructType], database: str = "default"
) -> list[str]:
    """Drop each table if it is there, last created first."""
    for name in reversed(list(tables)):
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
    return list(tables)


def reset_tables(
    spark: SparkSession,
    tables: Mapping[str, T.StructType],
    database: str = "default",
    location: str | None = None,
) -> list[str]:
    """Drop all, then create all. Rows under an explicit ``location`` are not deleted."""
    drop_tables(spark, tables, database)
    return create_tables(spark, tables, database, location)
