"""Physical plans as text."""

from pyspark.sql import DataFrame


def plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
