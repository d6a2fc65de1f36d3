"""Aggregation, distinct, set operations and last row per key."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.catalog import views
from starloom.catalog.registry import query
from starloom.catalog.storage import LAST_EVENT_SQL
from starloom.operators import (
    count_where,
    dedupe,
    domain_difference,
    frequency,
    group_mean,
    pivot_values,
    table_shape,
    union_domain,
)
from starloom.sources import table

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


@query("agg_group_mean", """
SELECT s_nationkey, CAST(s_suppkey % 2 AS BIGINT) AS side,
       avg(round(s_acctbal * 100)) AS mean_cents, avg(s_suppkey) AS mean_key
FROM supplier GROUP BY s_nationkey, s_suppkey % 2
""")
def agg_group_mean(spark, sf):
    """Mean of two columns on two keys; sums of whole numbers are exact in any order."""
    suppliers = table(spark, sf, "supplier").withColumns({
        "side": F.col("s_suppkey") % 2, "cents": F.round(F.col("s_acctbal") * 100)
    })
    return group_mean(
        suppliers, ["s_nationkey", "side"], {"cents": "mean_cents", "s_suppkey": "mean_key"}
    )


def _pivot_cells(function: str, column: str) -> str:
    return ", ".join(
        f"{function}({column}) FILTER (c_mktsegment = '{s}') AS {name}"
        for s, name in views.SEGMENTS.items()
    )


@query("agg_pivot", f"""
SELECT c_nationkey, {_pivot_cells("max", "c_acctbal")} FROM customer GROUP BY c_nationkey
""")
def agg_pivot(spark, sf):
    wide = pivot_values(
        table(spark, sf, "customer"), ["c_nationkey"], "c_mktsegment", list(views.SEGMENTS),
        "c_acctbal",
    )
    return wide.withColumnsRenamed(views.SEGMENTS)


@query("agg_distinct_rows", f"""
SELECT DISTINCT artist, song, length, level FROM ({views.PLAY_LOG_SQL})
""")
def agg_distinct_rows(spark, sf):
    return views.play_log(spark, sf).select("artist", "song", "length", "level").distinct()


@query("agg_dedupe_key", """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events)
WHERE r = 1
""")
def agg_dedupe_key(spark, sf):
    return dedupe(table(spark, sf, "events"), ["user_id"], "first", ["ts", "event_id"])


@query("win_last_per_key", LAST_EVENT_SQL)
def win_last_per_key(spark, sf):
    return dedupe(table(spark, sf, "events"), ["user_id"], "last", ["ts", "event_id"])


@query("agg_count_where", "SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'F'")
def agg_count_where(spark, sf):
    return count_where(table(spark, sf, "orders"), F.col("o_orderstatus") == "F")


@query("agg_table_shape", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS row_count, "
    f"(SELECT count(*) FROM (DESCRIBE {t})) AS column_count"
    for t in TABLES
))
def agg_table_shape(spark, sf):
    return table_shape({name: table(spark, sf, name) for name in TABLES})


@query("agg_value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def agg_value_counts(spark, sf):
    return frequency(table(spark, sf, "events"), "event_type")


@query("agg_count_distinct", """
SELECT count(DISTINCT user_id) AS users, count(DISTINCT event_type) AS types FROM events
""")
def agg_count_distinct(spark, sf):
    return table(spark, sf, "events").agg(
        F.countDistinct("user_id").alias("users"), F.countDistinct("event_type").alias("types")
    )


@query("set_union_distinct", """
SELECT count(*) AS n FROM (SELECT c_nationkey FROM customer UNION SELECT s_nationkey FROM supplier)
""")
def set_union_distinct(spark, sf):
    both = union_domain(
        table(spark, sf, "customer"), "c_nationkey", table(spark, sf, "supplier"), "s_nationkey"
    )
    return both.agg(F.count(F.lit(1)).alias("n"))


@query("set_union_all", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def set_union_all(spark, sf):
    """Rows of several inputs, columns matched by name."""
    orders = table(spark, sf, "orders")
    finished = orders.filter("o_orderstatus = 'F'").select(
        "o_orderkey", "o_custkey", "o_orderstatus"
    )
    others = orders.filter("o_orderstatus <> 'F' OR o_orderstatus IS NULL").select(
        "o_custkey", "o_orderstatus", "o_orderkey"
    )
    return finished.unionByName(others)


@query("set_domain_diff", """
WITH a AS (SELECT DISTINCT o_custkey AS value FROM orders),
     b AS (SELECT DISTINCT s_suppkey * 2 AS value FROM supplier)
SELECT value, 'left' AS only_in FROM a WHERE value NOT IN (SELECT value FROM b)
UNION ALL
SELECT value, 'right' FROM b WHERE value NOT IN (SELECT value FROM a)
""")
def set_domain_diff(spark, sf):
    """Keys that one of two tables does not have."""
    suppliers = table(spark, sf, "supplier").select((F.col("s_suppkey") * 2).alias("code"))
    return domain_difference(table(spark, sf, "orders"), "o_custkey", suppliers, "code")
