"""Projection, filter, limit and order."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.catalog.registry import query
from starloom.catalog.storage import LINE_ORDER
from starloom.functions import epoch_millis_to_second, timestamp_to_epoch_millis
from starloom.operators import drop_blank, point_lookup, position_within, top_values
from starloom.sources import select_positions, table


@query("prj_select", "SELECT p_partkey, p_name, p_brand FROM part")
def prj_select(spark, sf):
    return table(spark, sf, "part").select("p_partkey", "p_name", "p_brand")


@query("prj_rename", """
SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey, c_acctbal,
       c_mktsegment AS segment FROM customer
""")
def prj_rename(spark, sf):
    names = {"c_custkey": "customer_id", "c_name": "customer_name", "c_mktsegment": "segment"}
    return table(spark, sf, "customer").withColumnsRenamed(names)


@query("prj_drop", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag,
       l_linestatus, l_shipdate FROM lineitem
""")
def prj_drop(spark, sf):
    return table(spark, sf, "lineitem").drop("l_discount", "l_tax")


@query("prj_select_expr", """
SELECT p_partkey AS part_id, CAST(p_size AS DOUBLE) AS size, upper(p_brand) AS brand,
       p_retailprice * 2 AS double_price FROM part
""")
def prj_select_expr(spark, sf):
    return table(spark, sf, "part").selectExpr(
        "P_PARTKEY AS part_id", "cast(p_size AS double) size", "upper(p_brand) brand",
        "p_retailprice * 2 AS double_price",
    )


@query("prj_positional", """
SELECT o_orderkey AS first, o_orderdate AS second, o_orderstatus AS third FROM orders
""")
def prj_positional(spark, sf):
    return select_positions(table(spark, sf, "orders"), [0, 4, 2], ["first", "second", "third"])


@query("prj_derived", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(month(o_orderdate) AS INTEGER) AS month, o_totalprice * 0.5 AS half_price,
       o_orderstatus || '/' || o_orderpriority AS tag FROM orders
""")
def prj_derived(spark, sf):
    return table(spark, sf, "orders").withColumns({
        "year": F.year("o_orderdate"),
        "month": F.month("o_orderdate"),
        "half_price": F.col("o_totalprice") * 0.5,
        "tag": F.concat_ws("/", "o_orderstatus", "o_orderpriority"),
    }).select("o_orderkey", "year", "month", "half_price", "tag")


@query("prj_subquery", """
SELECT date_trunc('second', ts) AS start_time, event_id, user_id, event_type FROM events
WHERE event_type = 'click'
""")
def prj_subquery(spark, sf):
    """A computed column before all others, then a filter."""
    events = table(spark, sf, "events").withColumn("ms", timestamp_to_epoch_millis("ts"))
    timed = events.select(epoch_millis_to_second("ms").alias("start_time"), "*")
    return timed.filter("event_type = 'click'").select(
        "start_time", "event_id", "user_id", "event_type"
    )


@query("flt_equality", "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'")
def flt_equality(spark, sf):
    events = table(spark, sf, "events").filter(F.col("event_type") == "purchase")
    return events.select("event_id", "user_id", "value")


@query("flt_point_lookup", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate FROM lineitem
WHERE l_orderkey = 66 AND l_linenumber = 4
""")
def flt_point_lookup(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate"
    )
    return point_lookup(lines, l_orderkey=66, l_linenumber=4)


@query("flt_non_blank", """
SELECT conv_id, turn, text FROM (
  SELECT conv_id, turn, CASE WHEN turn % 5 = 0 THEN '' WHEN turn % 5 = 1 THEN NULL ELSE text END
    AS text FROM conversations) WHERE text <> ''
""")
def flt_non_blank(spark, sf):
    """Rows without text, be it null or empty, are skipped."""
    blanked = F.when(F.col("turn") % 5 == 0, "").when(F.col("turn") % 5 != 1, F.col("text"))
    talk = table(spark, sf, "conversations").select("conv_id", "turn", blanked.alias("text"))
    return drop_blank(talk, "text")


@query("flt_null", """
SELECT c_custkey, s_suppkey IS NULL AS unmatched FROM customer LEFT JOIN supplier
ON c_custkey = s_suppkey
WHERE s_suppkey IS NULL OR s_acctbal IS NOT NULL
""")
def flt_null(spark, sf):
    joined = table(spark, sf, "customer").join(
        table(spark, sf, "supplier"), F.col("c_custkey") == F.col("s_suppkey"), "left"
    )
    kept = joined.filter(F.col("s_suppkey").isNull() | F.col("s_acctbal").isNotNull())
    return kept.select("c_custkey", F.col("s_suppkey").isNull().alias("unmatched"))


@query("limit_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def limit_n(spark, sf):
    """First rows of a table; ordered, so that they are always the same."""
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(
        "o_orderkey"
    ).limit(5)


@query("topk_frequency", """
SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_partkey IS NOT NULL
GROUP BY l_partkey ORDER BY n DESC, l_partkey LIMIT 10
""")
def topk_frequency(spark, sf):
    return top_values(table(spark, sf, "lineitem"), "l_partkey", 10)


@query("sort_within_key", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, row_number() OVER (
  PARTITION BY l_orderkey ORDER BY l_linenumber, {", ".join(LINE_ORDER)}) AS position
FROM lineitem
""")
def sort_within_key(spark, sf):
    """Place of each line in its order."""
    placed = position_within(
        table(spark, sf, "lineitem"), ["l_orderkey"], ["l_linenumber", *LINE_ORDER]
    )
    return placed.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "position")
