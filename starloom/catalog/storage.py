"""Sinks, load policies, upserts, table lifecycle and the incremental load."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.catalog import views
from starloom.catalog.registry import query
from starloom.schemas import LONG, STRING, struct
from starloom.session import drop_later, scratch_path
from starloom.sinks import (
    cluster,
    create_tables,
    drop_tables,
    load,
    load_path,
    upsert_into,
    write_bucketed,
    write_csv,
    write_parquet,
)
from starloom.sources import read_csv, read_parquet, select_positions, table
from starloom.streaming import FileFeed, incremental_upsert

LINE_ORDER = [
    "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus",
]
LINE_ORDER_SQL = ", ".join(f"{c} DESC" for c in LINE_ORDER)

LAST_EVENT_SQL = """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r
  FROM events) WHERE r = 1
"""


@query("sink_parquet", "SELECT * FROM part")
def sink_parquet(spark, sf):
    root = scratch_path(spark, "parquet")
    part = table(spark, sf, "part")
    write_parquet(part, root)
    return read_parquet(spark, root, part.schema)


@query("sink_partitioned", """
SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year,
       CASE WHEN o_orderstatus <> 'P' THEN CAST(month(o_orderdate) AS INTEGER) END AS month
FROM orders
""")
def sink_partitioned(spark, sf):
    """One folder per year and month; the month of pending orders is not known."""
    root = scratch_path(spark, "partitioned")
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"),
        F.when(F.col("o_orderstatus") != "P", F.month("o_orderdate")).alias("month"),
    )
    write_parquet(orders, root, ["year", "month"])
    return read_parquet(spark, root, orders.schema)


@query("sink_csv", "SELECT p_partkey, p_name FROM part")
def sink_csv(spark, sf):
    """A mapping table as CSV."""
    root = scratch_path(spark, "sink-csv")
    mapping = table(spark, sf, "part").select("p_partkey", "p_name")
    write_csv(mapping, root)
    return read_csv(spark, root, mapping.schema)


@query("sink_csv_quoted", f"""
SELECT artist, CAST(item AS BIGINT) AS item, length, session_id, song
FROM ({views.PLAY_LOG_SQL})
""")
def sink_csv_quoted(spark, sf):
    """The play log cut to some fields by position, every field quoted."""
    root = scratch_path(spark, "sink-quoted")
    log = views.play_log(spark, sf).withColumn("itemInSession", F.col("itemInSession").cast("bigint"))
    names = ["artist", "item", "length", "session_id", "song"]
    flat = select_positions(log, [0, 1, 2, 6, 7], names)
    write_csv(flat, root, quote_all=True)
    return read_csv(spark, root, flat.schema, ignoreLeadingWhiteSpace=True)


@query("sink_append", """
SELECT o_orderkey AS play, o_orderstatus AS level FROM orders
UNION ALL SELECT o_orderkey, o_orderstatus FROM orders
""")
def sink_append(spark, sf):
    """Two positional appends of the same rows: all of them twice."""
    root = scratch_path(spark, "append")
    declared = struct(play=LONG, level=STRING)
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    for _ in range(2):
        load_path(orders, root, declared)
    return read_parquet(spark, root, declared)


@query("sink_truncate", "SELECT o_orderkey AS play, o_orderstatus AS level FROM orders")
def sink_truncate(spark, sf):
    """Two truncating loads: the rows once."""
    root = scratch_path(spark, "truncate")
    declared = struct(play=LONG, level=STRING)
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    for _ in range(2):
        load_path(orders, root, declared, operation="truncate")
    return read_parquet(spark, root, declared)


@query("upsert_last_wins", LAST_EVENT_SQL)
def upsert_last_wins(spark, sf):
    """Two batches into a versioned table; the newer one comes first on purpose."""
    root = scratch_path(spark, "upsert")
    events = table(spark, sf, "events")
    late = F.col("event_type").isin("click", "view")
    upsert_into(events.filter(late), root, ["user_id"], ["ts", "event_id"])
    return upsert_into(events.filter(~late), root, ["user_id"], ["ts", "event_id"])


@query("upsert_composite_key", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate
FROM (SELECT *, row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER_SQL}) AS r
      FROM lineitem) WHERE r = 1
""")
def upsert_composite_key(spark, sf):
    """Keyed insert with silent overwrite on a two-column key.

    Two batches that share keys, the one with the newer rows first: stored rows are
    overwritten by some rows of the second batch and not by others.
    """
    root = scratch_path(spark, "upsert-composite")
    keys = ["l_orderkey", "l_linenumber"]
    lines = table(spark, sf, "lineitem")
    newer = F.col("l_shipdate") >= F.to_timestamp_ntz(F.lit("1998-06-01"))
    upsert_into(lines.filter(newer), root, keys, LINE_ORDER)
    older = lines.filter(~newer | (F.col("l_quantity") > 25))
    merged = upsert_into(older, root, keys, LINE_ORDER)
    return merged.select(
        *keys, "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"
    )


@query("ddl_reset", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def ddl_reset(spark, sf):
    """Create, load, drop, create again and load: the rows are there once."""
    root = scratch_path(spark, "ddl")
    database = "starloom_" + root.rsplit("-", 1)[1]
    supplier = table(spark, sf, "supplier")
    tables = {"supplier": supplier.schema}
    drop_later(spark, database, kind="DATABASE")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}'")
    for _ in range(2):
        drop_tables(spark, tables, database)
        create_tables(spark, tables, database)
        create_tables(spark, tables, database)
        load(supplier, f"{database}.supplier")
    return spark.table(f"{database}.supplier")


@query("layout_clustered", "SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM orders")
def layout_clustered(spark, sf):
    """Orders stored by customer and, within, by date."""
    root = scratch_path(spark, "clustered")
    orders = table(spark, sf, "orders").select(
        "o_custkey", "o_orderdate", "o_orderkey", "o_totalprice"
    )
    write_parquet(cluster(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]), root)
    return read_parquet(spark, root, orders.schema)


@query("layout_bucketed", """
SELECT o_orderkey, o_custkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey
""")
def layout_bucketed(spark, sf):
    """Two tables bucketed by the same key join without a shuffle."""
    root = scratch_path(spark, "bucketed")
    name = "starloom_" + root.rsplit("-", 1)[1]
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf, "customer").select("c_custkey", "c_name")
    drop_later(spark, f"{name}_orders", f"{name}_customer")
    write_bucketed(orders, f"{name}_orders", ["o_custkey"], 8, path=f"{root}/orders")
    write_bucketed(customer, f"{name}_customer", ["c_custkey"], 8, path=f"{root}/customer")
    joined = spark.table(f"{name}_orders").join(
        spark.table(f"{name}_customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    return joined.select("o_orderkey", "o_custkey", "c_name")


@query("stream_incremental_upsert", LAST_EVENT_SQL)
def stream_incremental_upsert(spark, sf):
    """Two runs over an inbox; the second finds older rows that must not win."""
    inbox, target = scratch_path(spark, "inbox"), scratch_path(spark, "stream")
    events = table(spark, sf, "events")
    feed = FileFeed(inbox, events.schema, files_per_batch=2)
    older = F.col("event_type").isin("click", "view")
    for part in (events.filter(~older), events.filter(older)):
        part.hint("rebalance").write.mode("append").parquet(inbox)
        merged = incremental_upsert(spark, feed, target, ["user_id"], ["ts", "event_id"])
    return merged
