"""Joins J1-J13."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.catalog import views
from starloom.catalog.registry import query
from starloom.operators import (
    Band,
    band_join,
    first_match_lookup,
    full_outer,
    lookup,
    loose_band_join,
    natural_key_join,
    pivot_back,
)
from starloom.plans import star
from starloom.sources import inline_mapping, table

JOINED_SQL = f"""
SELECT song_id, c.artist_id, session_id, item, user_id, p.song, p.length
FROM ({views.PLAY_LOG_SQL}) p {{how}} JOIN ({views.CATALOGUE_SQL}) c
  ON p.song = c.title AND p.artist = c.artist_name AND p.length = c.duration
WHERE p.page = 'N'
"""
JOINED = ["song_id", "artist_id", "sessionId", "itemInSession", "userId", "song", "length"]


def _named(df):
    return df.select(*JOINED).withColumnsRenamed(
        {"sessionId": "session_id", "itemInSession": "item", "userId": "user_id"}
    )


def _match(spark, sf, how):
    plays = star.plays(views.play_log(spark, sf), views.PLAY)
    songs = views.catalogue(spark, sf)
    return _named(natural_key_join(plays, songs, star.SONG_KEY, ["song_id", "artist_id"], how))


@query("join_inner_natural_key", JOINED_SQL.format(how="INNER"))
def join_inner_natural_key(spark, sf):
    return _match(spark, sf, "inner")


@query("join_left_natural_key", JOINED_SQL.format(how="LEFT"))
def join_left_natural_key(spark, sf):
    return _match(spark, sf, "left")


@query("join_implicit", JOINED_SQL.format(how="INNER"))
def join_implicit(spark, sf):
    """Comma join with the conditions in WHERE; Spark plans equal-key joins from it."""
    return spark.sql("""
        SELECT s.song_id, s.artist_id, e.sessionId AS session_id, e.itemInSession AS item,
               e.userId AS user_id, e.song, e.length
        FROM {staging_events} e, {staging_songs} s
        WHERE e.artist = s.artist_name AND e.song = s.title AND e.length = s.duration
          AND e.page = 'N'
    """, staging_events=views.play_log(spark, sf), staging_songs=views.catalogue(spark, sf))


@query("join_first_match_lookup", f"""
WITH c AS (
  SELECT title, artist_name, duration, min(song_id) AS song_id, min(artist_id) AS artist_id
  FROM ({views.CATALOGUE_SQL}) GROUP BY title, artist_name, duration)
SELECT song_id, c.artist_id, session_id, item, user_id, p.song, p.length
FROM ({views.PLAY_LOG_SQL}) p LEFT JOIN c
  ON p.song = c.title AND p.artist = c.artist_name AND p.length = c.duration
WHERE p.page = 'N'
""")
def join_first_match_lookup(spark, sf):
    """As many rows as plays, whatever the catalogue holds."""
    plays = star.plays(views.play_log(spark, sf), views.PLAY)
    songs = views.catalogue(spark, sf)
    return _named(first_match_lookup(
        plays, songs, star.SONG_KEY, ["song_id", "artist_id"], ["song_id"]
    ))


@query("join_code_lookups", """
SELECT l_orderkey, l_linenumber,
       CASE l_returnflag WHEN 'N' THEN 'none' WHEN 'R' THEN 'returned' END AS returned,
       l_linestatus, CASE l_linestatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'finished' END AS status,
       n_name AS nation, r_name AS region
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
""")
def join_code_lookups(spark, sf):
    """A chain of code lookups; one code is replaced, the others are kept or dropped."""
    flags = inline_mapping(spark, {"N": "none", "R": "returned"})
    states = inline_mapping(spark, {"O": "open", "F": "finished"})
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    lines = table(spark, sf, "lineitem").join(
        table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")
    ).select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "s_nationkey")
    named = lookup(lines, flags, "l_returnflag", "returned", keep_code=False)
    named = lookup(named, states, "l_linestatus", "status")
    regions = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    named = lookup(named, nation, "s_nationkey", "nation",
                   mapping_code="n_nationkey", mapping_label="n_name")
    return lookup(named, regions, "s_nationkey", "region", keep_code=False,
                  mapping_code="n_nationkey", mapping_label="r_name")


@query("join_role_playing", """
SELECT l_orderkey, l_linenumber, c_nationkey AS customer_nation_key, cn.n_name AS customer_nation,
       s_nationkey AS supplier_nation_key, sn.n_name AS supplier_nation
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN supplier ON l_suppkey = s_suppkey
LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey
LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey
""")
def join_role_playing(spark, sf):
    """One mapping in two roles."""
    nation = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("code"), F.col("n_name").alias("label")
    )
    lines = (
        table(spark, sf, "lineitem")
        .join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            "l_orderkey", "l_linenumber",
            F.col("c_nationkey").alias("customer_nation_key"),
            F.col("s_nationkey").alias("supplier_nation_key"),
        )
    )
    named = lookup(lines, nation, "customer_nation_key", "customer_nation")
    return lookup(named, nation, "supplier_nation_key", "supplier_nation")


@query("join_mixed_type_key", """
SELECT c_custkey, CAST(c_nationkey AS DOUBLE) AS code, n_name AS nation
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey % 5 <> 0
""")
def join_mixed_type_key(spark, sf):
    """Numeric codes against text codes, some of which are no numbers."""
    text = F.col("n_nationkey").cast("string")
    mapping = table(spark, sf, "nation").select(
        F.when(F.col("n_nationkey") % 5 == 0, F.concat(F.lit("bad "), text)).otherwise(text)
        .alias("code"),
        F.col("n_name").alias("label"),
    )
    customers = table(spark, sf, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("double").alias("code")
    )
    return lookup(customers, mapping, "code", "nation")


@query("join_left_composite", """
WITH pairs AS (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer),
     means AS (SELECT c_nationkey, c_mktsegment, avg(round(c_acctbal * 100)) / 100 AS mean_balance
               FROM customer WHERE c_acctbal > 9000 GROUP BY c_nationkey, c_mktsegment)
SELECT p.c_nationkey, p.c_mktsegment, mean_balance
FROM pairs p LEFT JOIN means m USING (c_nationkey, c_mktsegment)
""")
def join_left_composite(spark, sf):
    customer = table(spark, sf, "customer")
    keys = ["c_nationkey", "c_mktsegment"]
    rich = customer.filter("c_acctbal > 9000").groupBy(*keys).agg(
        _mean_of_cents("c_acctbal").alias("mean_balance")
    )
    return customer.select(*keys).distinct().join(rich, keys, "left")


@query("join_full_outer", """
WITH c AS (SELECT c_nationkey, c_mktsegment, count(*) AS customers FROM customer
           WHERE c_acctbal > 9000 GROUP BY c_nationkey, c_mktsegment),
     s AS (SELECT s_suppkey, s_nationkey, CASE WHEN s_acctbal < 2000 THEN 'AUTOMOBILE'
             WHEN s_acctbal < 4000 THEN 'BUILDING' WHEN s_acctbal < 8000 THEN 'MACHINERY' END
             AS s_segment FROM supplier)
SELECT s_suppkey, coalesce(s_nationkey, c_nationkey) AS nation,
       coalesce(s_segment, c_mktsegment) AS segment, customers
FROM s FULL JOIN c ON s_nationkey = c_nationkey AND s_segment = c_mktsegment
""")
def join_full_outer(spark, sf):
    """Suppliers and customer groups on two keys, either may miss the other."""
    groups = table(spark, sf, "customer").filter("c_acctbal > 9000").groupBy(
        "c_nationkey", "c_mktsegment"
    ).agg(F.count(F.lit(1)).alias("customers"))
    balance = F.col("s_acctbal")
    segment = F.when(balance < 2000, "AUTOMOBILE").when(balance < 4000, "BUILDING").when(
        balance < 8000, "MACHINERY"
    )
    suppliers = table(spark, sf, "supplier").select(
        "s_suppkey", "s_nationkey", segment.alias("s_segment")
    )
    both = full_outer(
        suppliers, groups, {"s_nationkey": "c_nationkey", "s_segment": "c_mktsegment"}
    )
    return both.select(
        "s_suppkey",
        F.coalesce("s_nationkey", "c_nationkey").alias("nation"),
        F.coalesce("s_segment", "c_mktsegment").alias("segment"),
        "customers",
    )


@query("join_band", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, o_orderdate
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE datediff('day', o_orderdate, l_shipdate) BETWEEN -4 AND 4
""")
def join_band(spark, sf):
    """Lines shipped within four days of their order."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
        F.unix_date(F.col("l_shipdate").cast("date")).alias("shipped"),
    )
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderdate",
        F.unix_date(F.col("o_orderdate").cast("date")).alias("ordered"),
    )
    near = band_join(
        lines, orders, {"l_orderkey": "o_orderkey"}, [Band("shipped", "ordered", 4, 4)]
    )
    return near.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "o_orderdate"
    )


SEGMENT_MEANS_SQL = """
SELECT c_nationkey AS mean_nation, c_mktsegment AS mean_segment,
       avg(round(c_acctbal * 100)) / 100 AS mean_balance
FROM customer GROUP BY c_nationkey, c_mktsegment
"""


def _mean_of_cents(column):
    """Sums of whole cents are exact, so the mean does not depend on row order."""
    return F.avg(F.round(F.col(column) * 100)) / 100


def _segment_means(spark, sf):
    """A few rows per nation, as one city name stands for a few places."""
    return table(spark, sf, "customer").groupBy(
        F.col("c_nationkey").alias("mean_nation"), F.col("c_mktsegment").alias("mean_segment")
    ).agg(_mean_of_cents("c_acctbal").alias("mean_balance"))


@query("join_band_binned", f"""
SELECT c_custkey, c_acctbal, mean_segment, mean_balance
FROM customer JOIN ({SEGMENT_MEANS_SQL}) ON c_nationkey = mean_nation
WHERE c_acctbal BETWEEN mean_balance - 250 AND mean_balance + 250
""")
def join_band_binned(spark, sf):
    """The band as part of the key, for keys with very many rows."""
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    near = band_join(
        customers, _segment_means(spark, sf), {"c_nationkey": "mean_nation"},
        [Band("c_acctbal", "mean_balance", 250, 250)], binned=True,
    )
    return near.select("c_custkey", "c_acctbal", "mean_segment", "mean_balance")


@query("join_band_or", f"""
SELECT c_custkey, c_acctbal, mean_segment, mean_balance
FROM customer JOIN ({SEGMENT_MEANS_SQL}) ON c_nationkey = mean_nation
WHERE c_acctbal = mean_balance OR c_acctbal <= mean_balance + 100
   OR c_acctbal >= mean_balance - 100
""")
def join_band_or(spark, sf):
    """Bounds joined by OR, as literally asked for: every non-null pair passes."""
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    loose = loose_band_join(
        customers, _segment_means(spark, sf), {"c_nationkey": "mean_nation"},
        [Band("c_acctbal", "mean_balance", 100, 100)],
    )
    return loose.select("c_custkey", "c_acctbal", "mean_segment", "mean_balance")


@query("join_pivot_back", """
SELECT c_nationkey, n_name, r_name,
       max(c_acctbal) FILTER (c_mktsegment = 'AUTOMOBILE') AS automobile,
       max(c_acctbal) FILTER (c_mktsegment = 'BUILDING') AS building,
       max(c_acctbal) FILTER (c_mktsegment = 'FURNITURE') AS furniture,
       max(c_acctbal) FILTER (c_mktsegment = 'HOUSEHOLD') AS household,
       max(c_acctbal) FILTER (c_mktsegment = 'MACHINERY') AS machinery
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY c_nationkey, n_name, r_name
""")
def join_pivot_back(spark, sf):
    """Attributes of a nation once, balances per segment beside them."""
    rows = (
        table(spark, sf, "customer")
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_nationkey", "n_name", "r_name", "c_mktsegment", "c_acctbal")
    )
    wide = pivot_back(rows, ["c_nationkey"], "c_mktsegment", "c_acctbal", list(views.SEGMENTS))
    return wide.withColumnsRenamed(views.SEGMENTS)


@query("join_left_notnull", """
SELECT o_orderkey, c_name, c_mktsegment FROM orders LEFT JOIN customer
  ON o_custkey = c_custkey AND c_acctbal > 0
WHERE c_custkey IS NOT NULL
""")
def join_left_notnull(spark, sf):
    """A left join without its unmatched rows; Spark turns it into an inner join."""
    rich = table(spark, sf, "customer").filter("c_acctbal > 0")
    joined = table(spark, sf, "orders").join(rich, F.col("o_custkey") == F.col("c_custkey"), "left")
    return joined.filter(F.col("c_custkey").isNotNull()).select(
        "o_orderkey", "c_name", "c_mktsegment"
    )
