"""Scalar functions X1-X19."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.catalog import views
from starloom.catalog.registry import query
from starloom.functions import (
    after_comma,
    after_dash,
    before_comma,
    calendar_parts,
    day_number_to_date,
    epoch_millis_to_second,
    epoch_millis_to_timestamp,
    extract_pairs,
    fact_key,
    full_name,
    parse_compact_date,
    parse_timestamp,
    signed_coordinate,
    strip_letters,
    text_to_date,
    text_to_double,
    time_of_day,
    timestamp_to_epoch_millis,
    weekday,
)
from starloom.operators import dense_id
from starloom.sources import table


def _events(spark, sf):
    return table(spark, sf, "events").withColumn("ms", timestamp_to_epoch_millis("ts"))


@query("fn_epoch_millis", """
SELECT event_id, epoch_us(ts) // 1000 AS ms, date_trunc('milliseconds', ts) AS start_time FROM events
""")
def fn_epoch_millis(spark, sf):
    return _events(spark, sf).select(
        "event_id", "ms", epoch_millis_to_timestamp("ms").alias("start_time")
    )


@query("fn_epoch_seconds", "SELECT event_id, date_trunc('second', ts) AS start_time FROM events")
def fn_epoch_seconds(spark, sf):
    return _events(spark, sf).select("event_id", epoch_millis_to_second("ms").alias("start_time"))


@query("fn_calendar_parts", """
SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(day(ts) AS INTEGER) AS day,
       CAST(weekofyear(ts) AS INTEGER) AS week, CAST(month(ts) AS INTEGER) AS month,
       CAST(year(ts) AS INTEGER) AS year, CAST(isodow(ts) - 1 AS INTEGER) AS weekday FROM events
""")
def fn_calendar_parts(spark, sf):
    events = table(spark, sf, "events").withColumns(calendar_parts("ts"))
    return events.select("event_id", "hour", "day", "week", "month", "year", "weekday")


@query("fn_weekday_styles", """
SELECT event_id, CAST(isodow(ts) - 1 AS INTEGER) AS monday0,
       CAST(dayofweek(ts) + 1 AS INTEGER) AS sunday1, CAST(dayofweek(ts) AS INTEGER) AS sunday0
FROM events
""")
def fn_weekday_styles(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", *[weekday("ts", s).alias(s) for s in ("monday0", "sunday1", "sunday0")]
    )


@query("fn_time_of_day", "SELECT event_id, strftime(ts, '%H:%M:%S') AS start_time FROM events")
def fn_time_of_day(spark, sf):
    return table(spark, sf, "events").select("event_id", time_of_day("ts").alias("start_time"))


@query("fn_md5_key", """
SELECT event_id, md5(CAST(user_id AS VARCHAR) || strftime(ts, '%Y-%m-%d %H:%M:%S')) AS songplay_id
FROM events
""")
def fn_md5_key(spark, sf):
    return table(spark, sf, "events").select("event_id", fact_key("user_id", "ts").alias("songplay_id"))


@query("fn_surrogate_key", """
SELECT p_partkey, row_number() OVER (ORDER BY p_name, p_brand, p_partkey) AS id FROM part
""")
def fn_surrogate_key(spark, sf):
    """Ids without gaps, in a total order."""
    parts = table(spark, sf, "part").select("p_name", "p_brand", "p_partkey")
    return dense_id(parts, ["p_name", "p_brand", "p_partkey"]).select("p_partkey", "id")


@query("fn_full_name", """
SELECT c_custkey, concat_ws(' ', c_mktsegment, c_name) AS name FROM customer
""")
def fn_full_name(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", full_name("c_mktsegment", "c_name").alias("name")
    )


@query("fn_regex_strip", """
SELECT p_partkey, regexp_replace(p_brand, '[a-zA-Z]+', '', 'g') AS no_letters,
       p_name AS head, ' ' || p_brand AS tail, p_type AS region
FROM part
""")
def fn_regex_strip(spark, sf):
    """Without letters, up to a comma, after a comma, after a dash."""
    pair = F.concat_ws(", ", "p_name", "p_brand")
    return table(spark, sf, "part").select(
        "p_partkey",
        strip_letters("p_brand").alias("no_letters"),
        before_comma(pair).alias("head"),
        after_comma(pair).alias("tail"),
        after_dash(F.concat_ws("-", "p_brand", "p_type")).alias("region"),
    )


@query("fn_try_cast", """
SELECT c_custkey, TRY_CAST(regexp_replace(c_name, '[a-zA-Z#]+', '', 'g') AS DOUBLE) AS good,
       CAST(NULL AS DOUBLE) AS bad,
       CASE WHEN c_nationkey % 2 = 0 THEN 1 ELSE -1 END *
         CAST(CAST(c_nationkey AS VARCHAR) || '.25' AS DOUBLE) AS degrees
FROM customer
""")
def fn_try_cast(spark, sf):
    """Numbers in text; a text with other signs in it gives null."""
    bare = F.regexp_replace(strip_letters("c_name"), "#", "")
    side = F.when(F.col("c_nationkey") % 2 == 0, "N").otherwise("S")
    degrees = F.concat(F.col("c_nationkey").cast("string"), F.lit(".25"), side)
    return table(spark, sf, "customer").select(
        "c_custkey",
        text_to_double(bare).alias("good"),
        text_to_double(strip_letters("c_name")).alias("bad"),
        signed_coordinate(degrees).alias("degrees"),
    )


@query("fn_round", """
SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice) AS whole,
       round(-l_quantity / 2) AS half FROM lineitem
""")
def fn_round(spark, sf):
    """Half rounds away from zero."""
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round("l_extendedprice").alias("whole"),
        F.round(-F.col("l_quantity") / 2).alias("half"),
    )


@query("fn_arithmetic", """
SELECT l_orderkey, l_linenumber, l_quantity + 4 AS upper, l_quantity - 4 AS lower,
       l_quantity * -1 AS negated FROM lineitem
""")
def fn_arithmetic(spark, sf):
    quantity = F.col("l_quantity")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (quantity + 4).alias("upper"), (quantity - 4).alias("lower"),
        (quantity * -1).alias("negated"),
    )


@query("fn_sas_date", """
SELECT p_partkey, CASE WHEN p_size % 7 <> 0 THEN DATE '1960-01-01' + p_size END AS day,
       CASE WHEN p_size % 7 <> 0 THEN DATE '1960-01-01' + CAST(floor(p_retailprice) AS INTEGER) END
         AS later
FROM part
""")
def fn_sas_date(spark, sf):
    """Day numbers as text or double; missing or unusable ones give null."""
    size = F.col("p_size")
    text = F.when(size % 7 == 0, "n/a").otherwise(size.cast("string"))
    number = F.when(size % 7 != 0, F.col("p_retailprice"))
    return table(spark, sf, "part").select(
        "p_partkey", day_number_to_date(text).alias("day"), day_number_to_date(number).alias("later")
    )


@query("fn_parse_date", """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END AS day,
       CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate END AS moment
FROM orders
""")
def fn_parse_date(spark, sf):
    """Month, day and year without separators, and time stamps; bad text gives null."""
    bad = F.col("o_orderkey") % 7 == 0
    day = F.when(bad, "D/S").otherwise(F.date_format("o_orderdate", "MMddyyyy"))
    moment = F.when(bad, "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return table(spark, sf, "orders").select(
        "o_orderkey", parse_compact_date(day).alias("day"), parse_timestamp(moment).alias("moment")
    )


@query("fn_cast_date", """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS day
FROM orders
""")
def fn_cast_date(spark, sf):
    text = F.when(F.col("o_orderstatus") == "P", "unknown").otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    return table(spark, sf, "orders").select("o_orderkey", text_to_date(text).alias("day"))


@query("fn_initcap", f"""
SELECT p_partkey, {views.initcap_sql("p_name")} AS name,
       upper(left(p_type, 1)) || lower(substr(p_type, 2)) || '-' || lower(p_brand) AS tag
FROM part
""")
def fn_initcap(spark, sf):
    """Only blanks start a new word."""
    return table(spark, sf, "part").select(
        "p_partkey", F.initcap("p_name").alias("name"),
        F.initcap(F.concat_ws("-", "p_type", "p_brand")).alias("tag"),
    )


@query("fn_extract_pairs", """
SELECT page_id, unnest(regexp_extract_all(url, '[?&]([a-z_]+)=([^&#]*)', 1)) AS code,
       unnest(regexp_extract_all(url, '[?&]([a-z_]+)=([^&#]*)', 2)) AS label
FROM pages
""")
def fn_extract_pairs(spark, sf):
    """All matches of a two-group pattern as rows."""
    pairs = F.explode(extract_pairs("url", "[?&]([a-z_]+)=([^&#]*)"))
    found = table(spark, sf, "pages").select("page_id", pairs.alias("pair"))
    return found.select("page_id", "pair.code", "pair.label")


@query("fn_json_path", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS amount,
       json_extract_string(props, '$.missing') AS missing FROM events
""")
def fn_json_path(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        F.get_json_object("props", "$.k").try_cast("bigint").alias("amount"),
        F.get_json_object("props", "$.missing").alias("missing"),
    )
