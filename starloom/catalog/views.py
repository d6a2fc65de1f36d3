"""The given tables in the shape of the inputs that the operators expect, and the
same derivations as SQL for the comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.functions import timestamp_to_epoch_millis
from starloom.sources import inline_mapping, table

# The page value that counts as a play in the derived log.
PLAY = "N"
# Categories of the derived city statistics.
SEGMENTS = {
    "AUTOMOBILE": "automobile",
    "BUILDING": "building",
    "FURNITURE": "furniture",
    "HOUSEHOLD": "household",
    "MACHINERY": "machinery",
}
# Load order of the derived log: total within a session item.
LOG_ORDER = [
    "loaded_at", "part", "supplier", "price", "quantity", "discount", "tax", "page", "userAgent",
]

# Titles carry a volume number, so that (title, artist, length) stays almost unique
# however many parts there are; two parts per key is the most that can meet.
TITLE_SQL = "p_name || ' vol. ' || CAST(p_partkey // 2000 AS VARCHAR)"


def _title():
    volume = F.floor(F.col("p_partkey") / 2000).cast("string")
    return F.concat(F.col("p_name"), F.lit(" vol. "), volume)


def catalogue(spark: SparkSession, sf: str) -> DataFrame:
    """Song metadata: parts of up to size 40, so that some plays have no match."""
    return _songs(table(spark, sf, "part").filter("p_size <= 40"))


def whole_catalogue(spark: SparkSession, sf: str) -> DataFrame:
    """Song metadata of all parts, for the dimensions."""
    return _songs(table(spark, sf, "part"))


def _songs(parts: DataFrame) -> DataFrame:
    return parts.select(
        F.lit("1").alias("num_songs"),
        F.concat(F.lit("AR-"), "p_brand").alias("artist_id"),
        F.lit(None).cast("double").alias("artist_latitude"),
        F.lit(None).cast("double").alias("artist_longitude"),
        F.lit(None).cast("string").alias("artist_location"),
        F.col("p_brand").alias("artist_name"),
        F.col("p_partkey").alias("song_id"),
        _title().alias("title"),
        F.col("p_retailprice").alias("duration"),
        (F.col("p_size") + 1970).alias("year"),
    )


WHOLE_CATALOGUE_SQL = f"""
  SELECT 'AR-' || p_brand AS artist_id, p_brand AS artist_name, p_partkey AS song_id,
         {TITLE_SQL} AS title, p_retailprice AS duration, p_size + 1970 AS year
  FROM part
"""
CATALOGUE_SQL = f"{WHOLE_CATALOGUE_SQL} WHERE p_size <= 40"


def play_log(spark: SparkSession, sf: str, names: bool = False) -> DataFrame:
    """Play log: a session is an order, an item is a line. ``names`` adds user names.

    Columns are derived before the joins: once per part and order, not once per line.
    """
    lines = table(spark, sf, "lineitem").select(
        F.col("l_linenumber").alias("itemInSession"),
        F.col("l_returnflag").alias("page"),
        F.col("l_linestatus").alias("userAgent"),
        F.col("l_shipdate").alias("loaded_at"),
        F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supplier"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        "l_orderkey",
    )
    songs = table(spark, sf, "part").select(
        "p_partkey",
        F.col("p_brand").alias("artist"),
        F.col("p_retailprice").alias("length"),
        _title().alias("song"),
    )
    sessions = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("sessionId"),
        F.col("o_orderstatus").alias("level"),
        F.col("o_orderpriority").alias("location"),
        timestamp_to_epoch_millis("o_orderdate").alias("ts"),
        F.col("o_custkey").alias("userId"),
    )
    columns = [
        "artist", "itemInSession", "length", "level", "location", "page", "sessionId", "song",
        "ts", "userAgent", "userId", *(c for c in LOG_ORDER if c not in ("page", "userAgent")),
    ]
    if names:
        users = table(spark, sf, "customer").select(
            "c_custkey",
            F.col("c_mktsegment").alias("firstName"),
            F.col("c_name").alias("lastName"),
        )
        # Joined to sessions, of which there are fewer than lines.
        sessions = sessions.join(users, F.col("userId") == F.col("c_custkey"))
        columns += ["firstName", "lastName"]
    # Sessions come last, so that the log lies by session.
    log = lines.join(songs, F.col("part") == F.col("p_partkey")).join(
        sessions, F.col("l_orderkey") == F.col("sessionId")
    )
    return log.select(*columns)


PLAY_LOG_SQL = f"""
  SELECT p_brand AS artist, l_linenumber AS item, p_retailprice AS length,
         o_orderstatus AS level, o_orderpriority AS location, l_returnflag AS page,
         o_orderkey AS session_id, {TITLE_SQL} AS song, o_orderdate AS start_time,
         l_linestatus AS user_agent, o_custkey AS user_id, l_shipdate AS loaded_at,
         l_partkey AS part, l_suppkey AS supplier, l_extendedprice AS price,
         l_quantity AS quantity, l_discount AS discount, l_tax AS tax
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
"""
LOG_ORDER_SQL = ", ".join(
    f"{c} DESC"
    for c in ("loaded_at", "part", "supplier", "price", "quantity", "discount", "tax", "page",
              "user_agent")
)


def user_log(spark: SparkSession, sf: str) -> DataFrame:
    """Event log with the user columns of a play log; the level can change over time."""
    return table(spark, sf, "events").select(
        F.col("user_id").alias("userId"),
        F.concat(F.lit("User"), F.col("user_id").cast("string")).alias("firstName"),
        F.concat(F.lit("No"), (F.col("user_id") % 10).cast("string")).alias("lastName"),
        F.when(F.col("user_id") % 2 == 0, "F").otherwise("M").alias("gender"),
        F.when(F.col("event_type") == "purchase", "paid").otherwise("free").alias("level"),
        F.col("event_type").alias("page"),
        timestamp_to_epoch_millis("ts").alias("ts"),
        "event_id",
    )


USER_LOG_SQL = """
  SELECT user_id, 'User' || CAST(user_id AS VARCHAR) AS first_name,
         'No' || CAST(user_id % 10 AS VARCHAR) AS last_name,
         CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         CASE WHEN event_type = 'purchase' THEN 'paid' ELSE 'free' END AS level,
         event_type AS page, ts, event_id
  FROM events
"""


def artist_staging(spark: SparkSession, sf: str) -> DataFrame:
    """Artist columns of song metadata: one row per supplier."""
    supplier = table(spark, sf, "supplier")
    nation = table(spark, sf, "nation")
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("song_id"),
        F.col("s_name").alias("artist_id"),
        F.concat(F.lit("Band of "), "s_name").alias("artist_name"),
        F.col("n_name").alias("artist_location"),
        F.col("s_acctbal").alias("artist_latitude"),
        (-F.col("s_acctbal")).alias("artist_longitude"),
    )


def initcap_sql(column: str) -> str:
    """Every word after a blank starts with a capital."""
    words = f"string_split({column}, ' ')"
    word = "upper(left(w, 1)) || lower(substr(w, 2))"
    return f"array_to_string(list_transform({words}, lambda w: {word}), ' ')"


# --- inputs of the layered job ------------------------------------------------------
def mappings(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Code mappings from nations and regions; mode and visa are short fixed lists."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    key = F.col("n_nationkey").cast("string")

    # A code that is no number must not stop the join with numeric codes.
    countries = nation.select(key.alias("code"), F.col("n_name").alias("label"))
    return {
        "country": countries.union(
            region.select(F.concat(F.lit("XX"), "r_name"), F.lit("no country"))
        ),
        "port": nation.select(
            F.concat(F.lit("P"), key).alias("code"),
            F.concat("n_name", F.lit(", R"), F.col("n_regionkey").cast("string")).alias("label"),
        ),
        "state": region.select(
            F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("code"),
            F.col("r_name").alias("label"),
        ),
        "mode": inline_mapping(spark, {"1": "Air", "2": "Sea", "9": "Not reported"}),
        "visa": inline_mapping(
            spark, {"1": "Business", "2": "Pleasure", "3": "Student"}
        ),
    }


def raw_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    """One arrival per order; codes and day numbers are doubles, some are unusable."""
    orders = table(spark, sf, "orders")
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1960-01-01").cast("date"))
    pending = F.col("o_orderstatus") == "P"
    mode = F.when(pending, 3).when(F.col("o_orderstatus") == "F", 1).otherwise(2)
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").cast("double").alias("cicid"),
            F.year("o_orderdate").cast("double").alias("i94yr"),
            F.month("o_orderdate").cast("double").alias("i94mon"),
            F.concat(F.lit("P"), F.col("c_nationkey").cast("string")).alias("i94port"),
            F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("i94addr"),
            mode.cast("double").alias("i94mode"),
            F.substring("o_orderpriority", 1, 1).cast("double").alias("i94visa"),
            F.col("c_nationkey").cast("double").alias("i94res"),
            (F.col("o_custkey") % 30).cast("double").alias("i94cit"),
            (F.col("o_custkey") % 60 + 20).cast("double").alias("i94bir"),
            (F.lit(1996) - F.col("o_custkey") % 60).cast("double").alias("biryear"),
            F.concat(F.lit("FL"), F.col("o_orderstatus")).alias("fltno"),
            (F.col("o_orderkey") * 10).cast("double").alias("admnum"),
            F.concat(F.lit("AL"), F.substring("o_orderpriority", 1, 1)).alias("airline"),
            F.when(F.col("o_custkey") % 2 == 0, "F").otherwise("M").alias("gender"),
            days.cast("double").alias("arrdate"),
            F.when(~pending, days + F.col("o_orderkey") % 20).cast("double").alias("depdate"),
            F.when(pending, "D/S")
            .otherwise(F.date_format(F.date_add("o_orderdate", 180), "MMddyyyy"))
            .alias("dtaddto"),
        )
    )


# What the cleaned arrivals must be, straight from the tables.
ARRIVALS_SQL = """
  SELECT CAST(o_orderkey AS DOUBLE) AS cic_id, CAST(year(o_orderdate) AS DOUBLE) AS year,
         CAST(month(o_orderdate) AS DOUBLE) AS month,
         'P' || CAST(c_nationkey AS VARCHAR) AS city_code,
         'R' || CAST(n.n_regionkey AS VARCHAR) AS state_code,
         CAST(c_nationkey AS DOUBLE) AS residence_country_code,
         CAST(o_custkey % 30 AS DOUBLE) AS citizen_country_code,
         CAST(o_custkey % 60 + 20 AS DOUBLE) AS age,
         CAST(1996 - o_custkey % 60 AS DOUBLE) AS birth_year,
         'FL' || o_orderstatus AS flight_number, CAST(o_orderkey * 10 AS DOUBLE) AS admin_num,
         'AL' || left(o_orderpriority, 1) AS airline,
         CASE WHEN o_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         CAST(o_orderdate AS DATE) AS arrival_date,
         CASE WHEN o_orderstatus <> 'P'
              THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 20 AS INTEGER) END
           AS departure_date,
         CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) + 180 END
           AS last_departure,
         CASE o_orderstatus WHEN 'F' THEN 'Air' WHEN 'O' THEN 'Sea' END AS transport,
         r.r_name AS state, cit.n_name AS citizen_country,
         CASE left(o_orderpriority, 1) WHEN '1' THEN 'Business' WHEN '2' THEN 'Pleasure'
              WHEN '3' THEN 'Student' END AS visa,
         n.n_name AS residence_country, n.n_name AS city
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation n ON c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN nation cit ON o_custkey % 30 = cit.n_nationkey
"""


def raw_readings(spark: SparkSession, sf: str) -> DataFrame:
    """One temperature reading per customer, all text; positions scatter around the city."""
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    key = F.col("c_custkey")
    month = F.lpad((key % 12 + 1).cast("string"), 2, "0")
    latitude = F.col("c_nationkey") + 20 + key % 13 - 6
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.concat_ws("-", (key % 14 + 2000).cast("string"), month, F.lit("01")).alias("dt"),
        F.col("c_acctbal").cast("string").alias("AverageTemperature"),
        (key % 5).cast("string").alias("AverageTemperatureUncertainty"),
        F.initcap("n_name").alias("City"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", "Canada")
        .otherwise("United States").alias("Country"),
        F.concat(latitude.cast("string"), F.lit(".25N")).alias("Latitude"),
        F.concat((F.col("c_nationkey") + 70).cast("string"), F.lit(".25W")).alias("Longitude"),
    )


READINGS_SQL = """
  SELECT CAST(c_custkey % 14 + 2000 AS VARCHAR) || '-' ||
           lpad(CAST(c_custkey % 12 + 1 AS VARCHAR), 2, '0') || '-01' AS dt,
         CAST(c_acctbal AS VARCHAR) AS AverageTemperature,
         CAST(c_custkey % 5 AS VARCHAR) AS AverageTemperatureUncertainty,
         'Nation_' || CAST(c_nationkey AS VARCHAR) AS City,
         CAST(c_nationkey + 20 + c_custkey % 13 - 6 AS DOUBLE) + 0.25 AS Latitude,
         CAST(c_nationkey + 70 AS DOUBLE) + 0.25 AS Longitude
  FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'
"""


def raw_demographics(spark: SparkSession, sf: str) -> DataFrame:
    """City statistics with one row per category: customers by nation and segment."""
    customer = table(spark, sf, "customer")
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    counts = customer.groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(F.col("c_nationkey").alias("city_key")).agg(F.sum("n").alias("total"))
    total = F.col("total")
    return (
        counts.join(totals, F.col("c_nationkey") == F.col("city_key"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.initcap("n_name").alias("City"),
            F.initcap("r_name").alias("State"),
            F.concat((F.col("c_nationkey") + 20).cast("string"), F.lit(".5")).alias("Median Age"),
            F.floor(total / 2).cast("string").alias("Male Population"),
            (total - F.floor(total / 2)).cast("string").alias("Female Population"),
            total.cast("string").alias("Total Population"),
            F.floor(total / 10).cast("string").alias("Number of Veterans"),
            F.floor(total / 5).cast("string").alias("Foreign-born"),
            F.lit("2.5").alias("Average Household Size"),
            F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("State Code"),
            F.col("c_mktsegment").alias("Race"),
            F.col("n").cast("string").alias("Count"),
        )
    )


DEMOGRAPHICS_SQL = f"""
  SELECT 'Nation_' || CAST(c_nationkey AS VARCHAR) AS City,
         {initcap_sql("r_name")} AS State,
         CAST(count(*) // 2 AS VARCHAR) AS male_population,
         CAST(count(*) - count(*) // 2 AS VARCHAR) AS female_population,
         CAST(c_nationkey + 20 AS DOUBLE) + 0.5 AS median_age,
         CAST(count(*) AS VARCHAR) AS total_population,
         CAST(count(*) // 10 AS VARCHAR) AS num_of_veterans,
         CAST(count(*) // 5 AS VARCHAR) AS foreign_born, '2.5' AS avg_household_size,
         'R' || CAST(n_regionkey AS VARCHAR) AS state_code,
         nullif(count(*) FILTER (c_mktsegment = 'AUTOMOBILE'), 0) AS automobile,
         nullif(count(*) FILTER (c_mktsegment = 'BUILDING'), 0) AS building,
         nullif(count(*) FILTER (c_mktsegment = 'FURNITURE'), 0) AS furniture,
         nullif(count(*) FILTER (c_mktsegment = 'HOUSEHOLD'), 0) AS household,
         nullif(count(*) FILTER (c_mktsegment = 'MACHINERY'), 0) AS machinery
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY c_nationkey, n_regionkey, r_name
"""


def raw_sites(spark: SparkSession, sf: str) -> DataFrame:
    """One site per supplier; every eleventh lies in a place without city statistics."""
    supplier, nation = table(spark, sf, "supplier"), table(spark, sf, "nation")
    key = F.col("s_suppkey")
    place = F.when(key % 11 == 0, F.concat(F.lit("Outpost of "), "s_name"))
    minute = F.lpad((key % 100).cast("string"), 2, "0")
    longitude = F.concat(F.lit("-"), (F.col("s_nationkey") + 70).cast("string"), F.lit("."), minute)
    latitude = F.concat((F.col("s_nationkey") + 20).cast("string"), F.lit("."), minute)
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_name").alias("ident"),
        F.when(key % 3 == 0, "small_airport").otherwise("heliport").alias("type"),
        F.concat("s_name", F.lit(" field")).alias("name"),
        (key % 500).cast("string").alias("elevation_ft"),
        F.lit("NA").alias("continent"),
        F.when(F.col("s_acctbal") >= 0, "US").otherwise("CA").alias("iso_country"),
        F.concat(F.lit("US-R"), F.col("n_regionkey").cast("string")).alias("iso_region"),
        F.coalesce(place, F.initcap("n_name")).alias("municipality"),
        F.concat(F.lit("G"), key.cast("string")).alias("gps_code"),
        F.concat(F.lit("I"), key.cast("string")).alias("iata_code"),
        F.concat(F.lit("L"), key.cast("string")).alias("local_code"),
        F.concat_ws(", ", longitude, latitude).alias("coordinates"),
    )


SITES_SQL = """
  SELECT s_name AS id_local_code,
         CASE WHEN s_suppkey % 3 = 0 THEN 'small_airport' ELSE 'heliport' END AS type,
         s_name || ' field' AS name, CAST(s_suppkey % 500 AS VARCHAR) AS elevation_ft,
         'US-R' || CAST(n_regionkey AS VARCHAR) AS iso_region,
         CASE WHEN s_suppkey % 11 = 0 THEN 'Outpost of ' || s_name
              ELSE 'Nation_' || CAST(s_nationkey AS VARCHAR) END AS municipality,
         'I' || CAST(s_suppkey AS VARCHAR) AS iata_code,
         CAST(CAST(s_nationkey + 20 AS VARCHAR) || '.' ||
              lpad(CAST(s_suppkey % 100 AS VARCHAR), 2, '0') AS DOUBLE) AS latitude,
         CAST('-' || CAST(s_nationkey + 70 AS VARCHAR) || '.' ||
              lpad(CAST(s_suppkey % 100 AS VARCHAR), 2, '0') AS DOUBLE) AS longitude,
         'R' || CAST(n_regionkey AS VARCHAR) AS state_code
  FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal >= 0
"""
