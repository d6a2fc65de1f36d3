"""Star schema and question tables over the derived play log."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.catalog import views
from starloom.catalog.registry import query
from starloom.functions import timestamp_to_epoch_millis
from starloom.plans import questions, runs, star
from starloom.schemas import EVENT_LOG, LONG, SONG_METADATA, STAR_TABLES
from starloom.session import drop_later, scratch_path
from starloom.sources import table

FACT_SQL = f"""
SELECT md5(CAST(session_id AS VARCHAR) || strftime(start_time, '%Y-%m-%d %H:%M:%S'))
         AS songplay_id,
       start_time, user_id, level, song_id, c.artist_id, session_id, location, user_agent
FROM ({views.PLAY_LOG_SQL}) p {{how}} JOIN ({{songs}}) c
  ON p.song = c.title AND p.artist = c.artist_name AND p.length = c.duration
WHERE p.page = 'N'
"""
CALENDAR_SQL = """
CAST(hour(start_time) AS INTEGER) AS hour, CAST(day(start_time) AS INTEGER) AS day,
CAST(weekofyear(start_time) AS INTEGER) AS week, CAST(month(start_time) AS INTEGER) AS month,
CAST(year(start_time) AS INTEGER) AS year
"""


@query("fact_left_lookup", FACT_SQL.format(how="LEFT", songs=views.CATALOGUE_SQL))
def fact_left_lookup(spark, sf):
    return star.build_fact(
        views.play_log(spark, sf), views.catalogue(spark, sf), "left", views.PLAY
    )


@query("fact_inner", FACT_SQL.format(how="INNER", songs=views.CATALOGUE_SQL))
def fact_inner(spark, sf):
    return star.build_fact(
        views.play_log(spark, sf), views.catalogue(spark, sf), "inner", views.PLAY
    )


@query("fact_first_match", FACT_SQL.format(how="LEFT", songs=f"""
  SELECT title, artist_name, duration, min(song_id) AS song_id, min(artist_id) AS artist_id
  FROM ({views.CATALOGUE_SQL}) GROUP BY title, artist_name, duration"""))
def fact_first_match(spark, sf):
    """Looked up in the finished dimensions, one song at most per play."""
    metadata = views.catalogue(spark, sf)
    return star.build_fact_first_match(
        views.play_log(spark, sf), star.build_songs(metadata), star.build_artists(metadata),
        views.PLAY,
    )


@query("dim_songs", f"""
SELECT DISTINCT song_id, title, artist_id, year, duration FROM ({views.WHOLE_CATALOGUE_SQL})
""")
def dim_songs(spark, sf):
    return star.build_songs(views.whole_catalogue(spark, sf))


@query("dim_songs_last", f"""
SELECT song_id, title, artist_id, year, duration FROM (
  SELECT song_id % 700 AS song_id, title, artist_id, year, duration, row_number() OVER (
    PARTITION BY song_id % 700 ORDER BY year DESC, artist_id DESC, title DESC, duration DESC) AS r
  FROM ({views.WHOLE_CATALOGUE_SQL})) WHERE r = 1
""")
def dim_songs_last(spark, sf):
    """Song ids that repeat: the last by year stays, ties by the other columns."""
    songs = views.whole_catalogue(spark, sf).withColumn("song_id", F.col("song_id") % 700)
    return star.build_songs(songs, "last", ["year"])


@query("dim_artists", """
SELECT DISTINCT s_name AS artist_id, 'Band of ' || s_name AS name, n_name AS location,
       s_acctbal AS latitude, -s_acctbal AS longitude
FROM supplier JOIN nation ON s_nationkey = n_nationkey
""")
def dim_artists(spark, sf):
    return star.build_artists(views.artist_staging(spark, sf))


@query("dim_artists_last", f"""
SELECT artist_id, artist_name AS name, CAST(NULL AS VARCHAR) AS location,
       CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude
FROM ({views.WHOLE_CATALOGUE_SQL}) GROUP BY artist_id, artist_name
""")
def dim_artists_last(spark, sf):
    """One row per artist out of many songs."""
    return star.build_artists(views.whole_catalogue(spark, sf), keep="last")


@query("dim_users_distinct", f"""
SELECT DISTINCT user_id, first_name, last_name, gender, level FROM ({views.USER_LOG_SQL})
""")
def dim_users_distinct(spark, sf):
    """Every different row: a user whose level changed is there more than once."""
    return star.build_users(views.user_log(spark, sf), "distinct", page=None)


def _one_user_sql(direction: str, where: str = "true") -> str:
    return f"""
SELECT user_id, first_name, last_name, gender, level FROM (
  SELECT *, row_number() OVER (
    PARTITION BY user_id ORDER BY epoch_us(ts) // 1000 {direction}, event_id {direction}) AS r
  FROM ({views.USER_LOG_SQL}) WHERE {where}) WHERE r = 1
"""


@query("dim_users_last", _one_user_sql("DESC"))
def dim_users_last(spark, sf):
    return star.build_users(views.user_log(spark, sf), "last", ["ts", "event_id"], page=None)


@query("dim_users_first", _one_user_sql("ASC", "page = 'click'"))
def dim_users_first(spark, sf):
    """One row per user, the earliest, from the events of one page."""
    return star.build_users(views.user_log(spark, sf), "first", ["ts", "event_id"], page="click")


@query("dim_time", f"""
SELECT start_time, {CALENDAR_SQL}, CAST(isodow(start_time) - 1 AS INTEGER) AS weekday
FROM (SELECT DISTINCT date_trunc('second', ts) AS start_time FROM events)
""")
def dim_time(spark, sf):
    events = table(spark, sf, "events").withColumn("ts", timestamp_to_epoch_millis("ts"))
    return star.build_time(events.select(star.start_time().alias("start_time")))


@query("dim_time_from_fact", f"""
SELECT start_time, {CALENDAR_SQL}, CAST(dayofweek(start_time) AS INTEGER) AS weekday
FROM ({FACT_SQL.format(how="LEFT", songs=views.CATALOGUE_SQL)})
""")
def dim_time_from_fact(spark, sf):
    """From the plays, repeated times kept, Sunday counted as 0."""
    return star.build_time(fact_left_lookup(spark, sf), weekday_style="sunday0", unique=False)


# --- one table per question ----------------------------------------------------------
def _last_item_sql(keys: str, source: str, columns: str) -> str:
    return f"""
SELECT {columns} FROM (
  SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {views.LOG_ORDER_SQL}) AS r
  FROM {source}) WHERE r = 1
"""


BY_SESSION_SQL = _last_item_sql(
    "session_id, item", f"({views.PLAY_LOG_SQL})",
    'session_id AS "sessionId", item AS "itemInSession", artist, song AS song_title, '
    "CAST(CAST(length AS FLOAT) AS DOUBLE) AS song_length",
)
NAMED_LOG_SQL = f"""
(SELECT p.*, c_mktsegment || ' ' || c_name AS who
 FROM ({views.PLAY_LOG_SQL}) p JOIN customer ON user_id = c_custkey)
"""
BY_USER_SQL = _last_item_sql(
    "user_id, session_id, item", NAMED_LOG_SQL,
    'user_id AS "userId", session_id AS "sessionId", item AS "itemInSession", artist, '
    'song AS song_title, who AS "user"',
)
BY_SONG_SQL = f'SELECT DISTINCT song AS song_title, who AS "user" FROM {NAMED_LOG_SQL}'


def _by_session(spark, sf):
    found = questions.songs_by_session(views.play_log(spark, sf), views.LOG_ORDER)
    # Stored in 32 bits; shown in 64 so that both sides print the same digits.
    return found.withColumn("song_length", F.col("song_length").cast("double"))


def _by_user(spark, sf):
    log = views.play_log(spark, sf, names=True)
    return questions.artist_song_by_user(log, views.LOG_ORDER)


def _by_song(spark, sf):
    return questions.users_by_song(views.play_log(spark, sf, names=True))


@query("qf_items_by_session", BY_SESSION_SQL)
def qf_items_by_session(spark, sf):
    return _by_session(spark, sf)


@query("qf_items_by_user_session", BY_USER_SQL)
def qf_items_by_user_session(spark, sf):
    return _by_user(spark, sf)


@query("qf_users_by_item", BY_SONG_SQL)
def qf_users_by_item(spark, sf):
    return _by_song(spark, sf)


@query("qf_ask_item_of_session", f"""
SELECT artist, song_title, song_length FROM ({BY_SESSION_SQL})
WHERE "sessionId" = 66 AND "itemInSession" = 4
""")
def qf_ask_item_of_session(spark, sf):
    """Question 1; the condition reaches the scans below the keyed insert."""
    return questions.item_of_session(_by_session(spark, sf), 66, 4)


@query("qf_ask_items_of_user_session", f"""
SELECT "itemInSession", artist, song_title, "user" FROM ({BY_USER_SQL})
WHERE "userId" = (SELECT o_custkey FROM orders WHERE o_orderkey = 78) AND "sessionId" = 78
""")
def qf_ask_items_of_user_session(spark, sf):
    """Question 2: all items of one session of its user."""
    user = table(spark, sf, "orders").filter("o_orderkey = 78").select(
        F.col("o_custkey").alias("asked")
    )
    rows = _by_user(spark, sf).filter(F.col("sessionId") == 78)
    found = rows.join(user, F.col("userId") == F.col("asked"), "left_semi")
    return found.orderBy("itemInSession").select("itemInSession", "artist", "song_title", "user")


@query("qf_ask_users_of_item", f"""
SELECT "user" FROM ({BY_SONG_SQL}) WHERE song_title = 'small ring vol. 0'
""")
def qf_ask_users_of_item(spark, sf):
    """Question 3: everyone who heard a song."""
    return questions.users_of_song(_by_song(spark, sf), "small ring vol. 0")


# --- the whole run -----------------------------------------------------------------------
def _staged(log, schema):
    """The view with every column of the staging schema, in its order."""
    have = set(log.columns)
    return log.select([
        (F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])


@query("run_star", f"""
WITH log AS ({views.PLAY_LOG_SQL}), songs AS ({views.CATALOGUE_SQL}),
     fact AS ({FACT_SQL.format(how="LEFT", songs=views.CATALOGUE_SQL)})
SELECT 'staging_events' AS table_name, count(*) AS row_count, true AS passed FROM log
UNION ALL SELECT 'staging_songs', count(*), true FROM songs
UNION ALL SELECT 'users', count(DISTINCT user_id), true FROM log WHERE page = 'N'
UNION ALL SELECT 'artists', count(DISTINCT artist_id), true FROM songs
UNION ALL SELECT 'songs', count(DISTINCT song_id), true FROM songs
UNION ALL SELECT 'songplays', count(*), true FROM fact
UNION ALL SELECT 'time', count(DISTINCT start_time), true FROM fact
""")
def run_star(spark, sf):
    """Reset, stage, load and check all tables; one row per table."""
    root = scratch_path(spark, "star")
    database = "starloom_" + root.rsplit("-", 1)[1]
    drop_later(spark, database, kind="DATABASE")
    ids = {"userId": LONG, "sessionId": LONG, "user_id": LONG, "session_id": LONG}
    return runs.run_star(
        spark,
        _staged(views.play_log(spark, sf), EVENT_LOG),
        _staged(views.catalogue(spark, sf), SONG_METADATA),
        database=database,
        location=root,
        page=views.PLAY,
        user_order=["ts", "sessionId", "itemInSession"],
        tables=runs.with_types(STAR_TABLES, **ids),
    )


@query("run_star_first_match", f"""
WITH log AS ({views.PLAY_LOG_SQL}), songs AS ({views.CATALOGUE_SQL})
SELECT 'staging_events' AS table_name, count(*) AS row_count, true AS passed FROM log
UNION ALL SELECT 'staging_songs', count(*), true FROM songs
UNION ALL SELECT 'users', count(DISTINCT user_id), true FROM log WHERE page = 'N'
UNION ALL SELECT 'artists', count(DISTINCT artist_id), true FROM songs
UNION ALL SELECT 'songs', count(DISTINCT song_id), true FROM songs
UNION ALL SELECT 'songplays', count(*), true FROM log WHERE page = 'N'
UNION ALL SELECT 'time', count(DISTINCT start_time), true FROM log WHERE page = 'N'
""")
def run_star_first_match(spark, sf):
    """The same with upserted dimensions: as many plays as the log has."""
    root = scratch_path(spark, "star-first")
    database = "starloom_" + root.rsplit("-", 1)[1]
    drop_later(spark, database, kind="DATABASE")
    ids = {"userId": LONG, "sessionId": LONG, "user_id": LONG, "session_id": LONG}
    return runs.run_star(
        spark,
        _staged(views.play_log(spark, sf), EVENT_LOG),
        _staged(views.catalogue(spark, sf), SONG_METADATA),
        database=database,
        location=root,
        page=views.PLAY,
        user_order=["ts", "sessionId", "itemInSession"],
        how="first",
        tables=runs.with_types(STAR_TABLES, **ids),
    )


@query("run_lake", f"""
WITH log AS ({views.PLAY_LOG_SQL}), songs AS ({views.CATALOGUE_SQL}),
     fact AS ({FACT_SQL.format(how="INNER", songs=views.CATALOGUE_SQL)})
SELECT 'users' AS table_name, count(DISTINCT user_id) AS row_count, true AS passed FROM log
  WHERE page = 'N'
UNION ALL SELECT 'artists', count(DISTINCT artist_id), true FROM songs
UNION ALL SELECT 'songs', count(DISTINCT song_id), true FROM songs
UNION ALL SELECT 'songplays', count(*), true FROM fact
UNION ALL SELECT 'time', count(*), true FROM log WHERE page = 'N'
""")
def run_lake(spark, sf):
    """The star schema as partitioned folders, songs by year only."""
    log = views.play_log(spark, sf, names=True).withColumn("gender", F.lit(None).cast("string"))
    return runs.run_lake(
        spark, log, views.catalogue(spark, sf), scratch_path(spark, "lake"), views.PLAY,
        ["ts", "sessionId", "itemInSession"], songs_by=["year"],
    )


@query("run_questions", f"""
SELECT 'songs_by_session' AS table_name, count(*) AS row_count, true AS passed
FROM ({BY_SESSION_SQL})
UNION ALL SELECT 'artist_song_by_user', count(*), true FROM ({BY_USER_SQL})
UNION ALL SELECT 'users_by_song', count(*), true FROM ({BY_SONG_SQL})
""")
def run_questions(spark, sf):
    """Flat file, then one stored table per question."""
    log = views.play_log(spark, sf, names=True).withColumn("gender", F.lit(None).cast("string"))
    return runs.run_questions(spark, log, scratch_path(spark, "questions"), views.LOG_ORDER)
