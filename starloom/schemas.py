"""Declared schemas of every table, and the width each text column is allowed.

Names and types are fixed values: loads and checks rely on them.
"""

from __future__ import annotations

from pyspark.sql import types as T

STRING, INT, LONG, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
TIMESTAMP, WHOLE_18, WHOLE_38 = T.TimestampNTZType(), T.DecimalType(18, 0), T.DecimalType(38, 0)


def struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# --- raw inputs -------------------------------------------------------------
EVENT_LOG = struct(
    artist=STRING, auth=STRING, firstName=STRING, gender=STRING, itemInSession=INT,
    lastName=STRING, length=DOUBLE, level=STRING, location=STRING, method=STRING,
    page=STRING, registration=WHOLE_38, sessionId=INT, song=STRING, status=INT,
    ts=LONG, userAgent=STRING, userId=INT,
)

# The CSV export of the same log: no user agent, numbers in scientific notation.
EVENT_LOG_CSV = struct(
    artist=STRING, auth=STRING, firstName=STRING, gender=STRING, itemInSession=INT,
    lastName=STRING, length=DOUBLE, level=STRING, location=STRING, method=STRING,
    page=STRING, registration=DOUBLE, sessionId=INT, song=STRING, status=INT,
    ts=DOUBLE, userId=INT,
)

SONG_METADATA = struct(
    num_songs=STRING, artist_id=STRING, artist_latitude=DOUBLE, artist_longitude=DOUBLE,
    artist_location=STRING, artist_name=STRING, song_id=STRING, title=STRING,
    duration=DOUBLE, year=INT,
)

# Scale-0 staging: fractions of lengths and coordinates are rounded on load.
EVENT_LOG_WHOLE = struct(
    artist=STRING, auth=STRING, firstName=STRING, gender=STRING, itemInSession=INT,
    lastName=STRING, length=WHOLE_18, level=STRING, location=STRING, method=STRING,
    page=STRING, registration=WHOLE_18, sessionId=INT, song=STRING, status=INT,
    ts=LONG, userAgent=STRING, userId=INT,
)
SONG_METADATA_WHOLE = struct(
    num_songs=INT, artist_id=STRING, artist_name=STRING, artist_latitude=WHOLE_18,
    artist_longitude=WHOLE_18, artist_location=STRING, song_id=STRING, title=STRING,
    duration=WHOLE_18, year=INT,
)

TEMPERATURES_CSV = struct(
    dt=STRING, AverageTemperature=STRING, AverageTemperatureUncertainty=STRING,
    City=STRING, Country=STRING, Latitude=STRING, Longitude=STRING,
)

DEMOGRAPHICS_CSV = T.StructType([
    T.StructField(name, STRING)
    for name in (
        "City", "State", "Median Age", "Male Population", "Female Population",
        "Total Population", "Number of Veterans", "Foreign-born",
        "Average Household Size", "State Code", "Race", "Count",
    )
])

AIRPORTS_CSV = struct(
    ident=STRING, type=STRING, name=STRING, elevation_ft=STRING, continent=STRING,
    iso_country=STRING, iso_region=STRING, municipality=STRING, gps_code=STRING,
    iata_code=STRING, local_code=STRING, coordinates=STRING,
)

# --- star schema ------------------------------------------------------------
USERS = struct(user_id=INT, first_name=STRING, last_name=STRING, gender=STRING, level=STRING)
SONGS = struct(song_id=STRING, title=STRING, artist_id=STRING, year=INT, duration=DOUBLE)
ARTISTS = struct(
    artist_id=STRING, name=STRING, location=STRING, latitude=DOUBLE, longitude=DOUBLE
)
TIME = struct(
    start_time=TIMESTAMP, hour=INT, day=INT, week=INT, month=INT, year=INT, weekday=INT
)
SONGPLAYS = struct(
    songplay_id=STRING, start_time=TIMESTAMP, user_id=INT, level=STRING, song_id=STRING,
    artist_id=STRING, session_id=INT, location=STRING, user_agent=STRING,
)

# --- one table per question -------------------------------------------------
SONGS_BY_SESSION = struct(
    sessionId=INT, itemInSession=INT, artist=STRING, song_title=STRING,
    song_length=T.FloatType(),
)
ARTIST_SONG_BY_USER = struct(
    userId=INT, sessionId=INT, itemInSession=INT, artist=STRING, song_title=STRING, user=STRING
)
USERS_BY_SONG = struct(song_title=STRING, user=STRING)

# Dimensions first, then the fact, so that every reference has its target.
STAR_TABLES = {
    "staging_events": EVENT_LOG,
    "staging_songs": SONG_METADATA,
    "users": USERS,
    "artists": ARTISTS,
    "songs": SONGS,
    "time": TIME,
    "songplays": SONGPLAYS,
}
QUESTION_TABLES = {
    "songs_by_session": SONGS_BY_SESSION,
    "artist_song_by_user": ARTIST_SONG_BY_USER,
    "users_by_song": USERS_BY_SONG,
}

# --- declared keys and widths ------------------------------------------------
PRIMARY_KEYS = {
    "users": ["user_id"],
    "songs": ["song_id"],
    "artists": ["artist_id"],
    "songplays": ["songplay_id"],
    "songs_by_session": ["sessionId", "itemInSession"],
    "artist_song_by_user": ["userId", "sessionId", "itemInSession"],
    "users_by_song": ["song_title", "user"],
}
FOREIGN_KEYS = [
    ("songplays", "artist_id", "artists", "artist_id"),
    ("songplays", "song_id", "songs", "song_id"),
    ("songplays", "user_id", "users", "user_id"),
    ("songs", "artist_id", "artists", "artist_id"),
]
EVENT_WIDTHS = {
    "artist": 255, "auth": 100, "firstName": 100, "gender": 10, "lastName": 100,
    "level": 100, "location": 255, "method": 100, "page": 100, "song": 255, "userAgent": 255,
}
SONG_WIDTHS = {
    "artist_id": 30, "artist_location": 100, "artist_name": 100, "song_id": 30, "title": 100,
}
