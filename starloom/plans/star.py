"""Star schema of a music-play log: four dimensions and the plays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from starloom.functions import (
    calendar_parts,
    epoch_millis_to_second,
    epoch_millis_to_timestamp,
    fact_key,
)
from starloom.operators import dedupe, first_match_lookup, natural_key_join, row_id

# The page that marks a play, and the natural key of a song.
PLAY_PAGE = "NextSong"
SONG_KEY = {"song": "title", "artist": "artist_name", "length": "duration"}


def plays(events: DataFrame, page: str = PLAY_PAGE) -> DataFrame:
    return events.filter(F.col("page") == page)


def start_time(precision: str = "second"):
    """Start of an event from its epoch milliseconds, cut to seconds or not."""
    if precision == "second":
        return epoch_millis_to_second("ts")
    if precision == "millisecond":
        return epoch_millis_to_timestamp("ts")
    raise ValueError(f"precision {precision!r} is neither second nor millisecond")


def build_songs(
    songs: DataFrame, keep: str = "distinct", order: Sequence[str] = ("song_id",)
) -> DataFrame:
    """Songs; ``keep`` first or last leaves one row per song by ``order``."""
    rows = songs if keep == "distinct" else dedupe(songs, ["song_id"], keep, order)
    picked = rows.select("song_id", "title", "artist_id", "year", "duration")
    return picked.distinct() if keep == "distinct" else picked


def build_artists(
    songs: DataFrame, keep: str = "distinct", order: Sequence[str] = ("song_id",)
) -> DataFrame:
    rows = songs if keep == "distinct" else dedupe(songs, ["artist_id"], keep, order)
    picked = rows.select(
        "artist_id",
        F.col("artist_name").alias("name"),
        F.col("artist_location").alias("location"),
        F.col("artist_latitude").alias("latitude"),
        F.col("artist_longitude").alias("longitude"),
    )
    return picked.distinct() if keep == "distinct" else picked


def build_users(
    events: DataFrame,
    keep: str = "last",
    order: Sequence[str] = ("ts",),
    page: str | None = PLAY_PAGE,
) -> DataFrame:
    """Users by policy: every different row, or the first or last row of each user.

    ``page=None`` takes users from all events, not from plays only.
    """
    rows = events if page is None else plays(events, page)
    if keep != "distinct":
        rows = dedupe(rows, ["userId"], keep, order)
    picked = rows.select(
        F.col("userId").alias("user_id"),
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
        "gender",
        "level",
    )
    return picked.distinct() if keep == "distinct" else picked


def build_time(
    starts: DataFrame, column: str = "start_time", weekday_style: str = "monday0", unique: bool = True
) -> DataFrame:
    """Calendar parts of each start time; ``unique=False`` keeps repeated times."""
    times = starts.select(F.col(column).alias("start_time"))
    if unique:
        times = times.distinct()
    return times.withColumns(calendar_parts("start_time", weekday_style))


def build_fact(
    events: DataFrame,
    songs: DataFrame,
    how: str = "left",
    page: str = PLAY_PAGE,
    key: str = "md5",
    precision: str = "second",
) -> DataFrame:
    """Plays with the song and artist they match by title, artist name and length.

    ``how="left"`` keeps plays without a match, ``"inner"`` drops them. ``key`` is
    ``md5`` (from session and second) or ``row`` (unique within one run).
    """
    matched = natural_key_join(plays(events, page), songs, SONG_KEY, ["song_id", "artist_id"], how)
    return _fact_columns(matched, key, precision)


def build_fact_first_match(
    events: DataFrame,
    songs: DataFrame,
    artists: DataFrame,
    page: str = PLAY_PAGE,
    key: str = "md5",
    precision: str = "second",
) -> DataFrame:
    """Plays looked up in the finished dimensions; a play never comes out twice.

    Where several songs match, the lowest song id is taken.
    """
    known = songs.select("song_id", "title", "artist_id", "duration").join(
        artists.select("artist_id", F.col("name").alias("artist_name")), "artist_id"
    )
    matched = first_match_lookup(
        plays(events, page), known, SONG_KEY, ["song_id", "artist_id"], ["song_id", "artist_id"]
    )
    return _fact_columns(matched, key, precision)


def _fact_columns(matched: DataFrame, key: str, precision: str) -> DataFrame:
    timed = matched.withColumn("start_time", start_time(precision))
    if key == "md5":
        keyed = timed.withColumn("songplay_id", fact_key("sessionId", "start_time"))
    elif key == "row":
        keyed = row_id(timed, "songplay_id")
    else:
        raise ValueError(f"key {key!r} is neither md5 nor row")
    return keyed.select(
        "songplay_id",
        "start_time",
        F.col("userId").alias("user_id"),
        "level",
        "song_id",
        "artist_id",
        F.col("sessionId").alias("session_id"),
        "location",
        F.col("userAgent").alias("user_agent"),
    )


def with_month(df: DataFrame, column: str = "start_time") -> DataFrame:
    """Partition columns of the stored time and play tables."""
    return df.withColumns({"year": F.year(column), "month": F.month(column)})
