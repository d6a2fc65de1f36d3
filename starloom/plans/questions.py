"""One table per question, keyed by what the question asks for.

A keyed insert overwrites silently, so each table holds the last row loaded per key.
``order`` names the load order and must be total within a key. A log from ``mark_last`` carries
flags of these rows, so that its tables need no shuffle to find them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from starloom.functions import full_name
from starloom.operators import dedupe, drop_blank, mark_kept, point_lookup

# Fixed positions of the fields that the flat event file keeps, and their names.
KEPT_POSITIONS = (0, 2, 3, 4, 5, 6, 7, 8, 12, 13, 16)
KEPT_NAMES = (
    "artist", "firstName", "gender", "itemInSession", "lastName", "length", "level",
    "location", "sessionId", "song", "userId",
)


SESSION_ITEM = ["sessionId", "itemInSession"]
USER_ITEM = ["userId", *SESSION_ITEM]
# Flags of the last row per key, in the order that lets one shuffle serve both.
MARKS = {"_last_of_session": SESSION_ITEM, "_last_of_user": USER_ITEM}


def mark_last(log: DataFrame, order: Sequence[str]) -> DataFrame:
    """The log with the flags in ``MARKS``: what a keyed insert by these keys would leave."""
    return mark_kept(drop_blank(log, "artist"), MARKS, "last", order)


def _last(log: DataFrame, flag: str, order: Sequence[str]) -> DataFrame:
    if flag in log.columns:
        return log.filter(flag)
    return dedupe(drop_blank(log, "artist"), MARKS[flag], "last", order)


def songs_by_session(log: DataFrame, order: Sequence[str]) -> DataFrame:
    """What was heard at an item of a session."""
    rows = _last(log, "_last_of_session", order)
    return rows.select(
        *SESSION_ITEM,
        "artist",
        F.col("song").alias("song_title"),
        F.col("length").cast("float").alias("song_length"),
    )


def artist_song_by_user(log: DataFrame, order: Sequence[str]) -> DataFrame:
    """What a user heard in a session, by item."""
    rows = _last(log, "_last_of_user", order)
    return rows.select(
        *USER_ITEM,
        "artist",
        F.col("song").alias("song_title"),
        full_name("firstName", "lastName").alias("user"),
    )


def users_by_song(log: DataFrame, repeated: bool = False) -> DataFrame:
    """Who heard a song; the whole row is the key. ``repeated`` leaves the repeats to the caller."""
    rows = drop_blank(log, "artist").select(
        F.col("song").alias("song_title"), full_name("firstName", "lastName").alias("user")
    )
    return rows if repeated else rows.distinct()


def item_of_session(table: DataFrame, session: int, item: int) -> DataFrame:
    found = point_lookup(table, sessionId=session, itemInSession=item)
    return found.select("artist", "song_title", "song_length")


def items_of_user_session(table: DataFrame, user: int, session: int) -> DataFrame:
    """In item order; the item stays in the result so that the order can be seen."""
    found = point_lookup(table, userId=user, sessionId=session)
    return found.orderBy("itemInSession").select("itemInSession", "artist", "song_title", "user")


def users_of_song(table: DataFrame, title: str) -> DataFrame:
    return point_lookup(table, song_title=title).select("user")
