"""The whole star run on a few hand-written log and song files."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from starloom import schemas
from starloom.operators import CheckFailed, declared_violations
from starloom.plans import runs, star
from starloom.schemas import EVENT_LOG, SONG_METADATA
from starloom.session import scratch_path
from starloom.sources import stage_json

SONGS = [
    dict(num_songs=1, artist_id="A1", artist_latitude=35.1, artist_longitude=-90.0,
         artist_location="Memphis, TN", artist_name="Elena", song_id="S1", title="Setanta", duration=269.58322, year=0),
    dict(num_songs=1, artist_id="A1", artist_latitude=None, artist_longitude=None,
         artist_location="", artist_name="Elena", song_id="S2", title="Other", duration=100.5, year=1999),
    dict(num_songs=1, artist_id="A2", artist_latitude=None, artist_longitude=None,
         artist_location=None, artist_name="Twin", song_id="S4", title="Same", duration=50.0, year=2001),
    dict(num_songs=1, artist_id="A2", artist_latitude=None, artist_longitude=None,
         artist_location=None, artist_name="Twin", song_id="S3", title="Same", duration=50.0, year=2001),
]


def event(ts, user, page="NextSong", level="free", song=None, artist=None, length=None, session=1):
    return dict(
        artist=artist, auth="Logged In", firstName=f"F{user}", gender="F", itemInSession=0,
        lastName=f"L{user}", length=length, level=level, location="Here, US", method="PUT",
        page=page, registration=1540919166796, sessionId=session, song=song, status=200, ts=ts,
        userAgent="agent", userId=user,
    )


EVENTS = [
    event(1541106106796, 8, song="Setanta", artist="Elena", length=269.58322, session=5),
    event(1541106132796, 8, song="Setanta", artist="Elena", length=269.5),
    event(1541106496796, 8, song="Same", artist="Twin", length=50.0, level="paid"),
    event(1541107496796, 9, song="Unknown", artist="Nobody", length=1.0),
    event(1541108496796, 10, page="Home"),
    event(1541108496999, None, page="Login"),
]


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("star")
    (folder / "events.json").write_text("\n".join(map(json.dumps, EVENTS)))
    (folder / "songs.json").write_text("\n".join(map(json.dumps, SONGS)))
    paths = [f"$['{name}']" for name in EVENT_LOG.names]
    events = stage_json(spark, str(folder / "events.json"), EVENT_LOG, paths)
    songs = stage_json(spark, str(folder / "songs.json"), SONG_METADATA, widths=schemas.SONG_WIDTHS)
    return events, songs


def test_fact_policies(staged, rows):
    events, songs = staged
    left = star.build_fact(events, songs)
    assert rows(left, "user_id", "song_id") == [
        (8, "S1"), (8, "S3"), (8, "S4"), (8, None), (9, None)
    ]
    assert rows(star.build_fact(events, songs, "inner"), "song_id") == [("S1",), ("S3",), ("S4",)]
    first = star.build_fact_first_match(
        events, star.build_songs(songs), star.build_artists(songs, "first")
    )
    assert rows(first, "user_id", "song_id") == [(8, "S1"), (8, "S3"), (8, None), (9, None)]
    assert left.columns == schemas.SONGPLAYS.names


def test_fact_times_and_keys(staged):
    events, songs = staged
    second = star.build_fact(events, songs, "inner").filter("song_id = 'S1'").first()
    assert second["start_time"] == dt.datetime(2018, 11, 1, 21, 1, 46)
    assert len(second["songplay_id"]) == 32
    milli = star.build_fact(events, songs, "inner", key="row", precision="millisecond")
    assert milli.filter("song_id = 'S1'").first()["start_time"].microsecond == 796000
    assert milli.select("songplay_id").distinct().count() == 3
    with pytest.raises(ValueError):
        star.build_fact(events, songs, key="uuid")
    with pytest.raises(ValueError):
        star.build_fact(events, songs, precision="day")


def test_users(staged, rows):
    events, _ = staged
    assert rows(star.build_users(events, "distinct"), "user_id", "level") == [
        (8, "free"), (8, "paid"), (9, "free")
    ]
    assert rows(star.build_users(events, "last"), "user_id", "level") == [(8, "paid"), (9, "free")]
    assert rows(star.build_users(events, "first"), "user_id", "level") == [(8, "free"), (9, "free")]
    assert rows(star.build_users(events, "last", page=None), "user_id") == [(10,), (8,), (9,), (None,)]


def test_whole_number_lengths_match_more(staged):
    """Staged without fractions, 269.5 and 269.58322 are the same length."""
    events, songs = staged
    whole = F.col("length").cast("decimal(18,0)")
    rounded = star.build_fact(
        events.withColumn("length", whole),
        songs.withColumn("duration", F.col("duration").cast("decimal(18,0)")),
    )
    assert rounded.filter("song_id = 'S1'").count() == 2


def test_run(spark, staged, rows):
    events, songs = staged
    root = scratch_path(spark, "run-star")
    for _ in range(2):  # The reset makes a second run start from nothing.
        report = runs.run_star(spark, events, songs, "test_star", root)
        assert {r["table_name"]: (r["row_count"], r["passed"]) for r in report.collect()} == {
            "staging_events": (6, True), "staging_songs": (4, True), "users": (2, True),
            "artists": (3, True), "songs": (4, True), "songplays": (5, True), "time": (4, True),
        }
    tables = {name: spark.table(f"test_star.{name}") for name in schemas.STAR_TABLES}
    broken = declared_violations(tables, schemas.PRIMARY_KEYS, schemas.FOREIGN_KEYS)
    assert rows(broken.filter("violations > 0")) == [
        # Two different rows of one artist are both kept by DISTINCT, and two songs with one
        # natural key make one play two rows of the left join.
        ("artists", "unique artist_id", 1), ("songplays", "unique songplay_id", 1),
    ]


def test_first_match_run(spark, staged):
    events, songs = staged
    report = runs.run_star(
        spark, events, songs, "test_first", scratch_path(spark, "first"), how="first"
    )
    counts = {r["table_name"]: r["row_count"] for r in report.collect()}
    assert (counts["artists"], counts["songs"], counts["songplays"]) == (2, 4, 4)


def test_lake(spark, staged, rows):
    events, songs = staged
    root = scratch_path(spark, "lake")
    report = runs.run_lake(spark, events, songs, root)
    assert {r["table_name"]: r["row_count"] for r in report.collect()} == {
        "songs": 4, "artists": 2, "users": 2, "time": 4, "songplays": 3
    }
    stored = spark.read.parquet(f"{root}/songplays")
    assert rows(stored, "year", "month", "song_id") == [
        (2018, 11, "S1"), (2018, 11, "S3"), (2018, 11, "S4")
    ]


def test_run_raises_on_keyless_users(spark, staged):
    events, songs = staged
    with pytest.raises(CheckFailed):
        runs.run_star(spark, events, songs, "test_keyless", scratch_path(spark, "keyless"), page="Login")
