"""The three questions on a small invented log, with the answers its rows give."""

import pytest

from starloom import schemas
from starloom.plans import questions, runs
from starloom.session import SHUFFLE_CLEANUP, scratch_path
from starloom.sinks import cluster
from starloom.sources import read_csv, select_positions

# Fixed value: the header of the event files.
HEADER = ("artist,auth,firstName,gender,itemInSession,lastName,length,level,location,method,page,"
          "registration,sessionId,song,status,ts,userId")


def line(artist="", first="", item=0, last="", length="", place="", session=0, song="", ts=0, user="", page="NextSong"):
    """One line of an event file; ``place`` and ``song`` are quoted where the format asks for it."""
    quoted = lambda text: '"' + text.replace('"', '""') + '"' if set(text) & {",", '"'} else text
    auth = "Logged In" if user else "Logged Out"
    fields = [artist, auth, first, "F" if first else "", item, last, length, "free", quoted(place), "PUT", page,
              "1.5E+12" if user else "", session, quoted(song), 200, ts, user]
    return ",".join(map(str, fields))


MIRA = dict(first="Mira", last="Okafor", place="Little Rock, AR", session=801, user=61)
FILES = {
    "2021-03-02": [
        line("Copper Kites", item=2, length=201.5, song="Harbour Lights", ts=30, **MIRA),
        line("Ninth Street Trio", item=0, length=188.25, song="Paper Moons", ts=10, **MIRA),
        line(first="Jon", last="Lindqvist", session=17, user=62, page="Home", ts=11),
        line("The Salt Road", item=1, length=240.0, song="Don't Wait, Marie", ts=20, **MIRA),
    ],
    "2021-03-04": [
        line("Velvet Anchors", "Ines", 5, "Duarte", 312.125, "Porto, PT", 640, "Slow Tide", 40, 63),
        line(session=52, page="Login", ts=41),
    ],
    "2021-03-05": [
        line("Blue Cartography", "Teo", 8, "Marsh", 154.75, "Boise City, ID", 733, 'The Letter "Q"', 50, 64),
    ],
}


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("event_data")
    for name, lines in FILES.items():
        (folder / f"{name}-events.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    return read_csv(spark, str(folder), schemas.EVENT_LOG_CSV)


def test_flat_file(log, rows):
    flat = select_positions(log, questions.KEPT_POSITIONS)
    assert flat.columns == list(questions.KEPT_NAMES)
    assert log.count() == 7
    assert ('The Letter "Q"',) in rows(flat, "song")


def test_question_1(log):
    table = questions.songs_by_session(log, ["ts"])
    assert table.schema == schemas.SONGS_BY_SESSION
    answer = questions.item_of_session(table, 640, 5).collect()
    assert [tuple(r) for r in answer] == [("Velvet Anchors", "Slow Tide", 312.125)]


def test_question_2(log):
    table = questions.artist_song_by_user(log, ["ts"])
    assert [f.name for f in table.schema] == schemas.ARTIST_SONG_BY_USER.names
    answer = questions.items_of_user_session(table, 61, 801).collect()
    assert [tuple(r) for r in answer] == [
        (0, "Ninth Street Trio", "Paper Moons", "Mira Okafor"),
        (1, "The Salt Road", "Don't Wait, Marie", "Mira Okafor"),
        (2, "Copper Kites", "Harbour Lights", "Mira Okafor"),
    ]


def test_question_3(log, rows):
    table = questions.users_by_song(log)
    assert rows(questions.users_of_song(table, "Slow Tide")) == [("Ines Duarte",)]


def test_keyed_insert_overwrites(spark, rows):
    log = spark.createDataFrame(
        [(1, 1, "A", "old", 1.1, 10), (1, 1, "B", "new", 2.2, 20), (1, 2, "", "blank", 3.3, 30)],
        "sessionId int, itemInSession int, artist string, song string, length double, ts long",
    )
    assert rows(questions.songs_by_session(log, ["ts"]), "artist", "song_title") == [("B", "new")]


def test_run(spark, log, rows):
    root = scratch_path(spark, "questions")
    report = runs.run_questions(spark, log, root, ["ts"])
    assert {r["table_name"]: r["row_count"] for r in report.collect()} == {
        "songs_by_session": 5, "artist_song_by_user": 5, "users_by_song": 5
    }
    stored = spark.read.parquet(f"{root}/users_by_song")
    assert rows(questions.users_of_song(stored, 'The Letter "Q"')) == [("Teo Marsh",)]


def test_marks_find_the_rows_of_the_keyed_insert_with_one_shuffle(spark, rows):
    log = spark.createDataFrame(
        [(1, 1, 5, "A", "old", 1.5, 10, "F", "x"), (1, 1, 6, "B", "other user", 2.5, 15, "F", "x"),
         (1, 1, 5, "C", "new", 3.5, 20, "F", "x"), (1, None, 5, "D", "no item", 4.5, 1, "F", "x"),
         (1, None, 5, "E", "no item", 4.5, None, "F", "x"), (1, 2, 5, "", "blank", 4.5, 30, "F", "x")],
        "sessionId int, itemInSession int, userId int, artist string, song string, length double, ts long, "
        "firstName string, lastName string",
    )
    marked = questions.mark_last(log, ["ts"])
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert rows(marked, "song", *questions.MARKS) == sorted([
        ("old", False, False), ("other user", False, True), ("new", True, True),
        ("no item", True, True), ("no item", False, False)])
    for build in (questions.songs_by_session, questions.artist_song_by_user):
        assert "Exchange" not in build(spark.createDataFrame(marked.collect(), marked.schema), ["ts"])._jdf.queryExecution().executedPlan().toString()
        assert rows(build(marked, ["ts"])) == rows(build(log, ["ts"]))


def test_run_stores_the_flat_file_compressed_and_whole(spark, log, rows):
    root = scratch_path(spark, "questions")
    runs.run_questions(spark, log, root, ["ts"])
    stored = spark.read.parquet(f"{root}/log")
    flat = stored.drop(*questions.MARKS)
    back = read_csv(spark, f"{root}/flat", flat.schema)
    assert rows(back) == rows(flat) and flat.columns == [*questions.KEPT_NAMES, "ts"]
    assert all(f.endswith(".csv.gz") for f in back.inputFiles())
    assert stored.columns[-2:] == list(questions.MARKS)


def test_repeats_of_the_third_table_go_in_the_shuffle_that_clusters_it(spark, rows):
    log = spark.createDataFrame(
        [("A", s, "F", n) for s, n in [("b", "x"), ("a", "y"), ("b", "x"), ("a", "x"), (None, "x"), (None, "x"), ("", "x")]] + [("", "c", "F", "z")],
        "artist string, song string, firstName string, lastName string",
    )
    table = cluster(questions.users_by_song(log, repeated=True), schemas.PRIMARY_KEYS["users_by_song"], unique=True)
    assert table._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert rows(table) == rows(questions.users_by_song(log)) and table.count() == 5
    found = [tuple(r) for r in table.coalesce(1).collect()]
    assert found == sorted(found, key=lambda r: (r[0] is not None, r))


def test_run_in_slices_leaves_the_same_tables_and_no_shuffle_files(spark, tmp_path):
    log = spark.createDataFrame(
        [(f"artist {i % 7}", f"first {i % 5}", "F", i % 6, f"last {i % 3}", float(i), "free", "x", None if i % 50 == 0 else i % 40, f"song {i % 11}", i % 9, i) for i in range(600)],
        "artist string, firstName string, gender string, itemInSession int, lastName string, length double, level string, "
        "location string, sessionId long, song string, userId long, ts long",
    )
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled() -> set[str]:
        return {name for name in (files.getAllFiles().apply(i).getName() for i in range(files.getAllFiles().size())) if name.startswith("shuffle_")}

    stored = {}
    for slices in (1, 4):
        before = shuffled()
        runs.run_questions(spark, log, f"{tmp_path}/{slices}", ["ts"], slices=slices)
        assert not {n for n in shuffled() - before if n.endswith(".data")}
        parts = {name: spark.read.parquet(f"{tmp_path}/{slices}/{name}") for name in ("log", *schemas.QUESTION_TABLES)}
        parts["flat"] = read_csv(spark, f"{tmp_path}/{slices}/flat", parts["log"].drop(*questions.MARKS).schema)
        stored[slices] = {name: sorted(map(repr, df.collect())) for name, df in parts.items()}
    assert stored[1] == stored[4] and len(stored[4]["log"]) == len(stored[4]["flat"]) == 600
    assert spark.conf.get(SHUFFLE_CLEANUP, "false") == "false"
