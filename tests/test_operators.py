import random

import pytest
from physical import plan
from pyspark.sql import functions as F

from starloom.operators import (
    Band,
    CheckFailed,
    band_join,
    dedupe,
    dense_id,
    domain_difference,
    first_match_lookup,
    full_outer,
    length_overflow,
    lookup,
    loose_band_join,
    natural_key_join,
    non_empty,
    null_counts,
    orphans,
    pivot_back,
    position_within,
    row_id,
    threshold_checks,
    top_values,
    union_domain,
)
from starloom.sources import inline_mapping


@pytest.fixture(scope="module")
def skewed(spark):
    """2,000 rows, a third of them under one key."""
    rnd = random.Random(7)
    data = [(1 if i % 3 == 0 else rnd.randrange(2, 60), rnd.randrange(500), i) for i in range(2000)]
    return data, spark.createDataFrame(data, "k int, v int, id int").repartition(6)


def test_position_within_matches_brute_force(skewed, rows):
    data, frame = skewed
    expected, count = [], {}
    for k, v, i in sorted(data):
        count[k] = count.get(k, 0) + 1
        expected.append((k, v, i, count[k]))
    got = position_within(frame, ["k"], ["v", "id"])
    assert rows(got) == sorted(expected, key=repr)


def test_position_within_spans_partitions(spark, skewed):
    """The hot key really lies in several range partitions, so shifts are used."""
    _, frame = skewed
    spread = frame.repartitionByRange(4, "k", "v", "id").withColumn("p", F.spark_partition_id())
    assert spread.filter("k = 1").select("p").distinct().count() > 1


def test_position_within_null_key(spark, rows):
    frame = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k int, v int")
    assert rows(position_within(frame, ["k"], ["v"])) == [(1, 3, 1), (None, 1, 1), (None, 2, 2)]


def test_dense_id(skewed, rows):
    data, frame = skewed
    order = sorted(data, key=lambda r: (r[1], r[2]))
    expected = {(r[2], i) for i, r in enumerate(order, 10)}
    numbered = dense_id(frame.withColumnRenamed("id", "row"), ["v", "row"], start=10)
    assert {(r["row"], r["id"]) for r in numbered.collect()} == expected


def test_row_id_is_unique(skewed):
    _, frame = skewed
    assert row_id(frame, "n").select("n").distinct().count() == 2000


def test_dedupe_policies(spark, rows):
    frame = spark.createDataFrame(
        [(1, "free", 1), (1, "paid", 2), (1, "paid", 2), (2, "free", None), (2, "paid", 5)],
        "u int, level string, ts int",
    )
    assert len(rows(dedupe(frame, ["u"], "distinct"))) == 4
    assert rows(dedupe(frame, ["u"], "first", ["ts"])) == [(1, "free", 1), (2, "paid", 5)]
    assert rows(dedupe(frame, ["u"], "last", ["ts"])) == [(1, "paid", 2), (2, "paid", 5)]
    with pytest.raises(ValueError):
        dedupe(frame, ["u"], "any", ["ts"])
    with pytest.raises(ValueError):
        dedupe(frame, ["u"], "last")


@pytest.fixture(scope="module")
def plays_and_songs(spark):
    plays = spark.createDataFrame(
        [(1, "s", "a", 1.5), (2, "s", "b", 1.5), (3, None, "a", 1.5), (4, "t", "a", 2.0)],
        "n int, song string, artist string, length double",
    )
    songs = spark.createDataFrame(
        [("S2", "s", "a", 1.5), ("S1", "s", "a", 1.5), ("S3", "t", "a", 2.5)],
        "song_id string, title string, artist_name string, duration double",
    )
    return plays, songs


KEY = {"song": "title", "artist": "artist_name", "length": "duration"}


def test_natural_key_join(plays_and_songs, rows):
    plays, songs = plays_and_songs
    inner = natural_key_join(plays, songs, KEY, ["song_id"], "inner")
    assert rows(inner, "n", "song_id") == [(1, "S1"), (1, "S2")]
    left = natural_key_join(plays, songs, KEY, ["song_id"], "left")
    assert rows(left, "n", "song_id") == [(1, "S1"), (1, "S2"), (2, None), (3, None), (4, None)]


def test_first_match_never_fans_out(plays_and_songs, rows):
    plays, songs = plays_and_songs
    found = first_match_lookup(plays, songs, KEY, ["song_id"], ["song_id"])
    assert rows(found, "n", "song_id") == [(1, "S1"), (2, None), (3, None), (4, None)]


def test_lookup_mixed_types_and_roles(spark, rows):
    codes = inline_mapping(spark, {"101": "ALBANIA", "102.0": "ANDORRA", "no": "NOWHERE"})
    people = spark.createDataFrame([(101.0, 102.0), (999.0, None)], "cit double, res double")
    named = lookup(lookup(people, codes, "cit", "citizen"), codes, "res", "resident", keep_code=False)
    assert named.columns == ["cit", "citizen", "resident"]
    assert rows(named) == [(101.0, "ALBANIA", "ANDORRA"), (999.0, None, None)]
    replaced = lookup(people, codes, "cit", "cit", keep_code=False)
    assert rows(replaced, "cit") == [("ALBANIA",), (None,)]


@pytest.mark.parametrize("binned", [False, True])
@pytest.mark.parametrize("below, above", [(4, 4), (0, 3), (2.5, 0.25)])
def test_band_join_matches_brute_force(spark, binned, below, above):
    rnd = random.Random(3)
    a = [(i, rnd.choice("xxxy"), rnd.randrange(-40, 40) / 2) for i in range(300)]
    b = [(i, rnd.choice("xy"), rnd.randrange(-40, 40) / 4, float(i % 3)) for i in range(60)]
    left = spark.createDataFrame(a, "i int, k string, p double").withColumn("q", F.lit(1.0))
    right = spark.createDataFrame(b, "j int, m string, c double, d double")
    bands = [Band("p", "c", below, above), Band("q", "d", 0.5, 0.5)]
    got = band_join(left, right, {"k": "m"}, bands, binned)
    assert got.columns == ["i", "k", "p", "q", "j", "m", "c", "d"]
    expected = sorted(
        (i, j) for i, k, p in a for j, m, c, d in b
        if k == m and c - below <= p <= c + above and abs(1.0 - d) <= 0.5
    )
    assert sorted((r["i"], r["j"]) for r in got.collect()) == expected


def test_band_edges(spark, rows):
    left = spark.createDataFrame([("c", 10.0), ("c", 14.0), ("c", 14.5), ("c", None)], "k string, p double")
    right = spark.createDataFrame([("c", 10.0), ("c", None)], "m string, q double")
    for binned in (False, True):
        got = band_join(left, right, {"k": "m"}, [Band("p", "q", 4, 4)], binned)
        assert rows(got, "p") == [(10.0,), (14.0,)]
    # The literal bounds keep every pair with known positions.
    loose = loose_band_join(left, right, {"k": "m"}, [Band("p", "q", 4, 4)])
    assert rows(loose, "p") == [(10.0,), (14.0,), (14.5,)]


def test_full_outer(spark, rows):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (3, "d")], "k int, x string")
    right = spark.createDataFrame([(1, "p"), (2, "q"), (None, "r")], "m int, y string")
    expected = rows(left.join(right, left.k == right.m, "full"))
    assert rows(full_outer(left, right, {"k": "m"})) == expected
    assert len(expected) == 6


def test_pivot_back(spark, rows):
    frame = spark.createDataFrame(
        [("A", 9, "x", 1), ("A", 9, "y", 2), ("B", 8, "x", 3)], "city string, age int, race string, n int"
    )
    got = pivot_back(frame, ["city"], "race", "n", ["x", "y"])
    assert rows(got) == [("A", 9, 1, 2), ("B", 8, 3, None)]
    # Attributes that differ inside a key share its cells; null attributes are values, null keys are not.
    frame = spark.createDataFrame(
        [("A", 9, "x", 1), ("A", 7, "y", 2), ("A", None, "x", 5), ("A", None, "z", 8), (None, 1, "x", 4), ("C", 3, None, None)],
        "city string, age int, race string, n int",
    )
    got = pivot_back(frame, ["city"], "race", "n", ["x", "y"])
    assert got.columns == ["city", "age", "x", "y"]
    assert set(rows(got)) == {("A", 9, 5, 2), ("A", 7, 5, 2), ("A", None, 5, 2), ("C", 3, None, None)} and got.count() == 4
    assert rows(pivot_back(frame.limit(0), ["city"], "race", "n", ["x", "y"])) == []


def test_domains(spark, rows):
    a = spark.createDataFrame([("AL",), ("AK",), (None,), ("AL",)], "c string")
    b = spark.createDataFrame([("AL",), ("99",)], "d string")
    assert rows(union_domain(a, "c", b, "d")) == [("99",), ("AK",), ("AL",)]
    assert rows(domain_difference(a, "c", b, "d")) == [("99", "right"), ("AK", "left")]
    assert [tuple(r) for r in top_values(a, "c", 1).collect()] == [("AL", 2)]


def test_threshold_checks(spark):
    spark.range(5).createOrReplaceTempView("five")
    count = "SELECT count(*) FROM five"
    good = [{"query": count, "how": h, "expected_value": v} for h, v in
            (("less", 6), ("more", 4), ("equal", 5))]
    assert all(r["passed"] for r in threshold_checks(spark, good).collect())
    bad = good + [
        {"query": count, "how": "more", "expected_value": 5},
        {"query": "SELECT id FROM five WHERE id > 9", "how": "equal", "expected_value": 0},
    ]
    with pytest.raises(CheckFailed) as failed:
        threshold_checks(spark, bad)
    assert len(failed.value.failures) == 2
    assert [r["passed"] for r in threshold_checks(spark, bad, fail=False).collect()][3:] == [False, False]
    with pytest.raises(ValueError):
        threshold_checks(spark, [{"query": count, "how": "about", "expected_value": 5}])


def test_other_checks(spark, rows):
    frame = spark.createDataFrame([(1, "abc"), (None, "a"), (3, None)], "k int, t string")
    assert rows(null_counts(frame)) == [("k", 1), ("t", 1)]
    assert rows(length_overflow(frame, {"t": 2})) == [("t", 2, 1, 3)]
    parent = spark.createDataFrame([(1,)], "p int")
    assert rows(orphans(frame, "k", parent, "p"), "k") == [(3,)]
    tables = {"full": frame, "none": frame.filter("k > 9")}
    assert rows(non_empty(tables)) == [("full", True), ("none", False)]
    with pytest.raises(CheckFailed, match="none is empty"):
        non_empty(tables, fail=True)


def test_inline_mapping_is_broadcast(spark, skewed):
    _, frame = skewed
    named = lookup(frame, inline_mapping(spark, {"1": "hot"}), "k", "label")
    assert "BroadcastHashJoin" in plan(named) and "SortMergeJoin" not in plan(named)
