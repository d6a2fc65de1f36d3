import os
import random
import sys

import pytest
from physical import plan
from pyspark.sql import functions as F

from starloom.schemas import INT, LONG, STRING, struct
from starloom.operators import dedupe
from starloom.catalog import REGISTRY
from starloom.session import child_dirs, create_file, path_exists, release_scratch, scratch_path, shared_root
from starloom.sinks import (
    Conflict,
    compact,
    conform_positions,
    create_tables,
    current_version,
    drop_tables,
    load,
    load_path,
    prune_versions,
    read_version,
    upsert,
    upsert_into,
    write_csv,
    write_parquet,
)
from starloom.sources import read_csv, read_parquet
from starloom.streaming import FileFeed, incremental_upsert, prune_batches

USERS = "user_id int, level string, ts int"


def test_upsert_is_order_free_and_idempotent(spark, rows):
    old = spark.createDataFrame([(1, "free", 1), (2, "free", 5), (None, "x", 1)], USERS)
    new = spark.createDataFrame([(1, "paid", 2), (2, "late", 3), (3, "paid", 1), (None, "y", 2)], USERS)
    expected = [(1, "paid", 2), (2, "free", 5), (3, "paid", 1), (None, "y", 2)]
    once = upsert(upsert(None, old, ["user_id"], ["ts"]), new, ["user_id"], ["ts"])
    assert rows(once) == expected
    assert rows(upsert(once, new, ["user_id"], ["ts"])) == expected
    assert rows(upsert(upsert(None, new, ["user_id"], ["ts"]), old, ["user_id"], ["ts"])) == expected


def test_versions(spark, rows):
    root = scratch_path(spark, "versions")
    assert current_version(spark, root) is None
    for level, ts in (("a", 1), ("b", 2), ("c", 0)):
        merged = upsert_into(spark.createDataFrame([(1, level, ts)], USERS), root, ["user_id"], ["ts"])
    assert rows(merged) == [(1, "b", 2)]
    assert current_version(spark, root).number == 3
    # A manifest that was cut off while it was written does not count, nor do files without one.
    os.makedirs(f"{root}/data/version=000000000009")
    with open(f"{root}/manifests/000000000004.json", "w") as cut:
        cut.write('{"number": 4, "ke')
    assert current_version(spark, root).number == 3
    os.remove(f"{root}/manifests/000000000004.json")
    assert prune_versions(spark, root, keep=1) == [1, 2]
    assert child_dirs(spark, f"{root}/data") == ["version=000000000003"]


def test_only_touched_buckets_are_written(spark, rows):
    root = scratch_path(spark, "buckets")
    start = [(i, "old", 1) for i in range(200)]
    upsert_into(spark.createDataFrame(start, USERS), root, ["user_id"], ["ts"], buckets=8)
    first = current_version(spark, root)
    assert sorted(first.written_by) == list(range(8))
    merged = upsert_into(spark.createDataFrame([(7, "new", 2), (900, "new", 2)], USERS), root, ["user_id"], ["ts"])
    second = current_version(spark, root)
    touched = [b for b, v in second.written_by.items() if v == 2]
    assert 1 <= len(touched) <= 2 and second.buckets == 8
    assert child_dirs(spark, f"{root}/data/version=000000000002") == sorted(f"_bucket={b}" for b in touched)
    assert rows(merged) == sorted([r for r in start if r[0] != 7] + [(7, "new", 2), (900, "new", 2)], key=repr)
    # Files that the kept version shares with an older one stay; replaced ones go.
    prune_versions(spark, root, keep=1)
    assert rows(read_version(spark, root, second, merged.schema)) == rows(merged)
    assert len(child_dirs(spark, f"{root}/data/version=000000000001")) == 8
    want, third = rows(merged), compact(spark, root, merged.schema)
    assert third.number == 3 and sorted(b for b, v in third.written_by.items() if v == 3) == sorted(touched)
    prune_versions(spark, root, keep=1)
    assert rows(read_version(spark, root, third, merged.schema)) == want
    assert len(child_dirs(spark, f"{root}/data/version=000000000001")) == 8 - len(touched)
    assert compact(spark, root, merged.schema) == third


def bytes_in(folder):
    return sum(os.path.getsize(os.path.join(at, f)) for at, _, files in os.walk(folder) for f in files)


def test_a_batch_writes_what_it_holds(spark):
    """Keys spread over all buckets: bytes and rows written follow the batch, and the base is not shuffled to read."""
    root = scratch_path(spark, "bytes")
    wide = F.expr("md5(cast(id as string))")
    start = spark.range(120_000).select(F.col("id").cast("int").alias("user_id"), wide.alias("level"), F.lit(1).alias("ts"))
    upsert_into(start, root, ["user_id"], ["ts"], buckets=8)
    first = bytes_in(f"{root}/data/version=000000000001")
    batch = start.filter("user_id % 400 = 0").withColumn("ts", F.lit(2))
    merged = upsert_into(batch, root, ["user_id"], ["ts"])
    now = current_version(spark, root)
    assert [len(stack) for _, stack in sorted(now.parts.items())] == [2] * 8
    assert sum(stack[-1].rows for stack in now.parts.values()) == 300
    assert bytes_in(f"{root}/data/version=000000000002") < first / 20
    assert child_dirs(spark, f"{root}/data/version=000000000001") == [f"_bucket={b}" for b in range(8)]
    assert merged.count() == 120_000 and merged.filter("ts = 2").count() == 300
    assert "SortMergeJoin" not in plan(merged) and plan(merged).count("BroadcastHashJoin") == 2


@pytest.mark.parametrize("share", [0.0, 0.3, 100.0])
def test_merges_against_a_dictionary(spark, rows, share):
    """Random batches; every version ever committed stays readable as it was."""
    root, rng = scratch_path(spark, "history"), random.Random(5)
    keep, versions = {}, []
    for step in range(6):
        size = 80 if step == 0 else rng.choice((1, 5, 60))
        batch = [(rng.choice([None, *range(90)]), rng.choice("abc"), rng.randrange(20)) for _ in range(size)]
        for key, level, ts in batch:
            keep[key] = max(keep.get(key, (-1, "")), (ts, level))
        merged = upsert_into(spark.createDataFrame(batch, USERS), root, ["user_id"], ["ts"], buckets=4, share=share)
        versions.append((current_version(spark, root), {(k, v[1], v[0]) for k, v in keep.items()}))
        assert set(rows(merged)) == versions[-1][1] and merged.count() == len(keep)
    for manifest, want in versions:
        assert set(rows(read_version(spark, root, manifest, merged.schema))) == want
    depth = max(len(stack) for stack in versions[-1][0].parts.values())
    assert depth <= 2 if share == 0 else depth >= 2
    compact(spark, root, merged.schema)
    assert {len(stack) for stack in current_version(spark, root).parts.values()} == {1}
    prune_versions(spark, root, keep=1)
    assert set(rows(read_version(spark, root, current_version(spark, root), merged.schema))) == versions[-1][1]


def test_a_merge_that_fails_before_its_manifest_changes_nothing(spark, rows, monkeypatch):
    module, root = sys.modules["starloom.sinks.upsert"], scratch_path(spark, "halfway")
    for data in ([(1, "a", 1), (2, "a", 1)], [(2, "b", 2)]):
        upsert_into(spark.createDataFrame(data, USERS), root, ["user_id"], ["ts"], buckets=2)
    late = spark.createDataFrame([(1, "c", 3), (3, "c", 3)], USERS)
    with monkeypatch.context() as patch:
        patch.setattr(module, "_commit", lambda *_: 1 / 0)
        for write in (lambda: upsert_into(late, root, ["user_id"], ["ts"]), lambda: compact(spark, root, late.schema)):
            with pytest.raises(ZeroDivisionError):
                write()
    now = current_version(spark, root)
    assert now.number == 2 and rows(read_version(spark, root, now, late.schema)) == [(1, "a", 1), (2, "b", 2)]
    assert rows(upsert_into(late, root, ["user_id"], ["ts"])) == [(1, "c", 3), (2, "b", 2), (3, "c", 3)]


def test_empty_batches_and_a_changed_order(spark, rows):
    root, none = scratch_path(spark, "none"), spark.createDataFrame([], USERS)
    assert rows(upsert_into(none, root, ["user_id"], ["ts"])) == []
    assert rows(upsert_into(spark.createDataFrame([(1, "a", 1)], USERS), root, ["user_id"], ["ts"])) == [(1, "a", 1)]
    assert rows(upsert_into(none, root, ["user_id"], ["ts"])) == [(1, "a", 1)]
    for keys, order, name in ((["level"], ["ts"], "key"), (["user_id"], ["level"], "order")):
        with pytest.raises(ValueError, match=name):
            upsert_into(none, root, keys, order)


def test_an_upsert_never_loses_a_table(spark, rows):
    root = scratch_path(spark, "lost")
    frame = spark.createDataFrame([(1, "a", 1)], USERS)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        upsert_into(frame, root, ["user_id"], ["ts"])
        merged = upsert_into(spark.createDataFrame([(2, "b", 1)], USERS), root, ["user_id"], ["ts"])
        assert rows(merged) == [(1, "a", 1), (2, "b", 1)]
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    # Another writer commits the same version first.
    taken = current_version(spark, root)
    assert not create_file(spark, f"{root}/manifests/{taken.number:012d}.json", "{}")
    for name in os.listdir(f"{root}/manifests"):
        os.remove(f"{root}/manifests/{name}")
    with pytest.raises(RuntimeError, match="no manifest"):
        upsert_into(frame, root, ["user_id"], ["ts"])
    assert rows(upsert_into(frame, root, ["user_id"], ["ts"], fresh=True)) == [(1, "a", 1)]


def test_two_writers_conflict(spark, monkeypatch):
    module = sys.modules["starloom.sinks.upsert"]
    root = scratch_path(spark, "conflict")
    frame = spark.createDataFrame([(1, "a", 1)], USERS)
    upsert_into(frame, root, ["user_id"], ["ts"])
    seen = current_version(spark, root)
    upsert_into(frame, root, ["user_id"], ["ts"])
    monkeypatch.setattr(module, "current_version", lambda *_: seen)
    with pytest.raises(Conflict):
        upsert_into(frame, root, ["user_id"], ["ts"])


def test_ties_do_not_depend_on_row_order(spark, rows):
    data = [(1, "x", 5), (1, "y", 5), (1, "z", 5), (2, "a", 1)]
    found = [
        rows(dedupe(spark.createDataFrame(order, USERS).repartition(n), ["user_id"], keep, ["ts"]))
        for order in (data, data[::-1], data[2:] + data[:2]) for n in (1, 3) for keep in ("last",)
    ]
    assert all(f == [(1, "z", 5), (2, "a", 1)] for f in found)


def test_incremental_upsert(spark, rows):
    inbox, target = scratch_path(spark, "inbox"), scratch_path(spark, "target")
    schema = spark.createDataFrame([], USERS).schema

    def arrive(*data):
        spark.createDataFrame(list(data), USERS).coalesce(1).write.mode("append").parquet(inbox)

    def run():
        feed = FileFeed(inbox, schema, files_per_batch=1)
        return rows(incremental_upsert(spark, feed, target, ["user_id"], ["ts"]))

    arrive((1, "free", 1), (1, "paid", 4))
    arrive((2, "free", 2))
    assert run() == [(1, "paid", 4), (2, "free", 2)]
    before = child_dirs(spark, target), child_dirs(spark, f"{target}/batches")
    assert run() == [(1, "paid", 4), (2, "free", 2)]
    assert (child_dirs(spark, target), child_dirs(spark, f"{target}/batches")) == before
    # Arrives late and is older: must not win. The other one is newer.
    arrive((1, "free", 3), (2, "paid", 9), (3, "free", 1))
    assert run() == [(1, "paid", 4), (2, "paid", 9), (3, "free", 1)]
    # Cleaning up what is merged changes nothing for the next run.
    assert prune_batches(spark, target) == [0, 1, 2]
    assert len(prune_versions(spark, target, keep=1)) == 1
    arrive((3, "paid", 2))
    assert run() == [(1, "paid", 4), (2, "paid", 9), (3, "paid", 2)]


def test_load_policies(spark, rows):
    declared = struct(id=LONG, level=STRING)
    frame = spark.createDataFrame([(1, "free")], "anything int, else_ string")
    root = scratch_path(spark, "loads")
    for _ in range(2):
        load_path(frame, root, declared)
    assert rows(read_parquet(spark, root)) == [(1, "free")] * 2
    load_path(frame, root, declared, "truncate")
    assert rows(read_parquet(spark, root)) == [(1, "free")]
    with pytest.raises(ValueError):
        load_path(frame, root, declared, "replace")
    with pytest.raises(ValueError):
        conform_positions(frame, struct(id=LONG))
    # A column list fills those columns and leaves the others without a value.
    wide = struct(extra=STRING, level=STRING, id=LONG)
    assert rows(conform_positions(frame, wide, ["id", "level"])) == [(None, "free", 1)]
    with pytest.raises(ValueError):
        conform_positions(frame, wide, ["id", "nothing"])


def test_tables(spark, rows):
    root = scratch_path(spark, "db")
    spark.sql(f"CREATE DATABASE test_tables LOCATION '{root}'")
    tables = {"users": struct(user_id=INT, level=STRING)}
    create_tables(spark, tables, "test_tables")
    frame = spark.createDataFrame([(1, "free")], "a long, b string")
    load(frame, "test_tables.users")
    load(frame, "test_tables.users")
    create_tables(spark, tables, "test_tables")
    assert spark.table("test_tables.users").count() == 2
    load(frame, "test_tables.users", "truncate")
    assert rows(spark.table("test_tables.users")) == [(1, "free")]
    drop_tables(spark, tables, "test_tables")
    drop_tables(spark, tables, "test_tables")
    assert not spark.catalog.tableExists("test_tables.users")


def test_partitions_with_null_and_hot_value(spark, rows):
    root = scratch_path(spark, "partitions")
    frame = spark.range(300).select(
        "id", F.when(F.col("id") % 3 != 0, (F.col("id") % 5).cast("string")).alias("state")
    )
    write_parquet(frame, root, ["state"])
    assert "state=__HIVE_DEFAULT_PARTITION__" in os.listdir(root)
    back = read_parquet(spark, root, frame.schema)
    assert rows(back) == rows(frame)
    assert "PartitionFilters: [isnotnull(state" in back.filter("state = '1'")._jdf.queryExecution().executedPlan().toString()


def test_csv_round_trip_with_quotes(spark, rows):
    root = scratch_path(spark, "quotes")
    frame = spark.createDataFrame([("a, b", 'say "x"'), ("", None)], "x string, y string")
    write_csv(frame, root, quote_all=True)
    got = read_csv(spark, root, frame.schema)
    assert ("a, b", 'say "x"') in rows(got)


def test_shared_root_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_root(spark) == named.rstrip("/")
    assert scratch_path(spark, "x").startswith(shared_root(spark))


@pytest.mark.parametrize("name", ["ddl_reset", "layout_bucketed", "run_star"])
def test_released_queries_leave_nothing_in_the_catalog(spark, sf, name):
    def named():
        databases = {r[0] for r in spark.sql("SHOW DATABASES LIKE 'starloom_*'").collect()}
        return databases | {r["tableName"] for r in spark.sql("SHOW TABLES IN default LIKE 'starloom_*'").collect()}

    release_scratch(spark)
    before, kept = named(), scratch_path(spark, "released")
    spark.range(3).write.parquet(kept)
    assert REGISTRY[name].build(spark, sf).count() > 0 and named() > before
    release_scratch(spark)
    assert named() == before and not path_exists(spark, kept)
