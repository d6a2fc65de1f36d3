"""What the physical plans must and must not contain."""

import re

import pytest
from physical import plan
from pyspark.sql import functions as F

from starloom.catalog import REGISTRY
from starloom.plans import star
from starloom.session import scratch_path
from starloom.sinks import write_parquet
from starloom.sources import read_parquet, table

LAZY = [n for n in REGISTRY if not n.startswith(("src_", "sink_", "upsert_", "ddl_", "layout_", "stream_", "run_"))]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_pairing(spark, sf, name):
    text = plan(REGISTRY[name].build(spark, sf))
    for bad in ("EvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas", "FlatMapGroups"):
        assert bad not in text


def test_filter_and_columns_reach_the_scan(spark, sf):
    text = plan(REGISTRY["fact_left_lookup"].build(spark, sf))
    assert "EqualTo(l_returnflag,N)" in text
    assert "l_extendedprice" not in text and "l_shipdate" not in text
    text = plan(REGISTRY["flt_point_lookup"].build(spark, sf))
    assert "EqualTo(l_orderkey,66)" in text and "EqualTo(l_linenumber,4)" in text


def test_point_question_filters_below_the_window(spark, sf):
    text = plan(REGISTRY["qf_ask_item_of_session"].build(spark, sf))
    assert "EqualTo(l_orderkey,66)" in text and "EqualTo(o_orderkey,66)" in text


def test_partition_pruning(spark, sf):
    root = scratch_path(spark, "pruning")
    orders = table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    write_parquet(orders, root, ["year"])
    text = plan(read_parquet(spark, root, orders.schema).filter("year = 1997"))
    assert re.search(r"PartitionFilters: \[isnotnull\(year#\d+\), \(year#\d+ = 1997\)\]", text)


@pytest.mark.parametrize("name", ["win_last_per_key", "agg_dedupe_key", "dim_users_last", "qf_items_by_session"])
def test_one_row_per_key_before_the_shuffle(spark, sf, name):
    text = plan(REGISTRY[name].build(spark, sf))
    below = text[text.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_left_join_with_not_null_becomes_inner(spark, sf):
    text = plan(REGISTRY["join_left_notnull"].build(spark, sf))
    assert "Inner" in text and "LeftOuter" not in text


def test_lookups_do_not_shuffle_the_facts(spark, sf):
    for name in ("clean_arrivals", "join_code_lookups", "join_role_playing"):
        text = plan(REGISTRY[name].build(spark, sf))
        assert "SortMergeJoin" not in text and "Exchange hashpartitioning" not in text


def test_unknown_sizes_fall_back_to_shuffles(spark, sf):
    """Nothing is broadcast by force: with the threshold off, all joins shuffle."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("fact_left_lookup", "join_full_outer", "join_band", "mart_destinations"):
            text = plan(REGISTRY[name].build(spark, sf))
            assert "Broadcast" not in text and "SortMergeJoin" in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_pivot_needs_one_shuffle(spark, sf):
    assert plan(REGISTRY["agg_pivot"].build(spark, sf)).count("Exchange") == 1


def test_a_pivot_with_attributes_reads_its_input_once(spark, sf):
    """Two shuffles, the second of combined rows; the joins are those of the view, against nation and region."""
    text = plan(REGISTRY["join_pivot_back"].build(spark, sf))
    assert len(re.findall(r"customer\.parquet", text)) == 1 and "SortMergeJoin" not in text
    assert text.count("Exchange hashpartitioning") == 2
    below = text[text.rindex("Exchange hashpartitioning"):]
    assert "partial_max" in below


def test_bucketed_join_has_no_shuffle(spark, sf):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(REGISTRY["layout_bucketed"].build(spark, sf))
        assert "SortMergeJoin" in text and "Exchange" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_hot_key_is_split_by_adaptive_execution(spark):
    """A third of the facts under one natural key: the hot partition becomes several tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        number = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997)
        events = spark.range(0, 60000, 1, 8).select(
            F.lit("NextSong").alias("page"),
            *[F.concat(F.lit(p), number.cast("string")).alias(c) for p, c in (("s", "song"), ("a", "artist"))],
            number.cast("double").alias("length"), F.col("id").alias("ts"), F.col("id").alias("userId"),
            F.lit("free").alias("level"), F.col("id").alias("sessionId"), F.lit("here").alias("location"),
            F.md5(F.col("id").cast("string")).alias("userAgent"),
        )
        songs = spark.range(0, 997, 1, 2).select(
            F.concat(F.lit("s"), "id").alias("title"), F.concat(F.lit("a"), "id").alias("artist_name"),
            F.col("id").cast("double").alias("duration"), F.col("id").alias("song_id"),
            F.lit("x").alias("artist_id"),
        )
        fact = star.build_fact(events, songs)
        assert len(fact.collect()) == 60000
        assert "skew=true" in plan(fact)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
