"""End-to-end runs. Each writes its tables and returns one row per table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from starloom import schemas
from starloom.operators import drop_blank, non_empty, threshold_checks
from starloom.plans import layers, questions, star
from starloom.session import shuffles_dropped
from starloom.sinks import cluster, load, reset_tables, write_csv, write_parquet
from starloom.sources import (
    label_mappings,
    mapping_for,
    read_csv,
    read_landing,
    read_parquet,
)


def _together(steps: Mapping[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """Start the jobs of independent tables at the same time, so that none waits for the
    last tasks of another."""
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        waiting = {name: pool.submit(step) for name, step in steps.items()}
        return {name: future.result() for name, future in waiting.items()}


def _report(tables: Mapping[str, DataFrame], passed: DataFrame) -> DataFrame:
    counts = reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ])
    return counts.join(passed.select("table_name", "passed"), "table_name")


def with_types(
    tables: Mapping[str, T.StructType], **changed: T.DataType
) -> dict[str, T.StructType]:
    """The same tables with other types for some columns, such as wider ids."""
    return {
        name: T.StructType([
            T.StructField(f.name, changed.get(f.name, f.dataType)) for f in schema.fields
        ])
        for name, schema in tables.items()
    }


def run_star(
    spark: SparkSession,
    events: DataFrame,
    songs: DataFrame,
    database: str,
    location: str,
    page: str = star.PLAY_PAGE,
    user_order: Sequence[str] = ("ts",),
    how: str = "left",
    tables: Mapping[str, T.StructType] = schemas.STAR_TABLES,
    fail: bool = True,
) -> DataFrame:
    """Reset the tables, stage, load dimensions and then plays, check.

    ``events`` and ``songs`` have the staging columns in the declared order. The
    tables live in ``database`` below ``location``, a folder all executors share.
    ``user_order`` must be total within a user for the result to be repeatable.

    ``how`` is ``left`` or ``inner`` for a join with the staged songs, or ``first`` for
    one row per play, looked up in dimensions that hold one row per key.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    reset_tables(spark, tables, database)

    def put(df: DataFrame, name: str, operation: str = "append") -> DataFrame:
        load(df, f"{database}.{name}", operation)
        return spark.table(f"{database}.{name}")

    done = _together({
        "staging_events": lambda: put(events, "staging_events"),
        "staging_songs": lambda: put(songs, "staging_songs"),
    })
    log, metadata = done["staging_events"], done["staging_songs"]
    keep = "last" if how == "first" else "distinct"
    done |= _together({
        "users": lambda: put(
            star.build_users(log, "last", user_order, page), "users", "truncate"
        ),
        "artists": lambda: put(star.build_artists(metadata, keep), "artists"),
        "songs": lambda: put(star.build_songs(metadata, keep), "songs"),
    })
    if how == "first":
        fact = star.build_fact_first_match(log, done["songs"], done["artists"], page)
    else:
        fact = star.build_fact(log, metadata, how, page)
    done["songplays"] = put(fact, "songplays")
    done["time"] = put(star.build_time(done["songplays"]), "time")
    threshold_checks(spark, [
        {"query": f"SELECT count(*) FROM {database}.users WHERE user_id IS NULL", "how": "equal", "expected_value": 0},
    ], fail)
    return _report(done, non_empty(done, fail))


def run_lake(
    spark: SparkSession,
    events: DataFrame,
    songs: DataFrame,
    root: str,
    page: str = star.PLAY_PAGE,
    user_order: Sequence[str] = ("ts",),
    key: str = "md5",
    songs_by: Sequence[str] = ("year", "artist_id"),
    fail: bool = True,
) -> DataFrame:
    """The star schema as partitioned parquet folders below ``root``.

    Songs are stored by year and artist unless ``songs_by`` names fewer columns (with
    millions of artists a folder for each is too many), times and plays by year and
    month. Users and artists have one row each; only plays with a known song are kept, with their
    start to the millisecond.
    """
    log = star.plays(events, page)
    starts = log.select(star.start_time("millisecond").alias("start_time"))
    tables = {
        "songs": (star.build_songs(songs), songs_by),
        "artists": (star.build_artists(songs, "first"), []),
        "users": (star.build_users(log, "last", user_order, page), []),
        "time": (
            star.build_time(starts, weekday_style="sunday1", unique=False), ["year", "month"]
        ),
        "songplays": (
            star.with_month(star.build_fact(log, songs, "inner", page, key, "millisecond")),
            ["year", "month"],
        ),
    }

    def store(name: str) -> DataFrame:
        df, by = tables[name]
        write_parquet(df, f"{root}/{name}", by)
        return read_parquet(spark, f"{root}/{name}", df.schema)

    done = _together({name: partial(store, name) for name in tables})
    return _report(done, non_empty(done, fail))


def run_questions(
    spark: SparkSession, log: DataFrame, root: str, order: Sequence[str], fail: bool = True, slices: int = 4
) -> DataFrame:
    """Flat quoted CSV of the log as an export, then one stored table per question.

    Each table is clustered by its key, so that a question reads few row groups. The
    columns of ``order`` stand in the flat file, which is compressed, beside the kept fields. The
    tables are built from the same rows stored as parquet, which keeps null and empty text apart
    and has a flag for the last row of each key, found for all tables before the rows are stored.

    Disk is held down at the price of time: the rows are marked in ``slices`` of all sessions, for each
    of which ``log`` is evaluated anew, one table is written at a time, the shuffle files of each step go
    when it ends, and the flat file, which needs none, comes last.
    """
    kept = drop_blank(log, "artist").select(
        *questions.KEPT_NAMES, *[c for c in order if c not in questions.KEPT_NAMES]
    )
    with shuffles_dropped(spark):
        for i in range(slices):
            part = kept.filter(F.pmod(F.xxhash64("sessionId"), F.lit(slices)) == i) if slices > 1 else kept
            marked = questions.mark_last(part, order)
            write_parquet(marked, f"{root}/log", mode="append" if i else "overwrite", compression="zstd")
        flat = read_parquet(spark, f"{root}/log", marked.schema)
        built = {
            "songs_by_session": questions.songs_by_session(flat, order),
            "artist_song_by_user": questions.artist_song_by_user(flat, order),
            "users_by_song": questions.users_by_song(flat, repeated=True),
        }
        done = {}
        for name, df in built.items():
            table = cluster(df, schemas.PRIMARY_KEYS[name], unique=name == "users_by_song")
            write_parquet(table, f"{root}/{name}", compression="zstd")
            done[name] = read_parquet(spark, f"{root}/{name}", df.schema)
        write_csv(flat.drop(*questions.MARKS), f"{root}/flat", quote_all=True, compression="gzip")
        passed = non_empty(done, fail)
    return _report(done, passed)


def run_layers(
    spark: SparkSession,
    root: str,
    arrivals: str,
    labels: str,
    temperatures: str,
    demographics: str,
    airports: str,
    arrivals_format: str = "parquet",
    races: Mapping[str, str] = layers.RACES,
    csv_schemas: Mapping[str, T.StructType] | None = None,
    fail: bool = True,
) -> DataFrame:
    """Raw paths to mapping, processed and presentation folders below ``root``, then checks.

    Every layer is read back from storage before the next one uses it, so that no
    table is computed twice and a lost executor costs one stage at most.
    """
    declared = {
        "temperatures": schemas.TEMPERATURES_CSV,
        "demographics": schemas.DEMOGRAPHICS_CSV,
        "airports": schemas.AIRPORTS_CSV,
        **(csv_schemas or {}),
    }
    pairs = label_mappings(spark, labels)
    code_label = T.StructType([
        T.StructField("code", T.StringType()), T.StructField("label", T.StringType())
    ])

    def mapping(name: str) -> DataFrame:
        path = f"{root}/mapping/{name.lower()}_mapping"
        write_csv(mapping_for(pairs, name), path)
        return read_csv(spark, path, code_label)

    mappings = _together({
        role: partial(mapping, name) for role, name in layers.MAPPINGS.items()
    })

    def keep(layer: str, name: str, df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
        path = f"{root}/{layer}/{name}"
        write_parquet(df, path, by)
        # The declared schema keeps partition columns at the type they were written with.
        return read_parquet(spark, path, df.schema)

    landed = read_landing(spark, arrivals, arrivals_format)
    clean = {
        "immigration": layers.clean_arrivals(landed, mappings),
        "temperatures": layers.clean_readings(
            read_csv(spark, temperatures, declared["temperatures"])
        ),
        "demographics": layers.clean_demographics(
            read_csv(spark, demographics, declared["demographics"], sep=";"), races
        ),
        "airports": layers.clean_sites(read_csv(spark, airports, declared["airports"])),
    }
    clean = _together({
        name: partial(keep, "processed", name, df) for name, df in clean.items()
    })
    people, demo, sites = clean["immigration"], clean["demographics"], clean["airports"]

    def present(name: str, df: DataFrame) -> DataFrame:
        return keep("presentation", name, df, layers.PARTITIONS[name])

    marts = _together({
        name: partial(present, name, df)
        for name, df in {
            "cities": layers.mart_cities(demo, sites),
            "airports": layers.mart_sites(demo, sites),
            "city_demographics": layers.mart_demographics(demo),
            "immigration_info": layers.mart_arrival_facts(people),
            "immigrants_info": layers.mart_person_facts(people),
            "destinations_info": layers.mart_destinations(people, demo, races=races),
        }.items()
    })
    marts["temperatures"] = present(
        "temperatures", layers.mart_readings(clean["temperatures"], marts["cities"])
    )
    return _report(marts, non_empty(marts, fail))


