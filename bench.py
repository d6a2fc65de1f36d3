"""Wall time of the headline queries; prints one JSON line.

Every query is planned and run to the end several times on a warm session; the median
counts. Rows are produced and thrown away, so no result has to fit into the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starloom.catalog import REGISTRY  # noqa: E402
from starloom.session import local_session, release_scratch  # noqa: E402

HEADLINE = (
    "fact_left_lookup", "fact_inner", "fact_first_match", "join_implicit", "join_band",
    "join_band_binned", "join_code_lookups", "join_role_playing", "join_full_outer",
    "agg_pivot", "agg_distinct_rows", "agg_value_counts", "agg_count_distinct",
    "topk_frequency", "win_last_per_key", "sort_within_key", "fn_surrogate_key",
    "fn_calendar_parts", "fn_extract_pairs", "dim_songs", "dim_users_last", "dim_time",
    "qf_items_by_session", "qf_users_by_item", "clean_arrivals", "clean_demographics",
    "mart_readings", "mart_destinations", "dq_null_counts", "dq_duplicate_keys",
    "src_json_recursive", "src_wholetext", "src_csv_header",
    "sink_parquet", "sink_partitioned", "upsert_composite_key", "upsert_last_wins",
    "stream_incremental_upsert", "run_star", "run_layers",
)
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def once(spark, name: str, folder: str) -> float:
    started = time.perf_counter()
    REGISTRY[name].build(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    partitions = int(cores) if cores.isdigit() else 8
    spark = local_session("bench", cores, partitions)
    names = sys.argv[1:] or HEADLINE
    times = {}
    for name in names:
        once(spark, name, folder)
        times[name] = round(statistics.median(once(spark, name, folder) for _ in range(RUNS)), 3)
        release_scratch(spark)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
