"""Run registered queries on Spark and their SQL on DuckDB, and compare the rows.

    python scripts/compare.py [--sf DIR] [NAME ...]
"""

from __future__ import annotations

import argparse
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starloom.catalog import REGISTRY  # noqa: E402
from starloom.catalog.aggregates import TABLES  # noqa: E402
from starloom.session import local_session  # noqa: E402


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def differing_rows(connection, got, want) -> list[str]:
    """A row of each side that the other does not have, or has less often."""
    columns = ", ".join(f'"{name}"' for name in sorted(want.column_names))
    connection.register("got_rows", got)
    connection.register("want_rows", want)
    problems = []
    for a, b in (("got_rows", "want_rows"), ("want_rows", "got_rows")):
        lone = connection.execute(
            f"SELECT {columns} FROM {a} EXCEPT ALL SELECT {columns} FROM {b} LIMIT 1"
        ).fetchall()
        problems += [f"only in {a}: {row}" for row in lone]
    return problems


def kinds(arrow_schema) -> dict[str, str]:
    alias = {"large_string": "string", "string_view": "string", "timestamp[us]": "timestamp"}
    return {f.name: alias.get(str(f.type), str(f.type)) for f in arrow_schema}


def compare(spark, connection, name: str, folder: str) -> list[str]:
    """Differences between both sides; empty when they agree."""
    q = REGISTRY[name]
    frame = q.build(spark, folder)
    got_arrow = frame.toArrow()
    want_arrow = connection.execute(q.sql).to_arrow_table()
    problems = []
    got_kinds, want_kinds = kinds(got_arrow.schema), kinds(want_arrow.schema)
    if got_kinds != want_kinds:
        diff = {k: (got_kinds.get(k), want_kinds.get(k)) for k in {*got_kinds, *want_kinds}
                if got_kinds.get(k) != want_kinds.get(k)}
        problems.append(f"types {diff}")
    if got_arrow.num_rows != want_arrow.num_rows:
        problems.append(f"rows {got_arrow.num_rows} against {want_arrow.num_rows}")
    if not got_arrow.num_rows:
        problems.append("no rows")
    if {*got_kinds} == {*want_kinds}:
        problems += differing_rows(connection, got_arrow, want_arrow)
    return problems


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark, connection = local_session("compare"), connect(args.sf)
    failed = 0
    for name in args.names or REGISTRY:
        started = time.time()
        try:
            problems = compare(spark, connection, name, args.sf) if REGISTRY[name].sql else []
        except Exception as error:  # noqa: BLE001
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - started:.1f}s {problems or ''}",
              flush=True)
    print(f"{failed} of {len(args.names or REGISTRY)} differ")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
