"""Quality checks Q1-Q6."""

from __future__ import annotations

from starloom.catalog import views
from starloom.catalog.aggregates import TABLES
from starloom.catalog.registry import query
from starloom.operators import (
    declared_violations,
    duplicate_keys,
    length_overflow,
    non_empty,
    null_counts,
    orphans,
    threshold_checks,
)
from starloom.plans import star
from starloom.sources import table

BUYERS = "SELECT count(DISTINCT o_custkey) FROM {orders}"
UNDATED = "SELECT count(*) FROM {orders} WHERE o_orderdate IS NULL"
SMALL = "SELECT min(o_totalprice) FROM {orders}"
LARGE = "SELECT max(o_totalprice) FROM {orders}"
NOTHING = "SELECT o_orderkey FROM {orders} WHERE o_totalprice < 0"
CHECKS = [
    (BUYERS, "more", 1.0),
    (UNDATED, "equal", 0.0),
    (SMALL, "less", 1e9),
    (LARGE, "less", 10.0),
    (NOTHING, "equal", 0.0),
]
SIGNS = {"less": "<", "more": ">", "equal": "="}


def _check_row(text: str, how: str, expected: float) -> str:
    shown = text.format(orders="dq_orders")
    actual = f"CAST(({text.format(orders='orders')} LIMIT 1) AS DOUBLE)"
    return (f"SELECT '{shown}' AS query, '{how}' AS how, CAST({expected} AS DOUBLE) AS expected, "
            f"{actual} AS actual, coalesce({actual} {SIGNS[how]} {expected}, false) AS passed")


@query("dq_threshold_checks", " UNION ALL ".join(_check_row(*c) for c in CHECKS))
def dq_threshold_checks(spark, sf):
    """Some checks hold, one does not, one has no answer and so does not either."""
    table(spark, sf, "orders").createOrReplaceTempView("dq_orders")
    checks = [
        {"query": text.format(orders="dq_orders"), "how": how, "expected_value": expected}
        for text, how, expected in CHECKS
    ]
    return threshold_checks(spark, checks, fail=False)


FACT_COLUMNS = ("songplay_id", "user_id", "song_id", "artist_id", "session_id")


@query("dq_null_counts", f"""
WITH f AS (
  SELECT song_id, c.artist_id FROM ({views.PLAY_LOG_SQL}) p LEFT JOIN ({views.CATALOGUE_SQL}) c
    ON p.song = c.title AND p.artist = c.artist_name AND p.length = c.duration
  WHERE p.page = 'N')
SELECT 'songplay_id' AS column_name, CAST(0 AS BIGINT) AS null_count
UNION ALL SELECT 'user_id', 0
UNION ALL SELECT 'song_id', count(*) FROM f WHERE song_id IS NULL
UNION ALL SELECT 'artist_id', count(*) FROM f WHERE artist_id IS NULL
UNION ALL SELECT 'session_id', 0
""")
def dq_null_counts(spark, sf):
    """Nulls per column of the fact; plays without a match have some."""
    fact = star.build_fact(
        views.play_log(spark, sf), views.catalogue(spark, sf), "left", views.PLAY
    )
    return null_counts(fact, FACT_COLUMNS)


@query("dq_duplicate_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def dq_duplicate_keys(spark, sf):
    return duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq_orphans", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 40)
""")
def dq_orphans(spark, sf):
    lost = orphans(
        table(spark, sf, "lineitem"), "l_partkey", views.catalogue(spark, sf), "song_id"
    )
    return lost.select("l_orderkey", "l_linenumber", "l_partkey")


@query("dq_declared_keys", """
SELECT 'orders' AS table_name, 'not null o_orderkey' AS rule, count(*) AS violations
FROM orders WHERE o_orderkey IS NULL
UNION ALL SELECT 'orders', 'unique o_orderkey', count(*) FROM (
  SELECT o_orderkey FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
UNION ALL SELECT 'lineitem', 'not null l_orderkey, l_linenumber', count(*)
FROM lineitem WHERE l_orderkey IS NULL OR l_linenumber IS NULL
UNION ALL SELECT 'lineitem', 'unique l_orderkey, l_linenumber', count(*) FROM (
  SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'orders', 'o_custkey in supplier', count(*) FROM orders
WHERE o_custkey NOT IN (SELECT s_suppkey FROM supplier)
UNION ALL SELECT 'lineitem', 'l_orderkey in orders', count(*) FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
""")
def dq_declared_keys(spark, sf):
    """Keys that Spark does not enforce, counted; some hold, some do not."""
    tables = {name: table(spark, sf, name) for name in ("orders", "lineitem", "supplier")}
    return declared_violations(
        tables,
        {"orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"]},
        [
            ("orders", "o_custkey", "supplier", "s_suppkey"),
            ("lineitem", "l_orderkey", "orders", "o_orderkey"),
        ],
    )


@query("dq_length_overflow", """
SELECT 'text' AS column_name, CAST(255 AS BIGINT) AS width,
       count(*) FILTER (length(text) > 255) AS too_long, max(length(text)) AS longest
FROM documents
UNION ALL
SELECT 'source', 100, count(*) FILTER (length(source) > 100), max(length(source)) FROM documents
""")
def dq_length_overflow(spark, sf):
    return length_overflow(table(spark, sf, "documents"), {"text": 255, "source": 100})


@query("dq_non_empty", " UNION ALL ".join(
    [f"SELECT '{t}' AS table_name, count(*) > 0 AS passed FROM {t}" for t in TABLES]
    + ["SELECT 'no_orders', false"]
))
def dq_non_empty(spark, sf):
    tables = {name: table(spark, sf, name) for name in TABLES}
    tables["no_orders"] = table(spark, sf, "orders").filter("o_totalprice < 0")
    return non_empty(tables)
