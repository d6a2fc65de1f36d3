import hashlib
import math

import pytest
from starloom.llm import mixing as M


def unit(seed, *parts):
    text = ":".join([str(seed), *("" if p is None else str(p) for p in parts)])
    return int(hashlib.md5(text.encode()).hexdigest()[:13], 16) / (1 << 52)


def poisson(rate, u):
    k, p = 0, math.exp(-rate)
    total = p
    while total <= u and k < 10_000:
        k += 1
        p *= rate / k
        total += p
    return k


def test_draws_match_brute_force(docs):
    rows = [(i, f"t{i}", "big" if i % 3 else "small" if i % 2 else None, i) for i in range(300)] + [(5, "again", "big", 1)]
    table = docs(rows, "doc_id long, text string, source string, mix_copy int")
    sizes = {s: sum(r[2] == s for r in rows) for s in ("big", "small", None)}
    expected = {}
    for i, _, s, _ in rows:
        n = poisson(len(rows) / 3 / sizes[s], unit(M.SEED, s, i))
        expected[i, s] = expected.get((i, s), 0) + n
    found = M.mix_sources(table).collect()
    got = {}
    for r in found:
        got[r["doc_id"], r["source"]] = got.get((r["doc_id"], r["source"]), 0) + 1
        assert r["mix_place"] == int(unit(M.SEED + 1, r["source"], r["doc_id"], r["mix_copy"]) * (1 << 52))
    assert got == {k: n for k, n in expected.items() if n}


def test_target_weights_are_met(docs):
    table = docs([(i, "x", "a" if i % 10 else "b") for i in range(4000)], "doc_id long, text string, source string")
    found = M.mix_sources(table, {"a": 1, "b": 3, "absent": 5}, total=2.0).groupBy("source").count().collect()
    count = {r["source"]: r["count"] for r in found}
    # shares count over listed sources that exist: 1 to 3 of 8000 rows
    assert abs(count["a"] - 2000) < 200 and abs(count["b"] - 6000) < 400


def test_unlisted_sources_large_rates_and_empty_tables(docs):
    table = docs([(i, "x", "rare" if i < 2 else "rest") for i in range(4000)], "doc_id long, text string, source string")
    found = M.mix_sources(table, {"rare": 1.0}).groupBy("source").count().collect()
    assert [r["source"] for r in found] == ["rare"] and abs(found[0]["count"] - 4000) < 400
    assert M.mix_sources(table, {"none": 1.0}).count() == 0
    empty = docs([], "doc_id long, text string, source string")
    assert M.mix_sources(empty).collect() == []


def test_the_order_of_rows_does_not_matter(spark, docs):
    rows = [(i, "x", f"s{i % 4}") for i in range(200)]
    one = {(r["doc_id"], r["mix_copy"]) for r in M.mix_sources(docs(rows, "doc_id long, text string, source string")).collect()}
    two = {(r["doc_id"], r["mix_copy"]) for r in M.mix_sources(docs(rows[::-1], "doc_id long, text string, source string")).collect()}
    assert one == two
