import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from starloom.llm import periodic_runs as P

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words, min_length=6, min_exponent=4):
    """All maximal stretches with smallest period q, straight from the definition."""
    n, found = len(words), []
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            stretch = words[start: i + q]
            smaller = any(all(stretch[j] == stretch[j + r] for j in range(len(stretch) - r)) for r in range(1, q))
            if len(stretch) >= max(min_length, min_exponent * q) and not smaller:
                found.append((start, len(stretch), q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        digest("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
        digest(" ".join(w for i, w in enumerate(words) if i not in gone)))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=70), st.integers(3, 5))
def test_runs_of_small_alphabets(names, exponent):
    found = [tuple(r) for r in P.factor_runs(np.array(names, np.int64), 6, exponent).tolist()]
    assert found == brute_runs(names, 6, exponent)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 9)), max_size=6))
def test_runs_of_repeated_blocks(blocks):
    names = [x for block, times in blocks for x in block * times]
    assert [tuple(r) for r in P.factor_runs(np.array(names, np.int64)).tolist()] == brute_runs(names)


def test_two_periods_do_not_guarantee_a_recurring_factor():
    with pytest.raises(ValueError):
        P.factor_runs(np.zeros(9, np.int64), 6, 2)


def planted_rows(prose):
    rng = random.Random(5)
    rows = [(i, prose(rng.randrange(0, 90), i), "x") for i in range(120)]
    rows += [(900 + i, " ".join(rng.choice("ab") for _ in range(60)), "x") for i in range(40)]
    rows += [(None, "a b a b a b a b a b", "x"), (None, None, "y"), (7, "", "x"), (7, "", "x"), (8, " \t\n ", "x")]
    rows += [(5000, "é é é é é é é é x\x1cy", "x"), (5001, "do. " * 4000 + "end", "x"), (5002, "z" * 300_000, "x")]
    return rows


def test_query_matches_brute_force(spark, prose, tmp_path):
    rows = planted_rows(prose)
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    found = P.op11_periodic_runs(spark, str(tmp_path))
    assert [f.dataType.simpleString() for f in found.select(*columns).schema] == ["bigint"] * 6 + ["string"] * 2
    got = sorted((tuple(r) for r in found.select(*columns).collect()), key=repr)
    assert got == sorted((brute(i, t) for i, t, _ in rows), key=repr)
    assert sum(r[1] > 0 for r in got) > 30


def test_test_table_matches_brute_force(spark, sf):
    got = P.op11_periodic_runs(spark, sf).drop("n_words").collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    short = [r for r in got if len((texts[r["doc_id"]] or "").split()) < 400]
    assert len(got) == len(texts) and len(short) > 100
    assert [tuple(r) for r in short] == [brute(r["doc_id"], texts[r["doc_id"]]) for r in short]


def test_own_columns_and_empty_table(docs):
    table = docs([(1, "go go go go go go stop", 5)], "doc_id long, body string, n_runs int")
    row = P.collapse_runs(table, text_col="body").first()
    assert (row["n_words"], row["n_runs"], row["collapsed"]) == (7, 1, "go stop")
    assert [tuple(r) for r in row["runs"]] == [(0, 6, 1)]
    assert P.collapse_runs(docs([])).collect() == []
