import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from starloom.llm import lexical_search as L

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(docs, queries, k=10):
    """All scores of all queries, from the formula."""
    own = [(i, Counter(terms(t))) for i, t in docs]
    own = [(i, c, sum(c.values())) for i, c in own if c]
    total = sum(n for _, _, n in own)
    df = Counter(t for _, c, _ in own for t in c)
    rows = []
    for item, text in queries:
        scored = []
        for i, counts, n in own:
            m = 25 + 75 * n * len(own) // total
            score = 0
            for t in terms(text):
                if t in counts:
                    w = math.floor(1000 * math.log((2 * len(own) + 2) / (2 * df[t] + 1)))
                    score += w * (10**9 * counts[t] // (1000 * counts[t] + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        rows += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored, key=lambda s: s[:3])[:k])]
    return sorted(rows, key=repr)


def found(spark, docs, queries, **options):
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, score string")
    q = spark.createDataFrame([(i, t, 1) for i, t in queries], "item_id long, text string, rank int")
    return sorted((tuple(r) for r in L.search(d.repartition(3), q, **options).collect()), key=repr)


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["Ärger", "x1", "naïve", "日本"]
    skewed = [vocabulary[min(int(rng.expovariate(0.12)), 63)] for _ in range(n * 15)]
    return [(i, ", ".join(skewed[i * 15: i * 15 + rng.randrange(0, 15)])) for i in range(n)]


def test_terms():
    assert L.terms_of("Ab-C3_é日x\x7fy ÄÖ@z".encode()) == [t.encode() for t in ("ab", "c3", "é日x", "y", "ÄÖ", "z")]
    assert [t.encode() for t in terms("Ab-C3_é日x\x7fy ÄÖ@z")] == L.terms_of("Ab-C3_é日x\x7fy ÄÖ@z".encode())


def test_same_as_scoring_everything(spark):
    docs = corpus(1, 300)
    docs += [(i, docs[7][1]) for i in range(400, 430)]  # ties beyond the tenth place
    docs += [(None, docs[7][1]), (5, docs[9][1]), (5, docs[9][1]), (600, None), (601, ""), (602, "-- .."), (603, "w1 " * 50_000)]
    queries = [(q, docs[q * 11][1] + " unknown w0 W0") for q in range(25)] + [(3, "w2 w3 w2"), (None, "ärger Ärger"), (90, None), (91, ""), (92, "nowhere"), (93, "w0")]
    expected = brute(docs, queries)
    assert found(spark, docs, queries) == expected
    assert found(spark, docs, queries, block_queries=4) == expected
    assert found(spark, docs, queries, block_terms=20) == expected
    assert found(spark, docs, queries, k=3) == brute(docs, queries, 3)


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 12), st.integers(0, 3000))
def test_limit_loses_nothing(seed, k, floor):
    """The k best with a score of the floor or more are there with exact scores, and with few accumulators."""
    rng = np.random.default_rng(seed)
    docs, vocabulary = 80, 12
    pairs = np.unique(rng.integers(0, docs * vocabulary, 200))
    term, doc = pairs % vocabulary, pairs // vocabulary
    order = np.argsort(doc, kind="stable")
    term, doc, impact = term[order], doc[order], rng.integers(1, 100, len(pairs))
    wanted = rng.permutation(vocabulary)[:7]
    weights = rng.integers(1, 30, len(wanted))
    full = np.zeros(docs, np.int64)
    for t, w in zip(wanted, weights, strict=True):
        full[doc[term == t]] += w * impact[term == t]
    got, score, made = L.Lists(term, doc, impact, docs, vocabulary).best(wanted, weights, k, floor)
    assert (full[got] == score).all() and made <= np.count_nonzero(full)
    best = np.sort(full[full >= max(floor, 1)])[::-1][:k]
    assert sorted(score[score >= max(floor, 1)], reverse=True)[: len(best)] == best.tolist()
    ties = np.flatnonzero(full >= best[-1]) if len(best) == k else np.flatnonzero(full >= max(floor, 1))
    assert set(ties) <= set(got)


def test_common_terms_make_no_accumulators():
    doc = np.concatenate((np.arange(20), np.arange(1000)))
    term = np.concatenate((np.zeros(20, np.int64), np.ones(1000, np.int64)))
    lists = L.Lists(term, doc, np.full(1020, 100), 1000, 2)
    docs, score, made = lists.best(np.array([0, 1]), np.array([50, 1]), 10, 1)
    assert made == 20 and docs.tolist() == list(range(20)) and (score == 5100).all()
    assert lists.best(np.array([0, 1]), np.array([50, 1]), 10, 5101)[2] == 0


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a b")]) == []
    assert found(spark, [(1, "a b")], []) == []
    assert found(spark, [(1, None)], [(1, "a b")]) == []


@pytest.mark.parametrize("types", ["string", "int"])
def test_ids_of_other_types(spark, types):
    docs = spark.createDataFrame([("2", "a b"), ("10", "a b"), (None, "a b"), ("3", "c")], "key string, body string").selectExpr(f"cast(key as {types}) key", "body")
    queries = spark.createDataFrame([(1, "a")], "q int, text string")
    rows = L.search(docs, queries, id_col="key", text_col="body", query_col="q").orderBy("rank").collect()
    assert [r["key"] for r in rows] == (["10", "2", None] if types == "string" else [2, 10, None])


def test_query_matches_its_sql(spark, sf):
    connection = duckdb.connect()
    for name in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    got = sorted(tuple(r) for r in L.op12_lexical_search(spark, sf).select("item_id", "rank", "doc_id", "score").collect())
    assert got and got == sorted(connection.execute(L.OP12_SQL).fetchall())
