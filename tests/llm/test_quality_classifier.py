import random
import zlib

import numpy as np
import pytest
from starloom.llm import common as c
from starloom.llm import quality_classifier as Q

WORD_SPACES = " \t\n\x0b\x0c\r"


def stats(*texts):
    """The statistics of texts that lie in one chunk."""
    data, offsets = c._joined([t.encode() for t in texts])
    return dict(zip(Q.STATISTICS, Q.statistics(data, offsets, c.Powers()).T / Q.UNIT, strict=True))


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.fixture(scope="module")
def tables(spark):
    """Prose labelled 1 and shouted symbols labelled 0, every third row without a label."""
    rng = random.Random(7)
    words = ["river", "stone", "window", "quiet", "garden", "letter", "morning", "harbour", "is", "the", "of", "a"]
    rows, labels = [], []
    for i in range(600):
        n = rng.randint(5, 60)
        good = i % 2 == 0
        text = " ".join(rng.choice(words) if good else rng.choice(("$$$", "BUY", "NOW!!", "100%", "www##")) for _ in range(n))
        rows.append((i, text, 9.0))
        if i % 3:
            labels.append((i, int(good)))
    return spark.createDataFrame(rows, "doc_id long, text string, score double"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_statistics_of_a_text():
    found = stats("", "Ab cd. cd.\nEF 12 #\n\nAb cd. cd.", "été été")
    assert all(v[0] == 0 for v in found.values())
    near = lambda name, i, want: abs(found[name][i] - want) < 1e-3
    assert near("words", 1, np.log1p(9)) and near("words", 2, np.log1p(2))
    assert near("word_length", 1, np.log1p(21 / 9)) and near("word_length", 2, np.log1p(3))
    assert near("digits", 1, np.sqrt(2 / 21)) and near("upper", 1, np.sqrt(4 / 21))
    assert near("lines", 1, np.sqrt(3 / 9)) and near("same_lines", 1, np.sqrt(1 / 3))
    assert near("distinct", 1, np.sqrt(5 / 9)) and near("adjacent", 1, np.sqrt(2 / 9)) and near("adjacent", 2, np.sqrt(1 / 2))
    assert near("windows", 1, np.sqrt(1 / 9)) and near("letterless", 1, np.sqrt(2 / 9)) and near("capitals", 1, np.sqrt(1 / 9))


def test_statistics_do_not_depend_on_neighbours():
    texts = ["one two\none two", "x", "", "  ", "one two\none two", "Q " * 500]
    together = Q.statistics(*c._joined([t.encode() for t in texts]), c.Powers())
    for i, t in enumerate(texts):
        assert (Q.statistics(*c._joined([t.encode()]), c.Powers())[0] == together[i]).all()


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(20, 6))
    z = Q.Fourier.over(np.zeros(6), np.ones(6), features=20000, seed=3).of(x)[:, :-1] / Q.STEP
    want = np.exp(-((x[:, None] - x[None]) ** 2).sum(2) / (2 * 6))
    assert np.abs(2 * z @ z.T / 20000 - want).max() < 0.05


def test_ridge_is_least_squares():
    rng = np.random.default_rng(2)
    z = np.concatenate((np.rint(rng.uniform(-1, 1, (80, 5)) * Q.STEP), np.full((80, 1), float(Q.STEP))), axis=1)
    y = rng.integers(0, 2, 80)
    both = np.concatenate((z, y[:, None]), axis=1)
    weights = Q.solve(both.T @ both, 0.5)
    penalty = np.sqrt([0.5] * 5 + [1e-6])
    want = np.linalg.lstsq(np.concatenate((z / Q.STEP, np.diag(penalty))), np.concatenate((y, np.zeros(6))), rcond=None)[0]
    assert np.allclose(weights, want)


def test_isotonic_is_the_best_rising_fit():
    """Against the min-max formula of isotonic regression."""
    rng = random.Random(4)
    for _ in range(50):
        n = np.array([rng.randint(0, 4) for _ in range(12)])
        good = np.array([rng.randint(0, k) for k in n])
        places, shares = Q.isotonic(n, good)
        assert (np.diff(shares) > 0).all() and (np.diff(places) > 0).all()
        at = np.flatnonzero(n)
        if not len(at):
            continue
        mean = lambda i, j: good[i : j + 1].sum() / n[i : j + 1].sum()
        want = [max(min(mean(i, j) for j in at if j >= k) for i in at if i <= k) for k in at]
        assert np.allclose(sorted(set(np.round(want, 12))), shares)


def test_held_out_accuracy_and_columns(tables):
    docs, labels = tables
    found = Q.score_quality(docs, labels)
    assert found.columns == ["doc_id", "text", "held_out", "score", "predicted"]
    rows = found.collect()
    assert len(rows) == 600 and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == held(r["doc_id"]) and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    unseen = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == (r["doc_id"] % 2 == 0) for r in unseen) >= 0.98 * len(unseen)


def test_splits_do_not_change_scores(tables):
    docs, labels = tables
    take = lambda d, n: {r["doc_id"]: r["score"] for r in Q.score_quality(d, n, ["doc_id"]).collect()}
    one, other = take(docs.coalesce(1), labels), take(docs.repartition(9), labels.repartition(5))
    assert one.keys() == other.keys() and max(abs(one[k] - other[k]) for k in one) < 1e-6


def test_held_out_labels_teach_nothing(spark, tables):
    docs, labels = tables
    turned = labels.collect()
    turned = spark.createDataFrame([(i, 1 - q if held(i) else q) for i, q in turned], "doc_id long, quality int")
    take = lambda n: {r["doc_id"]: r["score"] for r in Q.score_quality(docs, n, ["doc_id"]).collect()}
    one, other = take(labels), take(turned)
    assert max(abs(one[k] - other[k]) for k in one) < 1e-6


def test_nulls_empty_long_and_repeated_rows(spark, tables):
    docs, labels = tables
    odd = spark.createDataFrame([(None, "river stone", 1), (9000, None, 2), (9001, "", 3), (9002, "river " * 300_000, 4), (9003, "a b", 5), (9003, "a b", 5)], "doc_id long, text string, predicted int")
    extra = labels.union(spark.createDataFrame([(None, 1), (9001, None), (1, 0), (1, 0)], "doc_id long, quality int"))
    both = docs.select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    rows = [r for r in Q.score_quality(both, extra).collect() if r["doc_id"] is None or r["doc_id"] >= 9000]
    assert len(rows) == 6 and all(0 <= r["score"] <= 1 for r in rows)
    assert [r["held_out"] for r in rows if r["doc_id"] is None] == [True]
    assert len({r["score"] for r in rows if r["doc_id"] in (9000, 9001)}) == 1
    assert len({r["score"] for r in rows if r["doc_id"] == 9003}) == 1


def test_empty_tables(spark, tables):
    docs, labels = tables
    assert Q.score_quality(docs.limit(0), labels).collect() == []
    assert {(r["score"], r["predicted"]) for r in Q.score_quality(docs, labels.limit(0)).collect()} == {(0.5, 1)}
    same = Q.score_quality(docs, labels.withColumn("quality", labels.quality * 0), ["doc_id"]).collect()
    assert max(r["score"] for r in same) < 0.3
