import numpy as np
import pytest
from starloom.llm import common as c
from starloom.llm import quality as Q


def base(text):
    raw = (text or "").encode()
    words = raw.split()
    windows = [tuple(words[i: i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return (len(words), sum(len(w.decode()) for w in words), sum((text or "").count(s) for s in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


TEXTS = [None, "", " \t\n\x0b\x0c\r", "one", "a b c a b c", "a a a a", "x | y\nx | y\n\n\n\nx | y", " nbsp is  no space", "é" * 5 + " #*$%&|<>", "abc", "abcd",
         "l1\nl2\nl1\n \nl2\n", "w " * 400]


def test_counts_and_sums_match_brute_force():
    texts = [(t or "").encode() for t in TEXTS]
    data, offsets = c._joined(texts)
    ratios = np.arange(1 << Q.BUCKET_BITS, dtype=np.int64) - 30_000
    found = list(zip(*(f.tolist() for f in Q.features(data, offsets, ratios, c.Powers())), strict=True))
    for text, got in zip(TEXTS, found, strict=True):
        raw = (text or "").encode()
        grams = [(int.from_bytes(raw[i: i + 4], "big") * Q.MULTIPLIER % (1 << 32)) >> (32 - Q.BUCKET_BITS) for i in range(len(raw) - 3)]
        assert got == (*base(text), len(grams), sum(g - 30_000 for g in grams)), text


@pytest.fixture
def corpus(prose):
    good = [(i, prose(120, i)) for i in range(60)]
    junk = [(100 + i, " | ".join(w.upper() + "!!" for w in prose(80, i).split())) for i in range(25)]
    return good + junk + [(200, "short text"), (201, "same old words " * 60), (202, None), (None, prose(120, 3))]


def test_junk_goes_and_clean_text_stays(spark, docs, corpus):
    labels = spark.createDataFrame([(i, int(i < 100), 0) for i in range(0, 125, 2)] + [(None, 1, 0), (2, 1, 1)], "doc_id long, quality int, toxic int")
    table = docs([(i, t, "x") for i, t in corpus], "doc_id long, text string, n_words string")
    found = Q.judge_quality(table, Q.trusted_ids(labels))
    kept = {r["doc_id"]: r["kept"] for r in found.collect()}
    assert all(kept[i] for i in range(60)) and kept[None]
    assert not any(kept[i] for i in list(range(100, 125)) + [200, 201, 202])
    failed = {r["doc_id"] for r in found.collect() if r["base_failed"]}
    assert failed == {200, 201, 202}


def test_empty_tables_and_no_labels(spark, docs, corpus):
    none = Q.trusted_ids(spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert Q.judge_quality(docs([]), none).collect() == []
    found = Q.judge_quality(docs(corpus), none).collect()
    assert len(found) == len(corpus) and not any(r["kept"] and r["base_failed"] for r in found)


def test_the_trusted_sample_is_bounded(spark):
    labels = spark.range(500).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    ids = [r["doc_id"] for r in Q.trusted_ids(labels, 20).collect()]
    assert len(ids) == 20 and ids == [r["doc_id"] for r in Q.trusted_ids(labels.repartition(7), 20).collect()]
