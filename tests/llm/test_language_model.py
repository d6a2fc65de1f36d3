import math
import zlib
from collections import Counter

import numpy as np
import pytest
from starloom.llm import common as c
from starloom.llm import language_model as L


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0


def corpus(prose):
    rows = [(i, prose(40 + i % 30, i % 150)) for i in range(240)]
    return rows + [(300, None), (301, ""), (302, "Unseen wörd HERE"), (303, "x y " * 700), (None, prose(30, 1)), (5, prose(30, 2))]


@pytest.mark.parametrize("known", [1 << 17, 40])
def test_base_scores_match_brute_force(docs, prose, monkeypatch, known):
    monkeypatch.setattr(L, "KNOWN", known)
    rows = corpus(prose)
    found = L.score_texts(docs([(i, t, "x") for i, t in rows], "doc_id long, text string, token string")).collect()
    count = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(count.values()), len(count)
    expected = sorted(
        (repr(i), held(i), len(tokens(t)), sum(count[w] > 0 for w in tokens(t)), n,
         round(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t)), 6)) for i, t in rows)
    got = sorted((repr(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found)
    assert got == expected


def test_the_model_beats_the_unigrams_on_held_out_texts(docs):
    rng = np.random.default_rng(0)
    words = [f"{x}{y}" for x in ("kal", "ber", "tun", "mos") for y in ("ig", "en", "ot", "us", "ar")]
    follow = {w: rng.choice(words, 3).tolist() for w in words}

    def text(k):
        own = np.random.default_rng(k)
        out = [str(own.choice(words))]
        while len(out) < 60:
            out.append(str(own.choice(follow[out[-1]])))
        return " ".join(out)

    found = L.score_texts(docs([(i, text(i)) for i in range(900)])).collect()
    out = [r for r in found if r["held_out"]]
    gain = sum(r["score"] - r["base_score"] for r in out) / sum(r["n_tokens"] for r in out)
    assert len(out) > 50 and gain > 0.2


def test_probabilities_sum_to_one(spark, docs, prose):
    """Over the classes for any history, and inside a class over its words and one unseen word."""
    rows = [(i, prose(50, i)) for i in range(40)]
    words = L.count_words(docs(rows).select("text"))
    vocabulary = L.vocabulary_of(words, 40)
    table = {bytes(r["token"]): r["n"] for r in words.collect()}
    data, offsets = c._joined([w for w in table])
    t = L.tokens_of(data, offsets, vocabulary, c.Powers())
    kinds = dict(zip(table, t.classes[t.word_at].tolist(), strict=True))
    mass = np.zeros(L.CLASSES)
    for w, n in table.items():
        mass[kinds[w]] += n + L.SMOOTH
    mass[0] += 40 + L.SMOOTH
    mass[L.SUFFIX_FIRST:] += L.SMOOTH
    assert np.allclose(mass[mass > 0], vocabulary.mass[mass > 0])
    weights = np.random.default_rng(1).normal(size=(L.ROWS, L.CLASSES)).astype(np.float32)
    logits = L.class_logits(weights, vocabulary.bias, t.features()[:, :50])
    p = np.exp(logits) / np.exp(logits).sum(axis=1, keepdims=True)
    assert np.allclose(p.sum(axis=1), 1, atol=1e-5)


def test_nothing_to_train_on(docs):
    ids = [i for i in range(200) if held(i)][:3]
    found = L.score_texts(docs([(i, "some words") for i in ids])).collect()
    assert all(r["held_out"] and r["n_known"] == 0 and r["train_tokens"] == 0 and math.isfinite(r["score"]) for r in found)
    assert L.score_texts(docs([])).collect() == []


def test_gradient_steps_lower_the_loss():
    rng = np.random.default_rng(2)
    rows = np.stack([rng.integers(0, 50, 4000) + at for at in L.FIRST_ROW[:4]])
    classes = (rows[0] * 7 + rows[2]) % L.CLASSES
    trainer = L.Trainer(np.zeros((L.ROWS, L.CLASSES), np.float32), np.zeros(L.CLASSES, np.float32))

    def loss():
        x = L.class_logits(trainer.weights, trainer.bias, rows)
        return -(x[np.arange(len(classes)), classes] - np.log(np.exp(x).sum(axis=1))).mean()

    before = loss()
    for _ in range(25):
        trainer.step(rows, classes)
    assert loss() < 0.8 * before


def test_every_round_takes_every_text(docs, prose, monkeypatch):
    table = docs([(i, prose(60, i), 0) for i in range(4)], "doc_id long, text string, share int")
    vocabulary = L.vocabulary_of(L.count_words(table.select("text")), 4)
    change = []
    for rounds in (1, 3):
        monkeypatch.setattr(L, "ROUNDS", rounds)
        change.append(float(np.abs(L.train(table, vocabulary)).sum()))
    assert change[1] > 1.2 * change[0] > 0 and L.CLASSES >= 64
