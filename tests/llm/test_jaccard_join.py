import numpy as np
import pytest
from starloom.llm import common as c
from starloom.llm import jaccard_join as J


def shingles(text):
    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    words = raw.split()
    return set(zip(words, words[1:], words[2:])) if len(words) >= 3 else ({tuple(words)} if words else set())


def brute(rows):
    sets = [(i, k, shingles(t)) for k, (i, t, *_) in enumerate(rows)]
    root = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            s, t = sets[a][2], sets[b][2]
            if s and t and 100 * len(s & t) >= 90 * len(s | t):
                x, y = root[a], root[b]
                root = [x if r == y else r for r in root]
    ids = {}
    for k, (i, *_) in enumerate(rows):
        ids.setdefault(root[k], []).append((i is None, i))
    return sorted(((i, len(sets[k][2]), min(ids[root[k]])[1]) for k, (i, *_) in enumerate(rows)), key=repr)


def near_copies(prose, rng, n, words):
    base = prose(words, 1).split()
    out = []
    for _ in range(n):
        copy = list(base)
        for at in rng.sample(range(words), rng.randint(0, max(1, words // 30))):
            copy[at] = f"edit{rng.randint(0, 9)}"
        out.append(" ".join(copy))
    return out


def test_classes_match_brute_force(docs, prose):
    import random

    rng = random.Random(4)
    texts = [prose(n, n) for n in (3, 4, 10, 11, 25, 80, 400)] + near_copies(prose, rng, 25, 150) + near_copies(prose, rng, 12, 21)
    texts += [texts[3], texts[5].upper(), texts[5] + " tail", None, "", " \t\n", "one", "one", "ONE two", "one two", "É é", "é É"]
    rows = [(i * 7 % 101, t) for i, t in enumerate(texts)]
    found = J.jaccard_classes(docs(rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, found), key=repr) == brute(rows)


def test_small_blocks_give_the_same_classes(docs, prose, monkeypatch):
    import random

    monkeypatch.setattr(J, "BLOCK", 4)
    rows = list(enumerate(near_copies(prose, random.Random(9), 40, 60)))
    found = J.jaccard_classes(docs(rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, found), key=repr) == brute(rows)


def test_null_and_repeated_ids_and_clashing_columns(docs, prose):
    rows = [(None, prose(60, 1), 1, "a"), (5, prose(60, 1), 2, "b"), (5, prose(60, 1), 3, None), (None, prose(9, 2), 4, "d")]
    found = J.jaccard_classes(docs(rows, "doc_id long, text string, n long, sid string"))
    assert sorted(map(tuple, found.select("doc_id", "n_shingles", "component_id").collect()), key=repr) == brute(rows)
    assert {r["_row"] for r in found.collect() if r["_row"] == r["class_row"]} == {r["class_row"] for r in found.collect()}


def test_empty_table(docs):
    assert J.jaccard_classes(docs([])).collect() == []


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(3)
    for size in (9, 10, 15, 19, 40, 95, 300, 1000):
        for _ in range(30):
            base = rng.integers(1, 1 << 63, size, dtype=np.uint64)
            drop = rng.integers(0, size // 19 + 1)
            other = np.concatenate((base[drop:], rng.integers(1, 1 << 63, rng.integers(0, size // 19 + 1), dtype=np.uint64)))
            common = size - drop
            if 10 * common < 9 * (size + len(other) - common):
                continue
            both = []
            for s in (base, other):
                n = np.array([len(s)])
                sid = c.mix(np.array([c.mix(s).sum()], np.uint64))
                band = np.searchsorted(J.LOWS, n, "right") - 1
                doc = np.zeros(len(s), np.int64)
                own = J._signatures(doc, s, band, n > 0, sid)[1]
                up = J._signatures(doc, s, band + 1, n * 10 // 9 >= J.LOWS[band + 1], sid)[1]
                both.append(set(own.tolist()) | set(up.tolist()))
            assert both[0] & both[1]


@pytest.mark.parametrize("text", ["", "a", "a b", "a b c", "x " * 5000])
def test_sets_of_one_text(text):
    data, offsets = c._joined([text.encode()])
    doc, hashed = J.shingle_sets(data, offsets, c.Powers())
    assert len(hashed) == len(shingles(text)) and (doc == 0).all()


def test_five_words_at_four_fifths_match_brute_force(docs, prose):
    import random

    rng, rows = random.Random(5), []
    for n in (12, 40, 150):
        base = prose(n, n).split()
        for _ in range(14):
            copy = list(base)
            for at in rng.sample(range(n), rng.randint(0, max(1, n // 30))):
                copy[at] = f"edit{rng.randint(0, 9)}"
            rows.append((len(rows), " ".join(copy)))
    rows += [(100 + k, t) for k, t in enumerate(("one two three four", "ONE two three four", "one two three", "", None))]
    words = [(t or "").lower().encode().split() for _, t in rows]
    sets = [set(zip(*(w[k:] for k in range(5)), strict=False)) if len(w) >= 5 else {tuple(w)} if w else set() for w in words]
    root = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                root = [min(root[a], root[b]) if r in (root[a], root[b]) else r for r in root]
    want = [(i, len(sets[k]), rows[root[k]][0]) for k, (i, _) in enumerate(rows)]
    found = J.jaccard_classes(docs(rows), rule=J.Rule(5, 4, 5)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, found)) == want


def test_fine_sketches_never_count_more_than_the_difference():
    rng = np.random.default_rng(4)
    common = rng.integers(0, 1 << 63, 900).astype(np.uint64)
    sets = [np.concatenate((common, rng.integers(0, 1 << 63, k).astype(np.uint64))) for k in (10, 90, 300)] + [common[:100]]
    n = np.array([len(s) for s in sets])
    fine = J.fine_sketches(np.repeat(np.arange(len(sets)), n), np.concatenate(sets), n)
    assert [f and len(f) * 8 for f in fine] == [1024, 1024, 2048, None]
    for a, b in ((0, 1), (0, 2), (1, 2)):
        x, y = (np.frombuffer(fine[i], np.uint8).reshape(-1, 128) for i in (a, b))
        apart = np.bitwise_count(np.bitwise_xor.reduce(x, axis=0) ^ np.bitwise_xor.reduce(y, axis=0)).sum()
        assert 0 < apart <= len(np.setxor1d(sets[a], sets[b]))


def test_large_sets_link_by_their_fine_sketches(docs, prose):
    words = prose(1500, 21).split()
    edited = " ".join("other" if i % 200 == 7 else w for i, w in enumerate(words))
    far = " ".join(words[:800] + prose(700, 22).split())
    found = {r["doc_id"]: r["component_id"] for r in J.jaccard_classes(docs([(1, " ".join(words)), (2, edited), (3, far)])).collect()}
    assert found == {1: 1, 2: 1, 3: 3}


def _members(rows, at=None):
    rows = sorted(rows)
    sig, sid = (np.array([r[i] for r in rows], np.int64) for i in (0, 1))
    parts = [(sig[i: i + (at or len(sig))], sid[i: i + (at or len(sig))]) for i in range(0, len(sig), at or len(sig))]
    batches = [J.pa.record_batch([J.pa.array(x), J.pa.array(y)], names=["sig", "sid"]) for x, y in parts]
    return [tuple(r.values()) for b in J._shared(iter(batches)) for r in b.to_pylist()]


@pytest.mark.parametrize("at", [None, 1, 2, 3])
def test_signatures_meet_only_where_the_third_sub_parts_are_near(at):
    near, far, other = 5 << J.THIRD, (5 << J.THIRD) + 0b111, -3 << J.THIRD
    rows = [(near, 40), (near, 40), (near + 1, 10), (near + 3, 30), (far + 0b11000, 20), (other, 7), (other + 0b11, 8), (9 << J.THIRD, 1)]
    # one bit apart: 40 with 10, 10 with 30; the others differ in two bits or more, or are alone
    assert _members(rows, at) == [(near, 40, 10), (near + 1, 10, 10), (near + 3, 30, 10)]


def test_sets_of_a_bucket_with_many_sketches_or_rows_all_stay(monkeypatch):
    monkeypatch.setattr(J, "SPREAD", 3)
    many = [(4 << J.THIRD | k * 0b111, k) for k in range(30)]
    assert {r[1] for r in _members(many)} == set(range(30))
    monkeypatch.setattr(J, "HOLD", 4)
    assert {r[1] for r in _members(many + [(5 << J.THIRD, 99)], 3)} == set(range(30))


def test_linked_sets_are_near_by_a_shared_signature():
    rng = np.random.default_rng(6)
    rule, linked = J.Rule(5, 4, 5), 0
    for size in (9, 10, 40, 95, 300, 1000):
        for _ in range(20):
            drop, more = rng.integers(0, size // 9 + 1, 2)
            base = rng.integers(1, 1 << 63, size, dtype=np.uint64)
            other = np.concatenate((base[drop:], rng.integers(1, 1 << 63, more, dtype=np.uint64)))
            if 5 * (size - drop) < 4 * (size + more):
                continue
            linked += 1
            both = []
            for s in (base, other):
                n, sid = np.array([len(s)]), np.array([c.mix(s).sum()], np.uint64)
                band = np.searchsorted(rule.lows, n, "right") - 1
                doc = np.zeros(len(s), np.int64)
                found = [J._signatures(doc, s, at, n > 0, sid, rule) for at in (band, band + 1)]
                both.append({(int(x), int(y)) for _, sig, third in found for x, y in zip(sig, third, strict=True)})
            assert any(x == u and (y ^ v).bit_count() <= 1 for x, y in both[0] for u, v in both[1] if x == u)
    assert linked > 50


def _near_signatures(sets, rule):
    """Signatures of each set of hashes, under both of its bands, and their sketches."""
    n = np.array([len(s) for s in sets])
    doc, hashed, sid = np.repeat(np.arange(len(sets)), n), np.concatenate(sets), np.arange(len(sets)).astype(np.uint64)
    band = np.searchsorted(rule.lows, n, "right") - 1
    found = [{} for _ in sets]
    for at, use in ((band, n > 0), (band + 1, n * rule.den // rule.num >= rule.lows[band + 1])):
        for o, s, t in zip(*(x.tolist() for x in J._signatures(doc, hashed, at, use, sid, rule)), strict=True):
            found[o][s & ~int(J.LOW)] = t
    return found


def _meet(a, b):
    return any((a[s] ^ b[s]).bit_count() <= 1 for s in a.keys() & b.keys())


def test_large_sets_without_common_shingles_hardly_meet():
    rng = np.random.default_rng(12)
    found = _near_signatures([rng.integers(1, 1 << 63, size, dtype=np.uint64) for size in rng.integers(1500, 1800, 80)], J.Rule(5, 4, 5))
    met = sum(_meet(found[a], found[b]) for a in range(80) for b in range(a))
    assert met <= 6  # 42 without spare parts


@pytest.mark.parametrize("size", [30, 300, 1600])
def test_sets_that_only_agree_in_few_parts_still_meet(size):
    """The differences, as many as a link allows, go two by two into parts where they hurt most."""
    rng, rule = np.random.default_rng(size), J.Rule(5, 4, 5)
    base = rng.integers(1, 1 << 63, size, dtype=np.uint64)
    band = np.searchsorted(rule.lows, size, "right") - 1
    k = 2 * (rule.lows[band] * 5 // 4) // 9
    parts = k // 2 + 1 + int(rule.spare(np.array([rule.lows[band] * 5 // 4]), np.array([k // 2 + 1]))[0])
    cell = (c.mix(base + np.uint64(7)) % np.uint64(parts * 3)).astype(np.int64)
    full = np.bincount(cell, minlength=parts * 3).reshape(-1, 3) > 0
    for order in (np.argsort(-full.sum(axis=1), kind="stable"), np.arange(parts), np.arange(parts)[::-1]):
        gone = []
        for part in order:
            mine = np.flatnonzero(cell // 3 == part)
            _, first = np.unique(cell[mine], return_index=True)  # from two sub-parts where there are two
            if len(first) > 1 and 5 * (size - len(gone) - 2) >= 4 * size:
                gone += mine[first[:2]].tolist()
        other = np.delete(base, gone)
        assert 5 * len(other) >= 4 * size and len(gone) >= size // 5 - 2
        assert _meet(*_near_signatures([base, other], rule))
