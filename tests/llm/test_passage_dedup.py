import random

import numpy as np
import pyarrow as pa
import pytest
from starloom.llm import common as c
from starloom.llm import passage_dedup as P
from starloom.session import materialise


def stored_in_order(docs, rows, schema="doc_id long, text string"):
    return materialise(docs(rows, schema).coalesce(1).sortWithinPartitions("doc_id"), "one")


def test_passages_inside_lines_are_found(docs, prose):
    passage = prose(60, 500)
    edited = passage.split()
    edited[4] = "changed"
    rows = [(i, prose(45, i)) for i in range(40)]
    rows += [(100, prose(27, 60) + " " + passage + " " + prose(27, 61)), (101, "Intro words here are few.\n" + passage + "\n" + prose(30, 62)),
             (102, prose(36, 63) + " " + " ".join(edited)), (200, prose(200, 70)), (201, prose(200, 70)), (300, None), (301, ""), (302, "word " * 5000)]
    found = {r["doc_id"]: r for r in P.remove_passages(stored_in_order(docs, rows)).collect()}
    assert len(found) == len(rows)
    for i, text in rows:
        if i < 40 or i >= 300:
            assert (found[i]["text"], found[i]["n_duplicated"], found[i]["n_removed"]) == (text, 0, 0)
    assert found[100]["n_removed"] == 0 and found[100]["n_duplicated"] >= 54 and found[100]["text"] == rows[40][1]
    assert found[101]["n_removed"] >= 54 and found[101]["text"].split()[:5] == "Intro words here are few.".split()
    assert found[102]["n_removed"] >= 40 and found[102]["text"].startswith(prose(36, 63))
    assert found[201]["n_removed"] >= 195 and found[200]["n_removed"] == 0
    for r in found.values():
        whole = (dict(rows)[r["doc_id"]] or "").encode()
        kept, at = b"", 0
        for s in r["spans"]:
            kept, at = kept + whole[at: s["start"]], s["end"]
        assert (kept + whole[at:]).decode() == (r["text"] or "")


def test_short_common_lines_stay(docs, prose):
    rows = [(i, "All rights reserved by the owner here.\n" + prose(40, i)) for i in range(30)]
    found = P.remove_passages(docs(rows)).collect()
    assert all(r["n_removed"] == r["n_duplicated"] == 0 for r in found)


def test_similar_pairs_have_high_recall():
    rng = random.Random(3)
    met = total = 0
    for k in range(200):
        words = [f"w{rng.randint(0, 5000)}" for _ in range(50)]
        other = list(words)
        other[rng.choice((0, 49))] = "edit"
        other[rng.choice((1, 48))] = "edit2"
        data, offsets = c._joined([" ".join(words).encode() + b".", " ".join(other).encode() + b"."])
        p = P.Paragraphs(data, offsets, c.Powers())
        owner, hashed = p.shingles()
        a, b = set(hashed[owner == 0].tolist()), set(hashed[owner == 1].tolist())
        if len(a & b) >= 0.8 * len(a | b):
            total += 1
            bands = p.bands()
            met += bool((bands[0] == bands[1]).any())
    assert total > 50 and met >= 0.95 * total


def test_bands_sorted_over_many_batches():
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(0)
    band = np.sort(rng.integers(0, 40, 400))
    h = rng.integers(0, 200, 400)
    order = np.lexsort((h, band))
    rows = list(zip(band[order].tolist(), h[order].tolist(), strict=True))
    expected = set()
    for b in set(band.tolist()):
        own = sorted({y for x, y in rows if x == b})
        expected |= {(own[0], y) for y in own[1:]} | set(zip(own, own[1:], strict=False))
    for size in (1, 3, 400):
        batches = [pa.record_batch([pa.array([r[k] for r in rows[i: i + size]]) for k in (0, 1)], names=["band", "h"]) for i in range(0, 400, size)]
        got = {p for out in P._meeting(iter(batches)) for p in zip(*(c.to_pylist() for c in out.columns), strict=True)}
        assert got == expected


def test_null_ids_repeated_rows_and_empty_table(docs, prose):
    rows = [(None, prose(80, 1), 1), (None, prose(80, 1), 2), (7, prose(80, 2), 3)]
    found = P.remove_passages(docs(rows, "doc_id long, text string, h int")).collect()
    assert sorted(r["n_removed"] > 0 for r in found) == [False, False, True]
    assert P.remove_passages(docs([])).collect() == []


def test_passages_that_are_no_sentences_are_found(docs, prose):
    plain = lambda n, seed: prose(n, seed, 10**6)
    lines = lambda text, n=4: "\n".join(" ".join(text.split()[i: i + n]) for i in range(0, len(text.split()), n))
    inside, marks, late = plain(30, 900), " ".join(w + "!" for w in plain(40, 901).split()), prose(70, 902, 35)
    exact, verse, both = lines(plain(120, 903)), lines(plain(32, 904)), plain(25, 905)
    tail = " ".join(late.split()[10:40])  # cut in the middle of two sentences
    rows = [(1, f"{plain(50, 1)} {inside} {plain(50, 2)}"), (2, f"{plain(20, 3)} {inside} {plain(70, 4)}"), (3, marks), (4, prose(40, 5) + "\n" + marks),
            (5, late), (6, f"{plain(15, 6)} {tail} {plain(15, 7)}"), (7, exact), (8, exact), (9, f"{plain(9, 8)}\n{verse}\n{plain(9, 9)}"),
            (10, f"{plain(60, 10)} {' '.join(verse.split())} {plain(60, 11)}"), (11, f"{plain(40, 12)} {both} {plain(40, 13)} {both}"),
            (12, f"{plain(24, 906)} {plain(30, 14)} {plain(24, 907)}"), (13, f"{plain(24, 906)} {plain(30, 15)} {plain(24, 907)}"), (14, "ho hum " * 100)]
    found = {r["doc_id"]: r for r in P.remove_passages(stored_in_order(docs, rows)).collect()}
    want = {2: 30, 4: 40, 6: 30, 8: 120, 10: 32, 11: 25, 14: 174}
    assert {i: r["n_removed"] for i, r in found.items()} == {i: want.get(i, 0) for i, _ in rows}
    assert {i: found[i]["n_duplicated"] for i in (1, 3, 5, 7, 9, 11, 12, 13)} == {1: 30, 3: 40, 5: 30, 7: 120, 9: 32, 11: 50, 12: 0, 13: 0}
    assert found[2]["text"] == f"{plain(20, 3)}  {plain(70, 4)}"


def test_every_run_of_equal_words_shares_a_print():
    rng = random.Random(8)
    for _ in range(200):
        run = [f"w{rng.randint(0, 5)}" for _ in range(P.MIN_RUN)]
        both = [" ".join([f"a{rng.randint(0, 9)}" for _ in range(rng.randint(0, 40))] + run + [f"b{rng.randint(0, 9)}" for _ in range(rng.randint(0, 40))]) for _ in range(2)]
        data, offsets = c._joined([x.encode() for x in both])
        doc, _, words = P._chunk_words(data, offsets, c.Powers())
        at, hashed = P.prints(doc, words, c.Powers())
        assert set(hashed[doc[at] == 0].tolist()) & set(hashed[doc[at] == 1].tolist())


@pytest.mark.parametrize("block", [1024, 2])
def test_similar_members_of_a_band_behind_a_dissimilar_leader(docs, prose, monkeypatch, block):
    """All paragraphs meet in one band; two that are similar are neither its first nor neighbours."""
    def one_band(batches):
        for batch in batches:
            for _, data, offsets in c.chunks(batch.column(0)):
                h = np.unique(P.Paragraphs(data, offsets, c.Powers()).hashed)
                yield pa.record_batch([pa.array(np.full(len(h), 7)), pa.array(c.signed(h))], names=["band", "h"])

    monkeypatch.setattr(P, "BLOCK", block)
    monkeypatch.setattr(P, "_band_rows", one_band)
    data, offsets = c._joined([(prose(40, i, 40)).encode() for i in range(12)])
    order = np.argsort(c.signed(P.Paragraphs(data, offsets, c.Powers()).hashed))
    base = prose(40, int(order[5]), 40).split()
    copies = [" ".join([f"new{k}", *base[1:]]) for k in range(8)]
    rows = [(i, prose(40, i, 40)) for i in range(12)] + [(100 + k, x) for k, x in enumerate(copies)]
    units, clusters = P.paragraph_clusters(docs(rows).selectExpr("doc_id as _row", "text"))
    found = {r["h"]: r["comp"] for r in clusters.collect()}
    alike = {r["h"] for r in units.collect() if r["_row"] >= 100 or r["_row"] == order[5]}
    assert found.keys() == alike and len(set(found.values())) == 1


def test_marked_words_match_word_by_word_marking():
    """Windows come as numbers, -1 - word where they stay; a text may have none, and none at all."""
    rng = random.Random(31)
    texts = [" ".join(f"w{k}" for k in range(n)) for n in (25, 60, 300, 40, 0)]
    windows = [[(w, rng.random() < 0.4) for w in range(len(t.split()) - P.MIN_RUN + 1) if rng.random() < 0.2 or len(t) < 100] for t in texts[:3]] + [None, None]
    units = [None, [(3, 40, 80, True), (1, 4, 20, False), (2, 24, 30, False)], None, [(0, 0, 110, False)], None]
    unit = pa.list_(pa.struct([("place", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("stays", pa.bool_())]))
    batch = pa.record_batch(
        [pa.array(range(5)), pa.array(texts), pa.array(units, unit), pa.array(range(5)),
         pa.array([w and [-1 - x if stays else x for x, stays in w] for w in windows], pa.list_(pa.int32()))], names=["_row", "text", "found", "_id", "runs"])
    for at in (0, 2):
        got = pa.Table.from_batches(P._cut(iter([batch.slice(at)]))).to_pylist()
        for r, text, found, runs in zip(got, texts[at:], units[at:], windows[at:], strict=True):
            words, both, gone = text.split(), set(), set()
            starts = np.cumsum([0] + [len(w) + 1 for w in words])[:-1]
            for w, stays in runs or []:
                both |= set(range(w, w + P.MIN_RUN))
                gone |= set() if stays else set(range(w, w + P.MIN_RUN))
            for _, start, end, stays in found or []:
                inside = {i for i, x in enumerate(starts) if start <= x < end}
                both |= inside
                gone |= set() if stays else inside
            if found and len(found) > 1:  # the words between two paragraphs that follow each other
                both |= {i for i, x in enumerate(starts) if 4 <= x < 80}
                gone |= {i for i, x in enumerate(starts) if 4 <= x < 30}
            flags = np.isin(np.arange(len(words)), sorted(both))
            for x, y in zip(*P._stretches(flags), strict=True):
                both -= set(range(x, y)) if y - x < P.MIN_RUN else set()
            gone &= both
            assert (r["n_duplicated"], r["n_removed"]) == (len(both), len(gone))
            assert r["text"].split() == [w for i, w in enumerate(words) if i not in gone]
