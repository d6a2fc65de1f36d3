import numpy as np
import pyarrow as pa
import pytest
from starloom.llm import vector_dedup as V


def brute(rows):
    ok = [i for i, (_, v) in enumerate(rows) if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = {i: set() for i in range(len(rows))}
    for a in ok:
        for b in ok:
            x, y = (np.array(rows[k][1], np.float32).astype(np.float64) for k in (a, b))
            if a != b and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.95:
                links[a].add(b)
    comp = list(range(len(rows)))
    while True:
        new = [min([comp[i], *(comp[j] for j in links[i])]) for i in range(len(rows))]
        if new == comp:
            break
        comp = new
    ids = {}
    for i, (k, _) in enumerate(rows):
        ids.setdefault(comp[i], []).append(k)
    return sorted(((k, len(links[i]), min(ids[comp[i]])) for i, (k, _) in enumerate(rows)), key=repr)


def groups(n, seed=0):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        base = rng.normal(size=16)
        for _ in range(rng.integers(1, 7)):
            out.append((base + rng.normal(size=16) * rng.choice([0, 0.05, 0.12, 0.3])).astype(np.float32).tolist())
    return out


@pytest.mark.parametrize("block", [1024, 5])
def test_matches_brute_force(docs, monkeypatch, block):
    monkeypatch.setattr(V, "BLOCK", block)
    vectors = groups(60) + [None, [], [0.0] * 16, [1.0] * 15 + [None], [1.0] * 15 + [float("nan")], [1.0] * 15 + [float("inf")], [1.0, 2.0], [2.0, 4.0], [-0.0] * 16]
    vectors += [vectors[0]] * 3 + [[x * 1e-30 for x in vectors[0]], [x * 1e30 for x in vectors[1]]]
    rows = [((i * 17) % 401, v) for i, v in enumerate(vectors)]
    found = V.link_vectors(docs([(i, v, 0, b"x") for i, v in rows], "vec_id long, embedding array<float>, label int, vec binary"))
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in found.collect()), key=repr)
    assert got == brute(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found.collect())


def test_recall_on_loose_groups(docs):
    rng = np.random.default_rng(5)
    bases = rng.normal(size=(40, 32))
    rows = [(i, (bases[i % 40] + rng.normal(size=32) * 0.2).astype(np.float32).tolist()) for i in range(1200)]
    expected = {k: n for k, n, _ in brute(rows)}
    got = {r["vec_id"]: r["n_links"] for r in V.link_vectors(docs(rows, "vec_id long, embedding array<float>")).collect()}
    assert all(got[k] <= expected[k] for k in got)
    assert sum(got.values()) >= 0.97 * sum(expected.values()) > 0


def test_repeated_and_null_ids_and_empty_table(docs):
    rows = [(None, [1.0, 0.0]), (4, [1.0, 0.0]), (4, [1.0, 0.1]), (None, [0.0, 1.0])]
    found = V.link_vectors(docs(rows, "vec_id long, embedding array<float>")).collect()
    assert sorted(((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in found), key=repr) == sorted(
        [(0, 2, 4, False), (4, 2, 4, True), (4, 2, 4, True), (0, 0, None, True)], key=repr)
    assert V.link_vectors(docs([], "vec_id long, embedding array<float>")).collect() == []


@pytest.mark.parametrize("block", [1024, 60])
def test_a_vector_travels_once_per_cell_and_block(block):
    """However many pass by a cell: it was once per 1024 of all that meet there."""
    class Held:
        def __init__(self, value):
            self.value = value

    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 8)).astype(np.float32)
    centres = V.fit_centres(V.unit_rows(x.tobytes(), len(x), "f4"), 4)
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1)[:, None]
    near = unit @ centres.T
    home, met = near.argmax(axis=1), (near >= near.max(axis=1, keepdims=True) - V.MARGIN)
    blocks = {k: -(-int((home == k).sum()) // block) for k in range(4)}
    turns = Held({k: [b % 2 for b in range(n)] for k, n in blocks.items()})
    batch = pa.record_batch([pa.array(np.arange(3000)), pa.array(np.ones(3000, np.int64)), pa.array([v.tobytes() for v in x], pa.binary())], names=["rep", "copies", "vec"])
    assigned = list(V._assigned(Held({32: (0, centres)}), "f4")(iter([batch])))
    sent = [r for turn in (0, 1) for out in V._dealt(turns, turn)(iter(assigned)) for r in out.to_pylist()]
    at_home = sorted((r["cell"], i) for r in sent if not r["guest"] for i in np.frombuffer(r["rep"], np.int64).tolist())
    assert at_home == sorted(zip(home.tolist(), range(3000)))
    passing = sum(len(r["rep"]) // 8 for r in sent if r["guest"])
    guests = sum(blocks[k] * int((met[:, k] & (home != k)).sum()) for k in range(4))
    assert guests <= passing <= guests + sum(blocks[k] * int((home == k).sum()) for k in range(4))
    assert block < 1024 or passing == guests
    assert all(len(r["vec"]) == 4 * len(r["rep"]) for r in sent)  # 8 components of the given precision, 32 bytes


def test_cosines_next_to_the_threshold_are_taken_in_double_precision(docs):
    rows, expected = [], {}
    for k, off in enumerate([1e-3, 1e-6, 1e-9, 1e-12, -1e-12, -1e-9, -1e-6, -1e-3]):
        cosine, base = 0.95 + off, np.zeros(32)
        base[2 * k] = 3.0
        other = np.zeros(32)
        other[2 * k], other[2 * k + 1] = cosine, np.sqrt(1 - cosine * cosine)
        rows += [(2 * k, base.tolist()), (2 * k + 1, other.tolist())]
        expected |= dict.fromkeys((2 * k, 2 * k + 1), int(off > 0))
    found = V.link_vectors(docs(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["vec_id"]: r["n_links"] for r in found} == expected


def test_turns_bound_what_is_sent_at_once_and_leave_the_rows_alone(docs, monkeypatch):
    vectors = groups(40, seed=4) + [None, [1.0, 2.0], [2.0, 4.0]]
    rows = [(i, v) for i, v in enumerate(vectors)]
    monkeypatch.setattr(V, "TURN_BYTES", 1 << 10)
    monkeypatch.setattr(V, "BLOCK", 8)
    made = []

    def turns(met, at_home, sizes, real=V._turns):
        of, n = real(met, at_home, sizes)
        loads = [0] * n
        for cell, taken in of.items():
            assert len(taken) == -(-at_home[cell] // 8)
            for turn in taken:
                loads[turn] += met[cell] * (sizes[cell] + 24)
        most = max(1 << 10, 2 * sum(n * sizes[cell] for cell, n in at_home.items()))
        assert max(loads) <= most + max(met[cell] * (sizes[cell] + 24) for cell in of)
        made.append(n)
        return of, n

    monkeypatch.setattr(V, "_turns", turns)
    found = V.link_vectors(docs(rows, "vec_id long, embedding array<float>")).collect()
    assert made[0] > 1
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in found), key=repr) == brute(rows)
