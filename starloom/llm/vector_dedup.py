"""Near duplicates among embeddings: spherical k-means cells and blocked cosine products.

Centres are fitted on a bounded sample. Every vector is at home in the cell of its nearest centre
and a guest in each cell whose centre is nearly as near; it is compared with those at home there.
Cells are large, so that a vector is a guest in few, and what travels is packed: one row has all
vectors that a batch sends to a cell. A cell with very many at home is cut into blocks. A task holds
one block and lets the others pass by. Blocks are taken in turns, so that only what one turn sends
lies on disk. A task multiplies in single precision, decides what is near the
threshold in double precision and sends, for each vector, how many it is linked with and one edge
towards the smallest vector of the block that it reaches: never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm import common as c
from starloom.llm.components import components

THRESHOLD = 0.95
SAMPLE = 16_384  # vectors that the centres are fitted on, at most
SAMPLE_BYTES = 1 << 26
MAX_CELLS = 4096
FEW_CELLS = 16  # more cells only if this many would have more than AT_HOME vectors each
AT_HOME = 4096
MARGIN = 0.12  # a centre this much less similar than the nearest still takes the vector as a guest
BLOCK = 16_384  # vectors at home that a task holds, at most
BLOCK_BYTES = 1 << 25
TURN_BYTES = 1 << 28  # what a turn sends at most, or twice all vectors where that is more
PRODUCTS = 1 << 22  # cosines that a task has at once
ITERATIONS = 8


def _clean(kind: str):
    """(_row, _id, embedding) to (_row, _id, vec): the components of valid vectors, null for the others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            values = column.flatten().cast(pa.float32() if kind == "f4" else pa.float64()).to_numpy(zero_copy_only=False) + 0.0  # one zero
            values = values.astype(kind)  # null is NaN
            ends = np.cumsum(sizes)
            sums = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[np.concatenate(([0], ends))])
            valid = (sums(~np.isfinite(values)) == 0) & (sums(values != 0) > 0)
            vecs = [values[end - size: end].tobytes() if ok else None for ok, size, end in zip(valid.tolist(), sizes.tolist(), ends.tolist(), strict=True)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(vecs, pa.binary())], names=["_row", "_id", "vec"])

    return run


def unit_rows(data: bytes, n: int, kind: str) -> np.ndarray:
    """The vectors of joined components, in double precision and of length one."""
    x = np.frombuffer(data, kind).reshape(n, -1).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # squares of very large or small components stay finite
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def fit_centres(sample: np.ndarray, cells: int) -> np.ndarray:
    """Spherical k-means; the first centres are rows at even distances."""
    centres = sample[np.linspace(0, len(sample) - 1, cells).astype(np.int64)].copy()
    for _ in range(ITERATIONS):
        nearest = np.concatenate([(sample[i: i + 2048] @ centres.T).argmax(axis=1) for i in range(0, len(sample), 2048)])
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        norms = np.sqrt(np.einsum("ij,ij->i", sums, sums))
        moved = norms > 0
        centres[moved] = sums[moved] / norms[moved, None]
    return centres


def _assigned(held, kind: str):
    """(rep, copies, vec) with the cell that each is at home in and all that it meets others in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, own in _by_size(batch):
                first, centres = held.value[size]
                step = max(1, min(4096, PRODUCTS // max(len(centres), size)))
                for at in range(0, own.num_rows, step):
                    part = own.slice(at, step)
                    near = unit_rows(b"".join(part.column("vec").to_pylist()), part.num_rows, kind) @ centres.T
                    met = near >= near.max(axis=1, keepdims=True) - MARGIN
                    ends = np.concatenate(([0], np.cumsum(met.sum(axis=1)))).astype(np.int32)
                    cells = pa.ListArray.from_arrays(ends, (first + np.nonzero(met)[1]).astype(np.int32))
                    yield pa.record_batch([part.column("rep"), part.column("copies"), part.column("vec"), pa.array((first + near.argmax(axis=1)).astype(np.int32)), cells],
                                          names=["rep", "copies", "vec", "home", "cells"])

    return run


def _by_size(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    lengths = pc.binary_length(batch.column("vec")).to_numpy()
    for size in np.unique(lengths).tolist():
        yield size, batch.filter(pa.array(lengths == size))


def _turns(met: dict[int, int], at_home: dict[int, int], sizes: dict[int, int]) -> tuple[dict[int, list[int]], int]:
    """The turn of each block of each cell, and how many turns there are; cells with none at home have no block."""
    loads = []
    for cell, n in at_home.items():
        blocks = -(-n // max(1, min(BLOCK, BLOCK_BYTES // sizes[cell])))
        loads += [(met[cell] * (sizes[cell] + 24), cell, block) for block in range(blocks)]
    all_vectors = sum(n * sizes[cell] for cell, n in at_home.items())
    turns = max(1, -(-sum(load for load, _, _ in loads) // max(TURN_BYTES, 2 * all_vectors)))
    sent, of = [0] * turns, {}
    for load, cell, block in sorted(loads, reverse=True):
        turn = min(range(turns), key=sent.__getitem__)
        sent[turn] += load
        of.setdefault(cell, {})[block] = turn
    return {cell: [turn for _, turn in sorted(blocks.items())] for cell, blocks in of.items()}, turns


_DEALT = "cell long, block long, guest boolean, rep binary, copies binary, home binary, ends binary, cells binary, vec binary"


def _dealt(turns, turn: int):
    """What a batch sends to a block of this turn, as one row of those at home in it and one of those that pass by.

    Those that pass by are the guests of the cell and those at home in its later blocks. Vectors at
    home come with the smaller cells that they are guests in.
    """
    names = [field.split(" ")[0] for field in _DEALT.split(", ")]

    def row(cell: int, block: int, guest: bool, rep, copies, home, ends, cells, vec) -> pa.RecordBatch:
        parts = [pa.array([x.tobytes()], pa.binary()) for x in (rep, copies, home, ends, cells, vec)]
        return pa.record_batch([pa.array([cell]), pa.array([block]), pa.array([guest]), *parts], names=names)

    def sent(part: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
        rep, copies, home = (part.column(k).to_numpy() for k in ("rep", "copies", "home"))
        data = np.frombuffer(b"".join(part.column("vec").to_pylist()), np.uint8).reshape(len(rep), size)
        lists, none = part.column("cells"), np.empty(0, np.int32)
        place, cell = np.repeat(np.arange(len(rep)), pc.list_value_length(lists).to_numpy()), lists.flatten().to_numpy()
        smaller = cell < home[place]
        ends = np.concatenate(([0], np.cumsum(np.bincount(place[smaller], minlength=len(rep)))))
        below = cell[smaller]
        block = (c.mix(rep) % np.array([len(turns.value[h]) for h in home.tolist()], np.uint64)).astype(np.int64)
        order = np.argsort(cell, kind="stable")
        place, cell = place[order], cell[order]
        for start, end in _runs(cell):
            here, k = place[start:end], int(cell[start])
            own = home[here] == k
            for b, taken in enumerate(turns.value.get(k, ())):
                if taken != turn:
                    continue
                mine = here[own & (block[here] == b)]
                if len(mine):
                    cells = [below[ends[i]: ends[i + 1]] for i in mine.tolist()]
                    yield row(k, b, False, rep[mine], copies[mine], none, np.cumsum([len(x) for x in cells], dtype=np.int32), np.concatenate(cells), data[mine])
                others = here[~own | (block[here] > b)]
                if len(others):
                    yield row(k, b, True, rep[others], copies[others], home[others], none, none, data[others])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, own in _by_size(batch):
                step = max(1, min(4096, PRODUCTS // size))
                for at in range(0, own.num_rows, step):
                    out = list(sent(own.slice(at, step), size))
                    for i in range(0, len(out), 64):
                        yield pa.Table.from_batches(out[i: i + 64]).combine_chunks().to_batches()[0]

    return run


def _runs(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """(start, end) of each run of equal keys."""
    edges = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    yield from zip([0, *edges.tolist()], [*edges.tolist(), len(keys)], strict=True)


class _Block:
    """The vectors at home in a block, and what is found of them."""

    def __init__(self, cell: int, size: int, kind: str) -> None:
        self.cell, self.size, self.kind = cell, size, kind
        self.parts: list[tuple] = []  # at home first; once these are known, what passes by and waits
        self.waiting = 0
        self.ready = False

    def add(self, rep: bytes, copies: bytes, ends: bytes, cells: bytes, vec: bytes) -> None:
        self.parts.append((rep, copies, np.diff(np.frombuffer(ends, np.int32), prepend=np.int32(0)), cells, vec))

    def close(self) -> None:
        """All at home are there: links among them."""
        self.ready = True
        if not self.parts:
            self.rep = np.empty(0, np.int64)
            return
        reps, copies, counts, cells, vecs = zip(*self.parts, strict=True)
        self.parts = []
        rep, counts = np.frombuffer(b"".join(reps), np.int64), np.concatenate(counts)
        order = np.argsort(rep)  # so that the smallest place is the smallest vector
        owner = np.repeat(np.argsort(order), counts)
        cells = np.frombuffer(b"".join(cells), np.int32)
        self.width = int(max(cells.max(initial=0), self.cell)) + 1
        self.below = np.sort(owner * self.width + cells)
        self.rep, self.copies = rep[order], np.frombuffer(b"".join(copies), np.int64)[order]
        self.data = np.frombuffer(b"".join(vecs), np.uint8).reshape(len(rep), self.size)[order]
        self.x = unit_rows(self.data.tobytes(), len(rep), self.kind).astype(np.float32)
        self.links, self.label = np.zeros(len(rep), np.int64), np.arange(len(rep))
        step = max(1, PRODUCTS // len(rep))
        for at in range(0, len(rep), step):
            i, j = self._near(self.x[at: at + step], self.data[at: at + step], at)
            i = i + at
            i, j = i[i < j], j[i < j]
            np.add.at(self.links, i, self.copies[j])
            np.add.at(self.links, j, self.copies[i])
            self._merge(i, j)

    def _near(self, x: np.ndarray, data: np.ndarray, after: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (place in x, place at home) with a cosine of THRESHOLD or more; none with places up to ``after``."""
        first = after + 1
        cosines = x @ self.x[first:].T
        slack = (x.shape[1] + 16) * 2.0 ** -23  # more than single precision can be off
        i, j = np.nonzero(cosines >= np.float32(THRESHOLD - slack))
        unsure = np.flatnonzero(cosines[i, j] < np.float32(THRESHOLD + slack))
        j += first
        keep = np.ones(len(i), bool)
        step = max(1, PRODUCTS // x.shape[1])
        for at in range(0, len(unsure), step):
            part = unsure[at: at + step]
            a, b = (unit_rows(rows.tobytes(), len(part), self.kind) for rows in (data[i[part]], self.data[j[part]]))
            keep[part] = np.einsum("ij,ij->i", a, b) >= THRESHOLD
        return i[keep], j[keep]

    def _merge(self, a: np.ndarray, b: np.ndarray) -> None:
        """The classes of places a and b at home become one, named by its smallest place."""
        label = self.label
        while True:
            la, lb = label[a], label[b]
            differ = la != lb
            if not differ.any():
                return
            a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
            np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
            while (label[label] != label).any():
                label[:] = label[label]

    def passing(self, rep: bytes, copies: bytes, home: bytes, vec: bytes) -> Iterator[pa.RecordBatch]:
        """Links of vectors from elsewhere with those at home; a few rows wait for more."""
        if not len(self.rep):
            return
        self.parts.append((rep, copies, home, vec))
        self.waiting += len(rep) // 8
        if self.waiting * max(len(self.rep), self.size) >= PRODUCTS:
            yield from self._pass()

    def _pass(self) -> Iterator[pa.RecordBatch]:
        rep, copies, home, vec = (b"".join(x) for x in zip(*self.parts, strict=True))
        self.parts, self.waiting = [], 0
        rep, copies, home = np.frombuffer(rep, np.int64), np.frombuffer(copies, np.int64), np.frombuffer(home, np.int32).astype(np.int64)
        data = np.frombuffer(vec, np.uint8).reshape(len(rep), self.size)
        x = unit_rows(vec, len(rep), self.kind).astype(np.float32)
        step = max(1, PRODUCTS // len(self.rep))
        for at in range(0, len(rep), step):
            i, j = self._near(x[at: at + step], data[at: at + step])
            i = i + at
            # a pair that both cells could find is found in the smaller
            elsewhere = home[i] < self.cell
            if len(self.below):
                key = j * self.width + home[i]
                found = np.minimum(np.searchsorted(self.below, key), len(self.below) - 1)
                elsewhere &= (self.below[found] == key)
            else:
                elsewhere[:] = False
            i, j = i[~elsewhere], j[~elsewhere]
            if not len(i):
                continue
            np.add.at(self.links, j, copies[i])
            linked, first, inverse = np.unique(i, return_index=True, return_inverse=True)
            self._merge(j[first][inverse], j)
            links = np.zeros(len(linked), np.int64)
            np.add.at(links, inverse, self.copies[j])
            yield self._rows(rep[linked], links, j[first])

    def _rows(self, rep: np.ndarray, links: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array(rep), pa.array(links), pa.array(self.rep[self.label[place]])], names=["rep", "links", "root"])

    def done(self) -> Iterator[pa.RecordBatch]:
        if not self.ready:
            self.close()
        if self.parts:
            yield from self._pass()
        if len(self.rep):
            linked = np.flatnonzero(self.links)
            if len(linked):
                yield self._rows(self.rep[linked], self.links[linked], linked)


def _compared(kind: str):
    """Rows sorted by (cell, block, guest) to (rep, links, root)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                cell, block, guest, rep, copies, home, ends, cells, vec = (col[i].as_py() for col in batch.columns)
                if key != (cell, block):
                    if held:
                        yield from held.done()
                    key, held = (cell, block), _Block(cell, len(vec) * 8 // len(rep), kind)
                if not guest:
                    held.add(rep, copies, ends, cells, vec)
                    continue
                if not held.ready:
                    held.close()
                yield from held.passing(rep, copies, home, vec)
        if held:
            yield from held.done()

    return run


def link_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(_row, id, n_links, component_id, kept) for every row of a stored table.

    Two rows link when the cosine of their vectors, in double precision, is 0.95 or more and they
    meet in a cell; equal vectors always do. A vector that is null, empty or zero, or holds a null
    or a non-finite component, links with nothing, and neither do vectors of different lengths.
    ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest id reachable
    (null ids rank last), ``kept`` marks the rows that have that id. Repeated rows link with each
    other; further columns are ignored. Equal vectors are compared once, with their number.
    """
    spark = vectors.sparkSession
    rows = c.with_row(vectors.select(F.col(id_col).alias("_id"), F.col(vector_col).alias("embedding"))).select("_row", "_id", "embedding")
    kind = "f4" if isinstance(rows.schema["embedding"].dataType.elementType, T.FloatType) else "f8"
    clean = rows.mapInArrow(_clean(kind), T.StructType([*rows.schema.fields[:2], T.StructField("vec", T.BinaryType())]))
    distinct = c.stored(clean.where(F.col("vec").isNotNull()).groupBy("vec").agg(F.min("_row").alias("rep"), F.count("*").alias("copies")), "vector-distinct")

    centres, sizes = {}, {}  # by vector length; by cell
    counts = distinct.groupBy(F.octet_length("vec").alias("size")).count().orderBy("size").collect()  # one row per vector length
    for size, n in counts:
        own = distinct.where(F.octet_length("vec") == size)
        sample = own.orderBy(F.xxhash64("rep")).limit(max(1, min(SAMPLE, SAMPLE_BYTES // size))).select("vec").collect()
        cells = max(1, min(MAX_CELLS, int(n ** 0.5), len(sample) // 8, max(FEW_CELLS, n // AT_HOME)))
        centres[size] = len(sizes), fit_centres(unit_rows(b"".join(bytes(r["vec"]) for r in sample), len(sample), kind), cells)
        sizes.update(dict.fromkeys(range(len(sizes), len(sizes) + cells), size))
    held = spark.sparkContext.broadcast(centres)
    assigned = c.stored(distinct.mapInArrow(_assigned(held, kind), "rep long, copies long, vec binary, home int, cells array<int>"), "vector-cells")
    c.discard(distinct)
    at_home = dict(map(tuple, assigned.groupBy("home").count().collect()))  # one row per cell
    met = dict(map(tuple, assigned.select(F.explode("cells").alias("cell")).groupBy("cell").count().collect()))
    turn_of, turns = _turns(met, at_home, sizes)
    turn_of = spark.sparkContext.broadcast(turn_of)

    def compared(turn: int) -> DataFrame:
        dealt = assigned.mapInArrow(_dealt(turn_of, turn), _DEALT).repartition("cell", "block").sortWithinPartitions("cell", "block", "guest")
        return c.stored(dealt.mapInArrow(_compared(kind), "rep long, links long, root long"), "vector-links")

    found = reduce(DataFrame.unionByName, [compared(turn) for turn in range(turns)])
    comps = components(found.select("rep", "root"), "rep", "root", "vector")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))

    # Rows find their vector by a hash of it that no two vectors share.
    seed = 0
    while assigned.agg(F.countDistinct(F.xxhash64(F.lit(seed), "vec"))).first()[0] < sum(n for _, n in counts):
        seed += 1
    key = F.xxhash64(F.lit(seed), "vec")
    each = assigned.select(key.alias("key"), F.lit(True).alias("valid"), "rep", "copies").join(links, "rep", "left").join(comps.withColumnRenamed("node", "rep"), "rep", "left").select(
        "key", "valid", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("comp"))
    valid = F.col("vec").isNotNull()
    own = clean.select("_row", "_id", F.when(valid, key).otherwise(F.col("_row")).alias("key"), valid.alias("valid")).join(each, ["key", "valid"], "left").select(
        "_row", "_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("comp", "_row").alias("comp"))
    own = c.stored(own, "vector-own")
    least = own.groupBy("comp").agg(F.min("_id").alias("component_id"))
    return own.join(least, "comp").select(
        "_row", F.col("_id").alias(id_col), "n_links", "component_id", F.col("_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).drop("_row")


OP4_SQL = f"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b
          ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= {THRESHOLD}),
reach AS (SELECT vec_id AS v, vec_id AS r FROM embeddings UNION SELECT reach.v, links.b FROM reach JOIN links ON reach.r = links.a),
least AS (SELECT v, min(r) AS component_id FROM reach GROUP BY v),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least ON vec_id = v LEFT JOIN counts ON vec_id = a
"""
