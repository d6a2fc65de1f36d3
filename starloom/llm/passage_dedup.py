"""Substring deduplication: MinHash banding of short paragraphs, verified, clustered, and cut out.

A paragraph is a sentence of a line with MIN_WORDS words or more, so that a passage is found wherever
in a line it stands. Distinct paragraphs get MinHash signatures of their 5-word shingles, in BANDS
bands of ROWS hashes: at a similarity of 0.8 a pair meets in a band with probability
1 - (1 - 0.8 ** ROWS) ** BANDS = 0.986, and in each of its other copies again. Pairs that meet are
verified by exact Jaccard and joined to clusters: each with the first of its band and the one before
it, then all of a band that are still in different clusters. Of a cluster the first place in the
corpus stays; other places are removed where they are part of a run of MIN_RUN duplicated words.

Passages that do not line up with paragraphs are found word by word. Of every GRAMS consecutive
windows of GRAM words the one with the least hash is a print, so that any MIN_RUN words hold a
print and equal ones the same; windows of MIN_RUN words are counted wherever they hold a print that
occurs again. So every word in a run of MIN_RUN words that stands elsewhere too is found, whatever
the punctuation and the line breaks. Only the inside of a word repeated more than GRAM times has no prints.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import common as c
from starloom.llm.components import components

MIN_WORDS = 6
MIN_RUN = 25  # words from the first to the last paragraph of a duplicated run
BLOCK = 1024  # members of one band that are compared with as many others in one go
SKETCH = ["k0", "k1"]  # 64-bit words of a parity sketch
GRAM = 12  # words of a print
GRAMS = MIN_RUN - GRAM + 1  # windows of which one is a print
SHINGLE = 5
BANDS, ROWS = 6, 3
NUM, DEN = 4, 5  # similar: DEN * intersection >= NUM * union
CODES = c.byte_codes(414)
SEEDS = c.mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(77))
ENDS = np.zeros(256, bool)
ENDS[list(b".!?")] = True


class Paragraphs:
    """The paragraphs of a chunk of texts: document, byte span and word span of each, and word hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, pw: c.Powers) -> None:
        data = c.lower_ascii(data)
        starts, ends = c.word_bounds(data)
        self.words = c.word_hashes(data, starts, ends, CODES, pw)
        # a paragraph ends with a word that ends in . ! or ?, and before a line feed
        feeds = np.concatenate(([0], np.cumsum(data == 10)))
        line = feeds[starts]
        last = np.ones(len(starts), bool)
        if len(starts):
            last[:-1] = ENDS[data[ends[:-1] - 1]] | (line[1:] != line[:-1])
        stop = np.flatnonzero(last) + 1
        first = np.concatenate(([0], stop))[: len(stop)]
        long = stop - first >= MIN_WORDS
        self.first, self.stop = first[long], stop[long]
        self.start, self.end = starts[self.first], ends[self.stop - 1]
        self.doc = np.searchsorted(offsets, self.start, "right") - 1
        n = self.stop - self.first
        owner = np.repeat(np.arange(len(n)), n)
        self.hashed = self._fold(c.mix(self.words[self._places(n, self.first)] + c.mix(self._offsets(n).astype(np.uint64) + np.uint64(9))), owner, len(n))

    @staticmethod
    def _offsets(n: np.ndarray) -> np.ndarray:
        return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)

    @classmethod
    def _places(cls, n: np.ndarray, first: np.ndarray) -> np.ndarray:
        return cls._offsets(n) + np.repeat(first, n)

    @staticmethod
    def _fold(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros(n, np.uint64)
        np.add.at(out, owner, values)
        return c.mix(out)

    def shingles(self) -> tuple[np.ndarray, np.ndarray]:
        """(paragraph, hash) of every 5-word window, in order."""
        n = self.stop - self.first - SHINGLE + 1
        at = self._places(n, self.first)
        out = np.zeros(len(at), np.uint64)
        for i in range(SHINGLE):
            out = c.mix(out + self.words[at + i])
        return np.repeat(np.arange(len(n)), n), out

    def bands(self) -> np.ndarray:
        """Band hashes of each paragraph."""
        owner, hashed = self.shingles()
        first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else np.zeros(0, np.int64)
        out = np.zeros((len(first), BANDS), np.uint64)
        for i, seed in enumerate(SEEDS):
            x = (hashed ^ seed) * np.uint64(0x9E3779B97F4A7C15)
            least = np.minimum.reduceat(x ^ (x >> np.uint64(32)), first) if len(first) else x
            out[:, i // ROWS] = c.mix(out[:, i // ROWS] + least + np.uint64(i // ROWS + 1))
        return out


def _unit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_row, text) to one row per paragraph: its hash, number among the paragraphs of its text, and span in bytes."""
    pw = c.Powers()
    for batch in batches:
        for first, data, offsets in c.chunks(batch.column(1)):
            p = Paragraphs(data, offsets, pw)
            begin = np.searchsorted(p.doc, np.arange(len(offsets) - 1))
            yield pa.record_batch(
                [batch.column(0).take(pa.array(first + p.doc)), pa.array(c.signed(p.hashed)), pa.array((np.arange(len(p.doc)) - begin[p.doc]).astype(np.int32)),
                 pa.array(p.start - offsets[p.doc]), pa.array(p.end - offsets[p.doc]), pa.array(p.first)], names=["_row", "h", "place", "start", "end", "word"])


def _band_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) to (band, h), each distinct pair of a chunk once."""
    pw = c.Powers()
    for batch in batches:
        for _, data, offsets in c.chunks(batch.column(0), 4 * c.CHUNK_BYTES):
            p = Paragraphs(data, offsets, pw)
            _, at = np.unique(p.hashed, return_index=True)
            bands = p.bands()[at]
            yield pa.record_batch([pa.array(c.signed(bands.ravel())), pa.array(c.signed(np.repeat(p.hashed[at], BANDS)))], names=["band", "h"])


def _meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """As ``_met``, without the band."""
    for batch in _met(batches):
        yield batch.select(["a", "b"])


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (band, h): each paragraph of a band with the first one and with the one before it."""
    band = first = last = None
    for batch in batches:
        bands, hs = (np.asarray(batch.column(i)) for i in (0, 1))
        if band is not None:
            bands, hs = np.append(band, bands), np.append(last, hs)
        new = np.append(True, bands[1:] != bands[:-1])
        lead = hs[np.maximum.accumulate(np.where(new, np.arange(len(hs)), 0))]
        if band is not None:
            lead[: int(np.argmax(new[1:]) + 1) if new[1:].any() else len(lead)] = first
        i = np.flatnonzero(~new & np.append(False, hs[1:] != hs[:-1]))
        a, b = np.concatenate((lead[i], hs[i - 1])), np.concatenate((hs[i], hs[i]))
        pairs = np.unique(np.stack((np.append(bands[i], bands[i]), a, b), axis=1)[a != b], axis=0)
        yield pa.record_batch([pa.array(pairs[:, k]) for k in range(3)], names=["band", "a", "b"])
        band, last, first = bands[-1:], hs[-1:], lead[-1]


def _chunk_words(data: np.ndarray, offsets: np.ndarray, pw: c.Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, place in its document, hash) of every word of a chunk."""
    data = c.lower_ascii(data)
    starts, ends = c.word_bounds(data)
    doc = np.searchsorted(offsets, starts, "right") - 1
    first = np.searchsorted(doc, np.arange(len(offsets) - 1))
    return doc, np.arange(len(doc)) - first[doc], c.word_hashes(data, starts, ends, CODES, pw)


def _windows(words: np.ndarray, n: int, pw: c.Powers) -> np.ndarray:
    """A hash of every n consecutive words, by the place of the first."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    up, down = pw.to(len(words) + 1)
    prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * up[: len(words)])))
    return c.mix((prefix[n:] - prefix[:-n]) * down[: len(words) - n + 1] + np.uint64(n))


def _sliding(values: np.ndarray, n: int, best: np.ufunc) -> np.ndarray:
    """The best of every n consecutive values."""
    size = 1
    while size * 2 <= n:
        values, size = best(values[:-size], values[size:]), size * 2
    return best(values[: len(values) - (n - size)], values[n - size:])


def prints(doc: np.ndarray, words: np.ndarray, pw: c.Powers) -> tuple[np.ndarray, np.ndarray]:
    """(place in the chunk, hash) of the least of every GRAMS windows of a document; all of them when they tie."""
    hashed = _windows(words, GRAM, pw)
    if len(words) < MIN_RUN:
        return np.zeros(0, np.int64), hashed[:0]
    most = np.uint64(2**64 - 1)
    rank = hashed.copy()
    rank[:-1][hashed[1:] == hashed[:-1]] = most  # one word over and over
    least = _sliding(rank, GRAMS, np.minimum)
    whole = doc[MIN_RUN - 1:] == doc[: len(doc) - MIN_RUN + 1]
    edge = np.zeros(GRAMS - 1, np.uint64)
    seen = _sliding(np.concatenate((edge, np.where(whole, least, 0).astype(np.uint64), edge)), GRAMS, np.maximum)
    at = np.flatnonzero((seen == rank) & (rank != most) & (rank != 0))
    return at, hashed[at]


def _print_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_row, text) to (_row, h, word)."""
    pw = c.Powers()
    for batch in batches:
        for first, data, offsets in c.chunks(batch.column(1)):
            doc, place, words = _chunk_words(data, offsets, pw)
            at, hashed = prints(doc, words, pw)
            yield pa.record_batch([batch.column(0).take(pa.array(first + doc[at])), pa.array(c.signed(hashed)), pa.array(place[at].astype(np.int32))], names=["_row", "h", "word"])


def _run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_row, text, words of shared prints) to (_row, g, word): the windows of MIN_RUN words that hold such a print."""
    pw = c.Powers()
    for batch in batches:
        marks = batch.column(2)
        for first, data, offsets in c.chunks(batch.column(1)):
            doc, place, words = _chunk_words(data, offsets, pw)
            if len(words) < MIN_RUN:
                continue
            part = marks.slice(first, len(offsets) - 1)
            owner = np.repeat(np.arange(len(part)), np.asarray(part.value_lengths()))
            at = np.searchsorted(doc, owner) + np.asarray(part.flatten())
            # +1 where a print comes into the window, -1 behind it
            step = np.zeros(len(words) + 1, np.int64)
            np.add.at(step, np.maximum(at - GRAMS + 1, 0), 1)
            np.add.at(step, at + 1, -1)
            held = np.cumsum(step)[: len(words) - MIN_RUN + 1] > 0
            at = np.flatnonzero(held & (doc[MIN_RUN - 1:] == doc[: len(doc) - MIN_RUN + 1]))
            yield pa.record_batch([batch.column(0).take(pa.array(first + doc[at])), pa.array(c.signed(_windows(words, MIN_RUN, pw)[at])), pa.array(place[at].astype(np.int32))], names=["_row", "g", "word"])


def repeated_runs(texts: DataFrame) -> DataFrame:
    """(_row, runs): first word of every window of MIN_RUN words that (_row, text) holds more than once, as -1 - word if it stays.

    The first place stays, and so do windows of its text that overlap it.
    """
    shown = c.stored(texts.mapInArrow(_print_rows, "_row long, h long, word int"), "passage-prints")
    shared = shown.groupBy("h").count().where("count > 1").select("h")
    marked = shown.join(shared, "h", "left_semi").groupBy("_row").agg(F.collect_list("word").alias("words"))
    runs = texts.join(marked, "_row").select("_row", "text", "words").mapInArrow(_run_rows, "_row long, g long, word int")
    runs = c.stored(runs, "passage-runs")
    again = runs.groupBy("g").agg(F.count("*").alias("n"), F.min(F.struct("_row", "word")).alias("first")).where("n > 1")
    stays = (F.col("_row") == F.col("first._row")) & (F.col("word") < F.col("first.word") + MIN_RUN)
    found = runs.join(again, "g").select("_row", F.when(stays, -1 - F.col("word")).otherwise(F.col("word")).cast("int").alias("r"))
    return found.groupBy("_row").agg(F.collect_list("r").alias("runs"))


def _apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (band, lo, hi): pairs of different clusters that may be similar."""
    kept: dict[str, np.ndarray] = {}
    for batch in batches:
        got = {name: np.asarray(batch.column(name)) for name in batch.schema.names}
        if kept:
            got = {k: np.concatenate((kept[k], v)) for k, v in got.items()}
        change = np.logical_or.reduce([got[k] != got[k][-1:] for k in ("band", "lo", "hi")])
        cut = int(np.flatnonzero(change)[-1]) + 1 if change.any() else 0
        kept = {k: v[cut:] for k, v in got.items()}
        if cut:
            yield _compared({k: v[:cut] for k, v in got.items()})
    if kept:
        yield _compared(kept)


def _compared(g: dict[str, np.ndarray]) -> pa.RecordBatch:
    """Each shingle that only one set has turns one bit, so bits apart never exceed those shingles."""
    found, d = [np.zeros((0, 2), np.int64)], 1
    while d < len(g["band"]) and (near := np.logical_and.reduce([g[k][d:] == g[k][:-d] for k in ("band", "lo", "hi")])).any():
        i = np.flatnonzero(near & (g["comp"][d:] != g["comp"][:-d]) & ((g["block"][d:] != g["block"][:-d]) | (g["lo"][d:] == g["hi"][d:])))
        bits = sum(np.bitwise_count((g[k][i] ^ g[k][i + d]).view(np.uint64)).astype(np.int64) for k in SKETCH)
        i = i[bits * (DEN + NUM) <= (g["n"][i] + g["n"][i + d]) * (DEN - NUM)]
        x, y = g["h"][i], g["h"][i + d]
        found.append(np.stack((np.minimum(x, y), np.maximum(x, y)), axis=1))
        d += 1
    pairs = np.unique(np.concatenate(found), axis=0)
    return pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _shingles(paragraph: bytes) -> set[tuple[bytes, ...]]:
    words = paragraph.lower().split()
    return set(zip(*(words[k:] for k in range(SHINGLE)), strict=False))


def _sketch(shingles: set[tuple[bytes, ...]]) -> list[int]:
    """Parity of the shingles on each of 128 bits, as two signed numbers."""
    bits = 0
    for shingle in shingles:
        bits ^= 1 << (zlib.crc32(b" ".join(shingle)) & 127)
    return np.array([bits & (1 << 64) - 1, bits >> 64], np.uint64).view(np.int64).tolist()


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, spans) to (h, paragraph, number of shingles, sketch)."""
    for batch in batches:
        for i in range(batch.num_rows):
            text = batch.column(0)[i].as_py().encode()
            h, start, end = batch.column(1).slice(i, 1).flatten().flatten()
            cut = [text[s:e] for s, e in zip(start.to_pylist(), end.to_pylist(), strict=True)]
            sets = [_shingles(p) for p in cut]
            sketch = np.array([_sketch(x) for x in sets], np.int64).reshape(-1, 2)
            yield pa.record_batch(
                [h, pa.array(cut, pa.binary()), pa.array([len(x) for x in sets], pa.int64()), pa.array(sketch[:, 0]), pa.array(sketch[:, 1])],
                names=["h", "paragraph", "n", *SKETCH])


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, paragraph_a, paragraph_b) to the pairs whose exact Jaccard is 0.8 or more."""
    for batch in batches:
        a, b, x, y = (batch.column(i).to_pylist() for i in range(4))
        good = []
        for i, (p, q) in enumerate(zip(x, y, strict=True)):
            s, t = _shingles(p), _shingles(q)
            if DEN * len(s & t) >= NUM * len(s | t):
                good.append(i)
        yield pa.record_batch([pa.array([a[i] for i in good], pa.int64()), pa.array([b[i] for i in good], pa.int64())], names=["a", "b"])


def _stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place of each stretch of true flags, and the place behind it."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return edge[0::2], edge[1::2]


def _covered(first: np.ndarray, n: int) -> np.ndarray:
    """Which of n words a window of MIN_RUN words covers; the windows begin at ``first``."""
    return np.cumsum(np.bincount(first, minlength=n + 1) - np.bincount(first + MIN_RUN, minlength=n + 1))[:n] > 0


def _parts(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Where the items of each row of a list column begin and end, and all items; a null list has none."""
    lengths = np.asarray(column.value_lengths().fill_null(0))
    return np.concatenate(([0], np.cumsum(lengths))), column.flatten()


def _marked(whole: bytes, found: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of a text, which of them are duplicated, and which of these are not the first."""
    starts, ends = c.word_bounds(np.frombuffer(whole + b"\n", np.uint8))
    both, gone = np.zeros(len(starts), bool), np.zeros(len(starts), bool)
    before = None
    found = found[np.lexsort(found.T[::-1])]
    spans = np.searchsorted(starts, found[:, 1:3])
    for (place, _, _, stays), (x, y) in zip(found.tolist(), spans.tolist(), strict=True):
        # short sentences between two duplicated paragraphs go with them
        follows = before is not None and before[0] + 1 == place
        both[before[1] if follows else x: y] = True
        if not stays:
            gone[before[1] if follows and not before[2] else x: y] = True
        before = place, y, stays
    both |= _covered(np.where(windows < 0, -1 - windows, windows), len(starts))
    gone |= _covered(windows[windows >= 0], len(starts))
    return starts, ends, both, gone


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_row, text, duplicated paragraphs, id, repeated windows) to (_row, id, kept text, removed spans, duplicated words, removed words)."""
    for batch in batches:
        out: list[list] = [[], [], [], []]
        (cut, units), (at, runs) = _parts(batch.column(2)), _parts(batch.column(4))
        units = np.stack([np.asarray(x.cast(pa.int64())) for x in units.flatten()], axis=1)
        runs = np.asarray(runs).astype(np.int64)
        for i, text in enumerate(batch.column(1)):
            whole = (text.as_py() or "").encode()
            spans, duplicated, removed = [], 0, 0
            found, windows = units[cut[i]: cut[i + 1]], runs[at[i]: at[i + 1]]
            if len(found) or len(windows):
                starts, ends, both, gone = _marked(whole, found, windows)
                for x, y in zip(*_stretches(both), strict=True):
                    if y - x < MIN_RUN:
                        gone[x:y] = False
                    else:
                        duplicated += int(y - x)
                spans = [{"start": int(starts[x]), "end": int(ends[y - 1])} for x, y in zip(*_stretches(gone), strict=True)]
                removed = int(gone.sum())
            left, right = [0] + [s["end"] for s in spans], [s["start"] for s in spans] + [len(whole)]
            kept = b"".join(whole[x:y] for x, y in zip(left, right, strict=True)).decode()
            for column, value in zip(out, (None if not text.is_valid else kept, spans, duplicated, removed), strict=True):
                column.append(value)
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.record_batch(
            [batch.column(0), batch.column(3), pa.array(out[0], pa.string()), pa.array(out[1], span), pa.array(out[2], pa.int64()), pa.array(out[3], pa.int64())],
            names=["_row", "_id", "text", "spans", "n_duplicated", "n_removed"])


def paragraph_clusters(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(units, clusters): every paragraph of (_row, text), and (h, comp) of paragraphs similar to another one."""
    units = c.stored(texts.mapInArrow(_unit_rows, "_row long, h long, place int, start long, end long, word long").drop("word"), "passage-units")
    bands = texts.select("text").mapInArrow(_band_rows, "band long, h long")
    met = c.stored(bands.repartition("band").sortWithinPartitions("band", "h").mapInArrow(_met, "band long, a long, b long"), "passage-met")
    pairs = c.stored(met.select("a", "b").distinct(), "passage-pairs")
    needed = pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct()
    where = units.join(needed, "h", "left_semi").groupBy("h").agg(F.min(F.struct("_row", "start", "end")).alias("at"))
    where = where.groupBy("at._row").agg(F.collect_list(F.struct("h", "at.start", "at.end")).alias("spans"))
    sliced = texts.join(where, "_row").select("text", "spans").mapInArrow(_slices, "h long, paragraph binary, n long, k0 long, k1 long")
    paragraphs = c.stored(sliced, "passage-texts")
    links = _verified(pairs, paragraphs, "passage-links")
    clusters = components(links, "a", "b", "passage")

    members = met.select("band", F.explode(F.array("a", "b")).alias("h")).distinct()
    placed = members.join(clusters.withColumnRenamed("node", "h"), "h", "left").select("band", "h", F.coalesce("component", "h").alias("comp"))
    placed = c.stored(placed, "passage-members")
    mixed = placed.groupBy("band").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.count("*").alias("size")).where("c0 < c1 and size > 2")
    mixed = mixed.select("band", F.ceil(F.col("size") / BLOCK).cast("long").alias("blocks"))
    dealt = (
        placed.join(mixed, "band").join(paragraphs.select("h", "n", *SKETCH), "h")
        .withColumn("block", F.pmod(F.xxhash64("h"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select("band", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "h", "comp", "n", *SKETCH)
        .repartition("band", "lo", "hi").sortWithinPartitions("band", "lo", "hi", "block", "h")
    )
    rest = dealt.mapInArrow(_apart, "a long, b long").distinct().join(pairs, ["a", "b"], "left_anti")
    more = _verified(rest, paragraphs, "passage-more")
    if not more.isEmpty():
        clusters = components(links.unionByName(more), "a", "b", "passage")
    return units, clusters.select(F.col("node").alias("h"), F.col("component").alias("comp"))


def _verified(pairs: DataFrame, paragraphs: DataFrame, label: str) -> DataFrame:
    """The (a, b) whose paragraphs are similar."""
    both = pairs.join(paragraphs.select(F.col("h").alias("a"), F.col("paragraph").alias("pa")), "a")
    both = both.join(paragraphs.select(F.col("h").alias("b"), F.col("paragraph").alias("pb")), "b").select("a", "b", "pa", "pb")
    return c.stored(both.mapInArrow(_similar, "a long, b long"), label)


def remove_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_row, id, text, spans, n_duplicated, n_removed) for every row of a stored table.

    ``text`` is what is left, ``spans`` the removed runs in bytes of the old UTF-8 text,
    ``n_duplicated`` the words in duplicated runs of MIN_RUN words or more (the place that stays
    included) and ``n_removed`` the words removed. Words are runs without ASCII white space, A-Z
    lower-cased for comparison only. The place that stays is the first, by row and position. A null
    text stays null, an empty one empty; short texts have no paragraph. Repeated rows repeat each
    other's passages; null and repeated ids do not matter; further columns are ignored. Exact
    repeats of MIN_RUN words are always found, similar paragraphs with the probability above.
    Equal paragraphs are compared once, so a very common one is no hot group.
    """
    rows = c.with_row(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")))
    units, clusters = paragraph_clusters(rows.select("_row", "text"))
    placed = units.join(clusters, "h", "left").withColumn("comp", F.coalesce("comp", "h"))
    keepers = placed.groupBy("comp").agg(F.count("*").alias("n"), F.min(F.struct("_row", "start")).alias("first")).where("n > 1")
    found = placed.join(keepers, "comp").select(
        "_row", F.struct("place", "start", "end", (F.struct("_row", "start") == F.col("first")).alias("stays")).alias("d"))
    found = c.stored(found.groupBy("_row").agg(F.collect_list("d").alias("found")), "passage-found")
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"_row long, _id {kind}, text string, spans array<struct<start:long,end:long>>, n_duplicated long, n_removed long"
    runs = c.stored(repeated_runs(rows.select("_row", "text")), "passage-windows")
    cut = rows.join(found, "_row", "left").join(runs, "_row", "left").select("_row", "text", "found", "_id", "runs")
    return cut.mapInArrow(_cut, schema).withColumnRenamed("_id", id_col)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_passages(c.documents(spark, sf_dir))
    return found.select("doc_id", "n_duplicated", "n_removed", F.size("spans").alias("n_spans"), "text")
