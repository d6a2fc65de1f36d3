"""Repeated byte strings, by a hash-compared suffix sort.

Every 200-byte window of a text belongs to the anchor inside it: the leftmost of its 100-byte grams
with the least hash. Equal windows have equal anchors at equal offsets, so windows are dealt to
tasks by anchor, as the stretch of text that the windows of one anchor cover. Stretches seen once
are done, and equal stretches are one. What is left, different stretches around one anchor, is
suffix-sorted: prefix polynomial hashes and binary search find the common extension of two
suffixes, a mergesort orders them by it, and neighbours with 200 common bytes are verified byte by
byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import common as c

LENGTH = 200
GRAM = 100
CODES = c.byte_codes(707)
SEGMENT = 1 << 20  # window starts of one text that are looked at together
CROWD = 1024  # stretches of one anchor that are sorted in one task; anchors with more count window hashes
SORTED_AT_ONCE = 2048


def _pieces(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row of each piece, its place in its text, its place in data, data), a bounded number of bytes at a time.

    A text is cut into pieces that overlap by LENGTH - 1 bytes: each window lies in one piece.
    """
    rows, places, parts, size = [], [], [], 0

    def out():
        ends = np.cumsum([len(p) for p in parts])
        begin = np.concatenate(([0], ends))
        return np.array(rows), np.array(places), begin, np.frombuffer(b"".join(parts), np.uint8)

    for i, scalar in enumerate(column.cast(pa.large_binary())):
        text = scalar.as_py() or b""
        for at in range(0, max(0, len(text) - LENGTH + 1), SEGMENT):
            part = text[at: at + SEGMENT + LENGTH - 1]
            if parts and size + len(part) > SEGMENT + LENGTH:
                yield out()
                rows, places, parts, size = [], [], [], 0
            rows.append(i)
            places.append(at)
            parts.append(part)
            size += len(part)
    if parts:
        yield out()


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    step = 1
    while step * 2 <= width:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    rest = width - step
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_row, text) to one row per anchor: its stretch's first window, number of windows, and hashes.

    Neighbouring equal stretches (text with a short period) come as one row with ``times`` of them.
    """
    pw = c.Powers()
    for batch in batches:
        for rows, places, begin, data in _pieces(batch.column(1)):
            up, down = pw.to(len(data) + 1)
            prefix = c.prefix_hashes(data, CODES, up)
            grams = c.mix((prefix[GRAM:] - prefix[:-GRAM]) * down[: len(data) - GRAM + 1])
            packed = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
            anchor = (_sliding_min(packed, LENGTH - GRAM + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
            starts = np.arange(len(anchor))
            piece = np.searchsorted(begin, starts, "right") - 1
            inside = starts + LENGTH <= begin[piece + 1]
            new = np.ones(len(anchor), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1])
            a = np.flatnonzero(new & inside)
            edge = np.flatnonzero(new | ~inside)
            stop = np.append(edge, len(anchor))[np.searchsorted(edge, a) + 1]
            n = stop - a
            p = anchor[a]
            ctx = c.mix((prefix[a + n + LENGTH - 1] - prefix[a]) * down[a] + (p - a).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + n.astype(np.uint64))
            key, piece = grams[p], piece[a]
            first = np.ones(len(a), bool)
            first[1:] = (key[1:] != key[:-1]) | (ctx[1:] != ctx[:-1]) | (piece[1:] != piece[:-1])
            f = np.flatnonzero(first)
            times = np.diff(np.append(f, len(a)))
            a, n, p, key, ctx, piece = (x[f] for x in (a, n, p, key, ctx, piece))
            yield pa.record_batch(
                [batch.column(0).take(pa.array(rows[piece])), pa.array(places[piece] + a - begin[piece]), pa.array(n.astype(np.int32)),
                 pa.array((p - a).astype(np.int32)), pa.array(times.astype(np.int32)), pa.array(c.signed(key)), pa.array(c.signed(ctx))],
                names=["_row", "a", "n", "j", "times", "key", "ctx"])


def stretch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, list of wanted stretches) to one row per stretch with its bytes."""
    names = ["key", "ctx", "copies", "a", "n", "j"]
    for batch in batches:
        for i in range(batch.num_rows):
            text = batch.column(0)[i].as_py().encode()
            wanted = batch.column(1).slice(i, 1).flatten()
            for at in range(0, len(wanted), 4096):
                part = dict(zip(names, wanted.slice(at, 4096).flatten(), strict=True))
                a, n = np.asarray(part["a"]), np.asarray(part["n"])
                cut = [text[x: x + w + LENGTH - 1] for x, w in zip(a.tolist(), n.tolist(), strict=True)]
                yield pa.record_batch([part["key"], part["ctx"], part["copies"], part["n"], part["j"], pa.array(cut, pa.binary())],
                                      names=["key", "ctx", "copies", "n", "j", "bytes"])


class Suffixes:
    """Suffixes of a byte buffer, compared over their first LENGTH bytes by hashes."""

    def __init__(self, data: np.ndarray, pw: c.Powers) -> None:
        up, self.down = pw.to(len(data) + 1)
        self.data, self.prefix = data, c.prefix_hashes(data, CODES, up)

    def _hash(self, at: np.ndarray, n) -> np.ndarray:
        return (self.prefix[at + n] - self.prefix[at]) * self.down[at]

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Bytes that the suffixes at x and y share, LENGTH at most."""
        low, high = np.zeros(len(x), np.int64), np.full(len(x), LENGTH)
        same = self._hash(x, LENGTH) == self._hash(y, LENGTH)
        low[same] = LENGTH
        at = np.flatnonzero(~same)
        x, y, lo, hi = x[at], y[at], low[at], high[at] - 1
        while len(at) and (lo < hi).any():
            mid = (lo + hi + 1) // 2
            good = self._hash(x, mid) == self._hash(y, mid)
            lo, hi = np.where(good, mid, lo), np.where(good, hi, mid - 1)
        low[at] = lo
        return low

    def before(self, x: np.ndarray, y: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        shared = self.common(x, y)
        inner = np.minimum(shared, LENGTH - 1)
        return np.where(shared == LENGTH, or_equal, self.data[x + inner] < self.data[y + inner])

    def sort(self, at: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Sorts the suffixes of each segment at[begin[i]: begin[i + 1]] by a bottom-up mergesort."""
        at = at.copy()
        size = np.diff(begin)
        width = 1
        while (active := np.flatnonzero(size > width)).size:
            seg = np.repeat(active, size[active])
            rank = np.arange(len(seg)) - np.repeat(np.cumsum(size[active]) - size[active], size[active])
            home = rank - rank % (2 * width)
            left = rank - home < width
            low = np.where(left, np.minimum(home + width, size[seg]), home)
            high = np.where(left, np.minimum(home + 2 * width, size[seg]), home + width)
            base, first = begin[seg], low.copy()
            mine = at[base + rank]
            # how many of the other run come before: less for the left run, less or equal for the right
            open_ = np.flatnonzero(low < high)
            while open_.size:
                mid = (low[open_] + high[open_]) // 2
                ahead = self.before(at[base[open_] + mid], mine[open_], ~left[open_])
                low[open_] = np.where(ahead, mid + 1, low[open_])
                high[open_] = np.where(ahead, high[open_], mid)
                open_ = open_[low[open_] < high[open_]]
            own = np.where(left, rank - home, rank - home - width)
            at[base + home + own + (low - first)] = mine
            width *= 2
        return at

    def equal_bytes(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        view = np.lib.stride_tricks.sliding_window_view(self.data, LENGTH)
        out = np.ones(len(x), bool)
        for i in range(0, len(x), 1 << 16):
            out[i: i + (1 << 16)] = (view[x[i: i + (1 << 16)]] == view[y[i: i + (1 << 16)]]).all(axis=1)
        return out


def repeated_windows(key: np.ndarray, n: np.ndarray, j: np.ndarray, stretches: list[bytes], pw: c.Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(stretch, window in it, whether another stretch of the key has it) for every window."""
    lengths = np.array([len(s) for s in stretches])
    place = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    suffixes = Suffixes(np.frombuffer(b"".join(stretches), np.uint8), pw)
    stretch = np.repeat(np.arange(len(n)), n)
    window = np.arange(len(stretch)) - np.repeat(np.cumsum(n) - n, n)
    _, group = np.unique(key, return_inverse=True)
    # equal windows have their anchor at the same offset
    segment = group[stretch] * (LENGTH + 1) + j[stretch] - window
    order = np.argsort(segment, kind="stable")
    stretch, window, segment = stretch[order], window[order], segment[order]
    begin = np.append(np.flatnonzero(np.append(True, segment[1:] != segment[:-1])), len(segment))
    at = place[stretch] + window
    done = suffixes.sort(at, begin)
    back = np.empty(int(lengths.sum()), np.int64)
    back[at] = np.arange(len(at))
    same_segment = segment[1:] == segment[:-1]
    twin = np.flatnonzero(same_segment)
    twin = twin[suffixes.common(done[twin], done[twin + 1]) == LENGTH]
    equal = suffixes.equal_bytes(done[twin], done[twin + 1])
    repeated = np.zeros(len(at), bool)
    repeated[back[done[twin[equal]]]] = repeated[back[done[twin[equal] + 1]]] = True
    for s in np.unique(segment[twin[~equal]]).tolist():  # hashes collided: group these by their bytes
        mine = np.flatnonzero(segment == s)
        seen: dict[bytes, list[int]] = {}
        for i in mine.tolist():
            seen.setdefault(suffixes.data[at[i]: at[i] + LENGTH].tobytes(), []).append(i)
        repeated[mine] = False
        repeated[[i for same in seen.values() if len(same) > 1 for i in same]] = True
    return stretch, window, repeated


def _ranges(stretch: np.ndarray, window: np.ndarray, n: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """List offsets per stretch, and [first, end) of its runs of windows; rows in any order."""
    order = np.lexsort((window, stretch))
    stretch, window = stretch[order], window[order]
    new = np.ones(len(stretch), bool)
    new[1:] = (stretch[1:] != stretch[:-1]) | (window[1:] != window[:-1] + 1)
    first = np.flatnonzero(new)
    end = window[np.append(first[1:], len(stretch)) - 1] + 1 if len(first) else window[:0]
    ends = np.concatenate(([0], np.cumsum(np.bincount(stretch[first], minlength=n))))
    return ends, [window[first], end]


def sorted_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches sorted by key to (key, ctx, ranges of repeated windows)."""
    pw = c.Powers()
    kept: list[pa.RecordBatch] = []
    held = 0

    def judged(table: pa.Table) -> pa.RecordBatch:
        key, n, j, copies = (np.asarray(table[x].combine_chunks()) for x in ("key", "n", "j", "copies"))
        stretch, window, repeated = repeated_windows(key, n, j, table["bytes"].to_pylist(), pw)
        repeated |= (copies > 1)[stretch]
        ends, (first, end) = _ranges(stretch[repeated], window[repeated], len(n))
        ranges = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(first), pa.array(end)], ["lo", "hi"]))
        return pa.record_batch([table["key"].combine_chunks(), table["ctx"].combine_chunks(), ranges], names=["key", "ctx", "ranges"])

    for batch in batches:
        kept.append(batch)
        held += batch.num_rows
        if held < SORTED_AT_ONCE:
            continue
        table = pa.Table.from_batches(kept)
        keys = table["key"].to_numpy()
        change = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        cut, last = 0, 0
        for at in change.tolist():
            if at - last >= SORTED_AT_ONCE:
                yield judged(table.slice(last, at - last))
                last = at
            cut = at
        if cut > last:
            yield judged(table.slice(last, cut - last))
        rest = table.slice(max(cut, last))
        kept, held = rest.to_batches(), rest.num_rows
    if held:
        yield judged(pa.Table.from_batches(kept))


def window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of crowded anchors to one row per window, with two independent hashes."""
    pw, other = c.Powers(), c.byte_codes(909)
    for batch in batches:
        for lo in range(0, batch.num_rows, 4096):
            part = batch.slice(lo, 4096)
            stretches = part.column("bytes").to_pylist()
            n, j, copies = (np.asarray(part.column(x)) for x in ("n", "j", "copies"))
            data = np.frombuffer(b"".join(stretches), np.uint8)
            place = np.concatenate(([0], np.cumsum([len(s) for s in stretches])))[:-1]
            up, down = pw.to(len(data) + 1)
            stretch = np.repeat(np.arange(len(n)), n)
            window = np.arange(len(stretch)) - np.repeat(np.cumsum(n) - n, n)
            at = place[stretch] + window
            hashes = []
            for codes in (CODES, other):
                prefix = c.prefix_hashes(data, codes, up)
                hashes.append(c.signed(c.mix((prefix[at + LENGTH] - prefix[at]) * down[at])))
            take = pa.array(stretch)
            yield pa.record_batch(
                [part.column("key").take(take), part.column("ctx").take(take), pa.array(copies[stretch]), pa.array(window),
                 pa.array((j[stretch] - window).astype(np.int32)), *map(pa.array, hashes)],
                names=["key", "ctx", "copies", "w", "j", "h", "g"])


def cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_row, text, ranges of repeated window starts, id) to the maximal removed byte runs and what is kept."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 512):
            part = batch.slice(lo, 512)
            texts, kept, spans = c.texts_of(part.column(1)), [], []
            for text, found in zip(texts, part.column(2), strict=True):
                runs: list[list[int]] = []
                if found.is_valid and len(found.values):
                    ranges = np.stack([np.asarray(f) for f in found.values.flatten()], axis=1)
                    ranges = ranges[np.argsort(ranges[:, 0])]
                    stop = np.maximum.accumulate(ranges[:, 1] + LENGTH - 1)
                    new = np.flatnonzero(np.append(True, ranges[1:, 0] > stop[:-1]))
                    runs = [[s, e] for s, e in zip(ranges[new, 0].tolist(), stop[np.append(new[1:], len(stop)) - 1].tolist(), strict=True)]
                left = [0] + [e for _, e in runs]
                right = [s for s, _ in runs] + [len(text)]
                kept.append(b"".join(text[x:y] for x, y in zip(left, right, strict=True)))
                spans.append([{"start": s, "end": e} for s, e in runs])
            yield pa.record_batch(
                [part.column(0), part.column(3), pa.array([len(t) for t in texts], pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                 pa.array(kept, pa.binary())], names=["_row", "_id", "n_bytes", "spans", "kept"])


def _crowded(stretches: DataFrame) -> DataFrame:
    """The verdict on anchors with many different stretches, by counted window hashes.

    Counts combine before the shuffle, so one anchor may hold any share of all rows. A second hash
    verifies each class of equal windows.
    """
    windows = stretches.mapInArrow(window_rows, "key long, ctx long, copies long, w long, j int, h long, g long")
    twice = windows.groupBy("key", "j", "h").agg(F.sum("copies").alias("copies"), F.min("g").alias("g0"), F.max("g").alias("g1"))
    twice = twice.where("copies > 1").select("key", "j", "h", F.when(F.col("g0") == F.col("g1"), True).otherwise(
        F.raise_error(F.lit("two windows share a 64-bit hash; change the codes"))).alias("sure"))
    found = windows.join(twice, ["key", "j", "h"]).where("sure")
    return found.groupBy("key", "ctx").agg(F.transform(F.collect_list("w"), lambda w: F.struct(w.alias("lo"), (w + 1).alias("hi"))).alias("ranges"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_row, id, n_bytes, spans, kept) for every row of a stored table.

    A byte is removed when a 200-byte string that covers it starts anywhere else, in the same text
    or another row's. ``spans`` are the maximal removed runs [start, end) in bytes of the UTF-8
    text, ``kept`` the other bytes in order (an edge may lie inside a character). A null text
    counts as empty; texts under 200 bytes keep everything. Repeated rows are repeats of each
    other. Ids may be null or repeated and further columns are ignored. Strings are judged on the
    input, over whole texts of any length.
    """
    rows = c.with_row(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")))
    texts = rows.select("_row", "text")
    anchors = c.stored(texts.mapInArrow(anchor_rows, "_row long, a long, n int, j int, times int, key long, ctx long"), "repeat-anchors")
    keys = anchors.groupBy("key").agg(F.sum("times").alias("seen"), F.min("ctx").alias("c0"), F.max("ctx").alias("c1"))
    keys = keys.where("seen > 1").select("key", (F.col("c0") < F.col("c1")).alias("mixed"))
    hits = c.stored(anchors.join(keys, "key"), "repeat-hits")

    each = hits.where("mixed").groupBy("key", "ctx").agg(
        F.sum("times").alias("copies"), F.min(F.struct("_row", "a", "n", "j")).alias("at"))
    wanted = each.select("at._row", F.struct("key", "ctx", "copies", "at.a", "at.n", "at.j").alias("s")).groupBy("_row").agg(F.collect_list("s").alias("wanted"))
    stretches = c.stored(
        texts.join(wanted, "_row").select("text", "wanted").mapInArrow(
            stretch_rows, "key long, ctx long, copies long, n int, j int, bytes binary"), "repeat-stretches")
    crowd = c.stored(stretches.groupBy("key").count().where(F.col("count") > CROWD).select("key"), "repeat-crowds")
    few = stretches.join(crowd, "key", "left_anti").repartition("key").sortWithinPartitions("key")
    verdict = few.mapInArrow(sorted_rows, "key long, ctx long, ranges array<struct<lo:long,hi:long>>")
    if not crowd.isEmpty():
        verdict = verdict.unionByName(_crowded(stretches.join(crowd, "key", "left_semi")))
    verdict = c.stored(verdict.where(F.size("ranges") > 0), "repeat-verdict")

    plain = hits.where(~F.col("mixed")).select("_row", F.col("a").alias("lo"), (F.col("a") + F.col("n") * F.col("times")).alias("hi"))
    judged = hits.where("mixed").join(verdict, ["key", "ctx"]).select("_row", "a", "n", "times", F.explode("ranges").alias("r")).select(
        "_row", (F.col("a") + F.col("r.lo")).alias("lo"),
        F.when(F.col("times") > 1, F.col("a") + F.col("n") * F.col("times")).otherwise(F.col("a") + F.col("r.hi")).alias("hi"))
    found = plain.unionByName(judged).groupBy("_row").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    cut = rows.join(found, "_row", "left").select("_row", "text", "ranges", "_id")
    kind = docs.schema[id_col].dataType.simpleString()
    done = cut.mapInArrow(cut_rows, f"_row long, _id {kind}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
    return done.withColumnRenamed("_id", id_col)


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(c.documents(spark, sf_dir))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
