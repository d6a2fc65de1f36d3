"""N-gram Jaccard join with PartEnum signatures.

A document is the set of its distinct shingles, of 3 words unless a rule says otherwise. Two sets
link at Jaccard >= num / den, 9/10 by default. Sets whose sizes may pair share size bands of ratio
den / num; in band t linked sets differ in at most k = floor(2 r (den - num) / (den + num))
shingles, r being the largest size of the band. The hashed shingle domain is cut into
n1 = ceil((k + 1) / 2) parts of three sub-parts. By the pigeonhole rule one part differs in at most
one shingle, so two of its three sub-parts are equal: the three pairs of sub-parts of every part
are the signatures, and linked sets share at least one of them. The third sub-part of that part then
differs in one shingle at most, so its parity sketch, which fills the low bits of a signature, in one
bit: sets that meet with sketches further apart are no candidates of that signature.

Sets of any text meet where both sub-parts of a signature are empty. So there are spare parts, as many
as a set has parts with two empty sub-parts: linked sets then differ in at most one shingle in
spare + 1 parts, and each set leaves out the signatures of empty sub-parts in the first ``spare`` parts that
have them. If all those spare + 1 parts meet in empty sub-parts only, the last is among the first
``spare`` of neither set, so no link is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import common as c
from starloom.llm.components import components

NUM, DEN = 9, 10  # two sets link when DEN * intersection >= NUM * union
SHINGLE = 3
WORDS = 8  # 64-bit words of the parity sketch
THIRD = 24  # low bits of a signature: parity sketch of the sub-part that it leaves out
SPREAD = 256  # different sketches under one signature that are all held against each other at once
HOLD = 1 << 16  # rows of one bucket that are held at once
FINE = 1 << 16  # most bits of the fine sketch
BLOCK = 1024  # members of one bucket that are compared with as many others in one go
LOW = np.uint64((1 << THIRD) - 1)
CODES = c.byte_codes(101)
Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _bands(num: int, den: int, limit: int = 1 << 40) -> np.ndarray:
    low = [1]
    while low[-1] < limit:
        low.append(low[-1] * den // num + 1)
    return np.array(low, np.int64)


@dataclass(frozen=True)
class Rule:
    """Words of a shingle, and the least Jaccard num / den of a link."""

    shingle: int = SHINGLE
    num: int = NUM
    den: int = DEN

    def __post_init__(self) -> None:
        if not (self.shingle >= 1 and 0 < self.num < self.den):
            raise ValueError("a shingle has a word or more, and a threshold lies between 0 and 1")

    @property
    def lows(self) -> np.ndarray:
        """The smallest size of each band."""
        return LOWS if (self.num, self.den) == (NUM, DEN) else _bands(self.num, self.den)

    def spare(self, top: np.ndarray, parts: np.ndarray) -> np.ndarray:
        """Parts with two empty sub-parts of three that the smallest sets under a band have, whose largest have ``top`` shingles."""
        least = top * (self.num / self.den) ** 2
        return (3 * np.exp(-2 / 3 * least / parts) * parts).astype(np.int64) + (parts >= 32)


LOWS = _bands(NUM, DEN)
RULE = Rule()


def shingle_sets(data: np.ndarray, offsets: np.ndarray, pw: c.Powers, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(document, shingle hash) of the distinct shingles of each text, sorted."""
    data = c.lower_ascii(data)
    starts, ends = c.word_bounds(data)
    words = c.word_hashes(data, starts, ends, CODES, pw)
    doc = np.searchsorted(offsets, starts, "right") - 1
    count = np.bincount(doc, minlength=len(offsets) - 1)
    first = np.concatenate(([0], np.cumsum(count)))[:-1]
    place = np.arange(len(words)) - first[doc]
    # shorter texts: the whole sequence, told apart from full shingles by its length
    width = np.minimum(count[doc], shingle)
    begins = place + width <= count[doc]
    at = np.flatnonzero(begins)
    total = width[at].astype(np.uint64)
    multipliers = c.mix(np.arange(11, 11 + shingle, dtype=np.uint64)) | np.uint64(1)
    for i in range(shingle):
        has = width[at] > i
        total[has] += words[at[has] + i] * multipliers[i]
    hashed, doc = c.mix(total), doc[at]
    order = np.lexsort((hashed, doc))
    hashed, doc = hashed[order], doc[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashed[1:] != hashed[:-1])
    return doc[new], hashed[new]


def _sums(doc: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, np.uint64)
    np.add.at(out, doc, values)
    return out


def _signatures(
    doc: np.ndarray, hashed: np.ndarray, band: np.ndarray, use: np.ndarray, whole: np.ndarray, rule: Rule = RULE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, signature, sketch of the third sub-part) under one band for each document in use."""
    top = rule.lows[band] * rule.den // rule.num
    k = (rule.den - rule.num) * 2 * top // (rule.den + rule.num)
    spare = rule.spare(top, k // 2 + 1)
    parts = np.where(use & (k > 0), k // 2 + 1 + spare, 0)
    base = np.concatenate(([0], np.cumsum(parts * 3)))
    mine = parts[doc] > 0
    d, h = doc[mine], hashed[mine]
    cell = (c.mix(h + np.uint64(7)) % (parts[d] * 3).astype(np.uint64)).astype(np.int64)
    sums = np.zeros(base[-1], np.uint64)
    np.add.at(sums, base[d] + cell, c.mix(h ^ np.uint64(0x5BD1E995)))
    sums = sums.reshape(-1, 3)
    bit = (base[d] + cell) * THIRD + (c.mix(h + np.uint64(31)) % np.uint64(THIRD)).astype(np.int64)
    odd = (np.bincount(bit, minlength=base[-1] * THIRD) & 1).astype(bool).reshape(-1, THIRD)
    third = np.packbits(odd, axis=1).astype(np.uint64) @ (np.uint64(1) << np.arange(0, THIRD, 8, dtype=np.uint64))
    third = third.reshape(-1, 3)
    owner = np.repeat(np.arange(len(parts)), parts)
    part = np.arange(len(owner)) - base[owner] // 3
    empty = (np.bincount(base[d] + cell, minlength=base[-1]) == 0).reshape(-1, 3)
    hollow = empty.sum(axis=1) > 1
    before = np.cumsum(hollow) - hollow  # hollow parts of this and all sets before
    left_out = hollow & (before - before[base[owner] // 3] < spare[owner])
    code = (band[owner] * (1 << 34) + part * 4).astype(np.uint64)
    rows = []
    for s, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
        sent = ~(left_out & empty[:, i] & empty[:, j])
        sig = c.mix(sums[:, i] * np.uint64(0xD6E8FEB86659FD93) + c.mix(sums[:, j] + code + np.uint64(s)))
        rows.append((owner[sent], sig[sent], third[sent, 2 - s]))
    alone = np.flatnonzero(use & (k == 0))
    rows.append((alone, c.mix(whole[alone] + band[alone].astype(np.uint64) + np.uint64(3)), np.zeros(len(alone), np.uint64)))
    return tuple(np.concatenate([r[i] for r in rows]) for i in range(3))


def _sizes(doc: np.ndarray, hashed: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Size and hash of each set."""
    n = np.bincount(doc, minlength=docs)
    return n, c.mix(_sums(doc, c.mix(hashed ^ np.uint64(0xA5A5)), docs) + n.astype(np.uint64))


def fine_sketches(doc: np.ndarray, hashed: np.ndarray, n: np.ndarray) -> list[bytes | None]:
    """A parity sketch with a bit or more a shingle of each set that is too large for the fixed sketch.

    Its length is a power of two and a shingle's bit is its hash modulo that length, so a longer
    sketch folds to a shorter one by exclusive or.
    """
    bits = np.where(n > WORDS * 64, 1 << np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64), 0)
    bits = np.minimum(bits, FINE)
    base = np.concatenate(([0], np.cumsum(bits)))
    mine = bits[doc] > 0
    at = base[doc[mine]] + (hashed[mine] >> np.uint64(40)).astype(np.int64) % bits[doc[mine]]
    packed = np.packbits((np.bincount(at, minlength=base[-1]) & 1).astype(bool)).tobytes()
    return [packed[a // 8: b // 8] if b > a else None for a, b in zip(base[:-1].tolist(), base[1:].tolist(), strict=True)]


def set_rows(rule: Rule = RULE) -> Batches:
    """(_row, text) to (_row, n, sid, check, k0 .., fine)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pw = c.Powers()
        for batch in batches:
            for first, data, offsets in c.chunks(batch.column(1)):
                docs = len(offsets) - 1
                doc, hashed = shingle_sets(data, offsets, pw, rule.shingle)
                n, sid = _sizes(doc, hashed, docs)
                check = c.mix(_sums(doc, c.mix(hashed ^ np.uint64(0xC3C3C3)), docs) + n.astype(np.uint64))
                bits = np.bincount(doc * (WORDS * 64) + (hashed >> np.uint64(40)).astype(np.int64) % (WORDS * 64), minlength=docs * WORDS * 64)
                sketch = np.packbits((bits & 1).astype(bool).reshape(docs, -1), axis=1).view(np.int64)
                yield pa.record_batch(
                    [batch.column(0).slice(first, docs), pa.array(n, pa.int64()), pa.array(c.signed(sid)), pa.array(c.signed(check))]
                    + [pa.array(np.ascontiguousarray(sketch[:, i])) for i in range(WORDS)]
                    + [pa.array(fine_sketches(doc, hashed, n), pa.binary())],
                    names=["_row", "n", "sid", "check", *SKETCH, "fine"],
                )

    return run


def signature_rows(rule: Rule = RULE) -> Batches:
    """(text) to (sig, sid): the signatures of each different set of a task, sketches in their low bits."""
    lows = rule.lows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pw, seen = c.Powers(), set()
        for batch in batches:
            for _, data, offsets in c.chunks(batch.column(0)):
                docs = len(offsets) - 1
                doc, hashed = shingle_sets(data, offsets, pw, rule.shingle)
                n, sid = _sizes(doc, hashed, docs)
                fresh = np.zeros(docs, bool)
                for i, s in enumerate(sid.tolist()):
                    if n[i] and s not in seen:
                        seen.add(s)
                        fresh[i] = True
                band = np.maximum(np.searchsorted(lows, n, "right") - 1, 0)
                for use, at in (
                    (fresh, band),
                    # a larger partner may lie in the next band
                    (fresh & (n * rule.den // rule.num >= lows[band + 1]), band + 1),
                ):
                    owner, sig, third = _signatures(doc, hashed, at, use, sid, rule)
                    yield pa.record_batch([pa.array(c.signed(sig & ~LOW | third)), pa.array(c.signed(sid[owner]))], names=["sig", "sid"])

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (sig, sid) to (sig, sid, center) of the sets that may link with another set of their bucket.

    A bucket holds the signatures that are equal but for the sketch. ``center`` is the smallest set
    that comes first with its sketch and whose sketch is near, perhaps the set itself. One pass: of a
    bucket with more than HOLD rows all sets are kept, and only two are held from one part to the next.
    """
    held, wide = None, None
    for batch in batches:
        sig, sid = (np.asarray(batch.column(i)) for i in (0, 1))
        if held is not None:
            sig, sid = np.concatenate((held[0], sig)), np.concatenate((held[1], sid))
        if not len(sig):
            continue
        cut = int(np.searchsorted(sig >> THIRD, sig[-1] >> THIRD))
        if len(sig) - cut > HOLD:
            wide = sig[-1] >> THIRD
            yield _met(sig, sid, wide)
            ends = [cut, int(np.searchsorted(sig, sig[-1]))]
            held = sig[ends], sid[ends]
        else:
            yield _met(sig[:cut], sid[:cut], wide)
            held = sig[cut:], sid[cut:]
    if held is not None:
        yield _met(*held, wide)


def _met(sig: np.ndarray, sid: np.ndarray, wide: int | None) -> pa.RecordBatch:
    """``_shared`` of whole buckets, or of a part of the bucket ``wide``."""
    new = np.ones(len(sig), bool)
    new[1:] = (sig[1:] != sig[:-1]) | (sid[1:] != sid[:-1])
    sig, sid = sig[new], sid[new]
    bucket = sig >> THIRD
    alone = np.ones(len(sig) + 1, bool)
    alone[1:-1] = bucket[1:] != bucket[:-1]
    several = ~(alone[1:] & alone[:-1])
    if wide is not None:
        several |= bucket == wide
    sig, sid = sig[several], sid[several]
    # one leader for each sketch of a bucket
    lead = np.flatnonzero(np.append(True, sig[1:] != sig[:-1])) if len(sig) else np.zeros(0, np.int64)
    mark, center = sig[lead], sid[lead].copy()
    near = np.diff(np.append(lead, len(sig))) > 1
    d = 1
    while d < len(mark) and (same := mark[d:] >> THIRD == mark[:-d] >> THIRD).any():
        if d > SPREAD:
            near |= np.isin(mark >> THIRD, mark[d:][same] >> THIRD)
            break
        i = np.flatnonzero(same & (_apart(mark[d:], mark[:-d]) <= 1))
        near[i] = near[i + d] = True
        center[i] = np.minimum(center[i], sid[lead[i + d]])
        center[i + d] = np.minimum(center[i + d], sid[lead[i]])
        d += 1
    if wide is not None:
        near |= mark >> THIRD == wide
    group = np.repeat(np.arange(len(lead)), np.diff(np.append(lead, len(sig))))
    met = near[group]
    return pa.record_batch([pa.array(x[met]) for x in (sig, sid, center[group])], names=["sig", "sid", "center"])


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bits in which the sketches of signatures differ."""
    return np.bitwise_count((x ^ y) & np.int64(LOW))


SKETCH = [f"k{i}" for i in range(WORDS)]
SET_SCHEMA = "_row long, n long, sid long, check long, " + ", ".join(f"{k} long" for k in SKETCH) + ", fine binary"


def _near(na, nb, distance, rule: Rule):
    """What holds for every linked pair: sizes within the threshold, and few sketch bits apart.

    Each shingle that only one set has turns one bit, so bits apart never exceed those shingles.
    """
    return (rule.den * F.least(na, nb) >= rule.num * F.greatest(na, nb)) & (distance * (rule.den + rule.num) <= (na + nb) * (rule.den - rule.num))


def _pruned(pairs: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """(a, b, row_a, row_b, apart) of the pairs that may link; ``apart`` counts the sketch bits they differ in."""
    for side in "ab":
        pairs = pairs.join(
            nodes.select(F.col("sid").alias(side), F.col("n").alias(f"n{side}"), F.col("rep").alias(f"row_{side}"),
                         *[F.col(k).alias(f"{side}{k}") for k in SKETCH]), side)
    apart = sum((F.bit_count(F.col(f"a{k}").bitwiseXOR(F.col(f"b{k}"))) for k in SKETCH), F.lit(0))
    return pairs.withColumn("apart", apart.cast("long")).where(_near(F.col("na"), F.col("nb"), F.col("apart"), rule)).select("a", "b", "row_a", "row_b", "apart")


def _finer(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b, row_a, row_b, apart) that the fine sketches of two large sets leave, which never reject a link."""
    for side in "ab":
        fine = sets.select(F.col("_row").alias(f"row_{side}"), F.col("n").alias(f"n{side}"), F.col("fine").alias(f"f{side}"))
        pairs = pairs.join(fine, f"row_{side}")
    wanted = ["a", "b", "row_a", "row_b", "apart"]
    return pairs.select(*wanted, "na", "nb", "fa", "fb").mapInArrow(_fine(rule), "a long, b long, row_a long, row_b long, apart long")


def _fine(rule: Rule) -> Batches:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            limit = (np.asarray(batch.column(5)) + np.asarray(batch.column(6))) * (rule.den - rule.num) // (rule.den + rule.num)
            good = np.ones(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column(7), batch.column(8), strict=True)):
                if x.is_valid and y.is_valid:
                    x, y = (np.frombuffer(v.as_buffer(), np.uint8) for v in (x, y))
                    width = min(len(x), len(y))
                    x, y = (np.bitwise_xor.reduce(v.reshape(-1, width), axis=0) for v in (x, y))
                    good[i] = int(np.bitwise_count(x ^ y).sum()) <= limit[i]
            yield batch.select(range(5)).filter(pa.array(good)).cast(pa.schema([(k, pa.int64()) for k in ("a", "b", "row_a", "row_b", "apart")]))

    return run


def _parted(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """The pairs whose sets are in different components, ``ca`` and ``cb``."""
    for side in "ab":
        pairs = pairs.join(comps.select(F.col("node").alias(side), F.col("component").alias(f"c{side}")), side, "left")
        pairs = pairs.withColumn(f"c{side}", F.coalesce(f"c{side}", side))
    return pairs.where("ca != cb")


def _nearest(pairs: DataFrame, *keys: str) -> DataFrame:
    """For each key the pair whose sketches are least apart."""
    best = pairs.groupBy(*keys).agg(F.min(F.struct("apart", "a", "b", "row_a", "row_b")).alias("p"))
    return best.select("p.a", "p.b", "p.row_a", "p.row_b")


def _star_links(star: DataFrame, texts: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """(links, components) of the pairs with centers, without reading texts for pairs inside a component.

    First each set with its nearest center, then one pair for any two components that still have
    one, last every pair between different components that was not yet read.
    """
    tried = c.stored(_nearest(star, "b"), "jaccard-near")
    links = _links(tried, texts, "jaccard-near", rule)
    comps = components(links, "a", "b", "jaccard")
    for last in (False, True):
        left = c.stored(_parted(star.join(tried.select("a", "b"), ["a", "b"], "left_anti"), comps), "jaccard-left")
        if left.isEmpty():
            break
        if not last:
            left = c.stored(_nearest(left.withColumn("low", F.least("ca", "cb")).withColumn("high", F.greatest("ca", "cb")), "low", "high"), "jaccard-bridges")
            tried = tried.unionByName(left)
        more = _links(left.select("a", "b", "row_a", "row_b"), texts, "jaccard-bridges", rule)
        links = links.unionByName(more)
        comps = components(links, "a", "b", "jaccard")
    return links, comps


def _links(pairs: DataFrame, texts: DataFrame, label: str, rule: Rule) -> DataFrame:
    """The pairs (a, b, row_a, row_b) whose sets link, from the whole texts."""
    pairs = c.stored(pairs, f"{label}-pairs")
    needed = pairs.select(F.explode(F.array("row_a", "row_b")).alias("_row")).distinct()
    used = c.stored(texts.join(needed, "_row", "left_semi"), f"{label}-texts")
    for side in "ba":
        pairs = pairs.join(used.select(F.col("_row").alias(f"row_{side}"), F.col("text").alias(f"text_{side}")), f"row_{side}")
    return c.stored(pairs.select("a", "b", "text_a", "text_b").mapInArrow(_verified(rule), "a long, b long"), f"{label}-links")


def _verified(rule: Rule) -> Batches:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pw = c.Powers()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                a, b = (np.asarray(part.column(i)) for i in (0, 1))
                nodes, place = np.unique(np.concatenate((a, b)), return_index=True)
                both = pa.chunked_array([part.column(2), part.column(3)]).take(pa.array(place)).combine_chunks()
                sets: dict[int, np.ndarray] = {}
                for first, data, offsets in c.chunks(both):
                    doc, hashed = shingle_sets(data, offsets, pw, rule.shingle)
                    cuts = np.searchsorted(doc, np.arange(len(offsets)))
                    for i in range(len(offsets) - 1):
                        sets[int(nodes[first + i])] = hashed[cuts[i]: cuts[i + 1]]
                good = np.zeros(len(a), bool)
                for i, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
                    common = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                    good[i] = rule.den * common >= rule.num * (len(sets[x]) + len(sets[y]) - common)
                yield pa.record_batch([pa.array(a[good]), pa.array(b[good])], names=["a", "b"])

    return run


def _bucket_pairs(rule: Rule) -> Batches:
    """Rows sorted by (bucket, lo, hi): pairs of different components that may link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, np.ndarray] = {}
        for batch in batches:
            got = {name: np.asarray(batch.column(name)) for name in batch.schema.names}
            if kept:
                got = {k: np.concatenate((kept[k], v)) for k, v in got.items()}
            change = (got["bucket"] != got["bucket"][-1]) | (got["lo"] != got["lo"][-1]) | (got["hi"] != got["hi"][-1])
            cut = int(np.flatnonzero(change)[-1]) + 1 if change.any() else 0
            kept = {k: v[cut:] for k, v in got.items()}
            if cut:
                yield _compared({k: v[:cut] for k, v in got.items()}, rule)
        if kept:
            yield _compared(kept, rule)

    return run


def _compared(g: dict[str, np.ndarray], rule: Rule) -> pa.RecordBatch:
    sketch = np.stack([g[k] for k in SKETCH], axis=1).view(np.uint64)
    same = lambda d: (g["bucket"][d:] == g["bucket"][:-d]) & (g["lo"][d:] == g["lo"][:-d]) & (g["hi"][d:] == g["hi"][:-d])
    found, d = [], 1
    while d < len(g["bucket"]) and (near := same(d)).any():
        i = np.flatnonzero(near & (g["comp"][d:] != g["comp"][:-d]) & ((g["block"][d:] != g["block"][:-d]) | (g["lo"][d:] == g["hi"][d:])))
        i = i[_apart(g["sig"][i], g["sig"][i + d]) <= 1]
        na, nb = g["n"][i], g["n"][i + d]
        i = i[rule.den * np.minimum(na, nb) >= rule.num * np.maximum(na, nb)]
        apart = np.bitwise_count(sketch[i] ^ sketch[i + d]).sum(axis=1, dtype=np.int64)
        i = i[apart * (rule.den + rule.num) <= (g["n"][i] + g["n"][i + d]) * (rule.den - rule.num)]
        x, y = g["sid"][i], g["sid"][i + d]
        found.append(np.stack((np.minimum(x, y), np.maximum(x, y)), axis=1))
        d += 1
    pairs = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)
    return pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Rule = RULE) -> DataFrame:
    """(_row, id, n_shingles, class_row, component_id) for every row of a stored table.

    Words are runs without ASCII white space, A-Z lower-cased. Two rows link when the Jaccard of their
    sets of ``rule.shingle`` words is ``rule.num / rule.den`` or more; rows with equal sets always do. ``component_id`` is the smallest id reachable by links,
    ``class_row`` the row it belongs to (smallest row among equal ids). A null text, or one without
    words, has no shingles and is linked with nothing; a text shorter than a shingle is one shingle.
    Repeated rows and repeated or null ids stay rows of their own; a null id ranks last. Further
    columns are ignored. No row is dropped and no bucket is capped.

    Candidates are first the pairs of each bucket's members with a smaller set whose signature sketch is near, nearest by sketch first; members of
    different components that share a bucket follow, in blocks. Both are held against a parity
    sketch that never rejects a link, then verified on whole texts. Pairs inside a component
    are not needed for the classes.
    """
    rows = c.with_row(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")))
    texts = rows.select("_row", "text")
    sets = c.stored(texts.mapInArrow(set_rows(rule), SET_SCHEMA), "jaccard-sets")
    nodes = c.stored(
        sets.where("n > 0").groupBy("sid").agg(
            F.min("_row").alias("rep"), F.max("n").alias("n"), (F.min("check") != F.max("check")).alias("clash"),
            *[F.min(k).alias(k) for k in SKETCH]), "jaccard-nodes")
    if not nodes.where("clash").isEmpty():
        raise ValueError("two different shingle sets share a 64-bit hash; change the codes")
    # one shuffle of signatures, which are not stored; a set that many rows of a task have is sent once
    signed = texts.select("text").mapInArrow(signature_rows(rule), "sig long, sid long")
    bucket = F.shiftright("sig", THIRD)
    sorted_by = signed.repartition(bucket).sortWithinPartitions("sig", "sid")
    members = c.stored(sorted_by.mapInArrow(_shared, "sig long, sid long, center long"), "jaccard-members")

    star = members.where("center < sid").select(F.col("center").alias("a"), F.col("sid").alias("b")).distinct()
    star = c.stored(_finer(_pruned(star, nodes, rule), sets, rule), "jaccard-star")
    links, comps = _star_links(star, texts, rule)

    placed = members.join(comps.withColumnRenamed("node", "sid"), "sid", "left").select(
        bucket.alias("bucket"), "sig", "sid", F.coalesce("component", "sid").alias("comp"))
    mixed = placed.groupBy("bucket").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.count("*").alias("size")).where("c0 < c1")
    mixed = mixed.select("bucket", F.ceil(F.col("size") / BLOCK).cast("long").alias("blocks"))
    dealt = (
        placed.join(mixed, "bucket").join(nodes.select("sid", "n", *SKETCH), "sid")
        .withColumn("block", F.pmod(F.xxhash64("sid"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select("bucket", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "sig", "sid", "comp", "n", *SKETCH)
        .repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi", "block", "sid")
    )
    rest = dealt.mapInArrow(_bucket_pairs(rule), "a long, b long").distinct()
    rest = rest.join(star.select("a", "b"), ["a", "b"], "left_anti")
    for side in "ab":
        rest = rest.join(nodes.select(F.col("sid").alias(side), F.col("rep").alias(f"row_{side}")), side)
    rest = _finer(rest.withColumn("apart", F.lit(0).cast("long")), sets, rule)
    more = _links(rest.select("a", "b", "row_a", "row_b"), texts, "jaccard-rest", rule)
    if not more.isEmpty():
        comps = components(links.unionByName(more), "a", "b", "jaccard")

    own = sets.select("_row", "n", "sid").join(rows.select("_row", "_id"), "_row")
    own = own.join(comps.withColumnRenamed("node", "sid"), "sid", "left").withColumn("comp", F.coalesce("component", "sid"))
    own = c.stored(own.select("_row", "_id", "n", "comp"), "jaccard-own")
    # smallest (id, row) of each class, null ids last
    least = own.where("n > 0").groupBy("comp").agg(F.min(F.struct(F.col("_id").isNull().alias("void"), "_id", "_row")).alias("m"))
    least = least.select("comp", F.col("m._id").alias("class_id"), F.col("m._row").alias("class_row"))
    return own.join(least, "comp", "left").select(
        "_row", F.col("_id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("class_row")).otherwise(F.col("_row")).alias("class_row"),
        F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("_id")).alias("component_id"))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_classes(c.documents(spark, sf_dir))
    return found.select("doc_id", "n_shingles", "component_id")
