"""Language-model scores: a hashed maximum-entropy model with a class-factored softmax.

P(token | history) = P(class | history) * P(token | class). The class is predicted by a softmax over
hashed features of the history: the word before, the two words before, the word before that one
alone (a skip) and the classes of both. Frequent words and the end of a text are classes of their
own; other words fall into classes by their last two bytes, so an unseen word has a class too. Inside
a class a token has its smoothed share of the training tokens, and an unseen word the share that
the smoothing leaves it. Weights are trained by distributed gradient updates over all training
texts: in each of ROUNDS rounds the tasks make stochastic steps on their part of all texts, and the
changes of every row of weights are averaged over the tasks that touched it. Only the class factor
is a maximum-entropy model; the share inside a class does not depend on the history.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import common as c

CLASSES = 64
OWN_CLASS = 31  # frequent words that are a class of their own
SUFFIX_FIRST = 1 + OWN_CLASS
WORD_BITS, PAIR_BITS, SKIP_BITS = 14, 14, 13
FIRST_ROW = np.cumsum([0, 1 << WORD_BITS, 1 << PAIR_BITS, 1 << SKIP_BITS, CLASSES * CLASSES])
ROWS = int(FIRST_ROW[-1])
BLOCK = 64  # rows of weights that travel together
KNOWN = 1 << 18  # at most so many frequent training words whose counts every task holds; the rest are joined
SMOOTH = 0.1
ROUNDS = 3
STEP = 16_384  # tokens of one gradient step
RATE = 0.5
CODES = c.byte_codes(808)
END = np.uint64(0xE0D)


@dataclass
class Vocabulary:
    """What every task holds of the training counts; its size has a fixed bound."""

    hashes: np.ndarray  # of the KNOWN most frequent words, sorted
    counts: np.ndarray
    own: np.ndarray  # hashes of the words that are classes, sorted
    own_class: np.ndarray
    mass: np.ndarray  # smoothed tokens of each class
    tokens: int
    types: int
    ends: int

    @property
    def bias(self) -> np.ndarray:
        return np.log(self.mass / self.mass.sum()).astype(np.float32)


def suffix_class(before_last: np.ndarray, last: np.ndarray) -> np.ndarray:
    code = before_last.astype(np.uint64) << np.uint64(8) | last.astype(np.uint64)
    return (c.mix(code + np.uint64(5)) % np.uint64(CLASSES - SUFFIX_FIRST)).astype(np.int64) + SUFFIX_FIRST


def hashes_of(words: list[bytes]) -> np.ndarray:
    """The hash of each word, as in a text."""
    if not words:
        return np.zeros(0, np.uint64)
    data = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    return c.word_hashes(data, *c.word_bounds(data), CODES, c.Powers())


@dataclass
class Tokens:
    """The tokens of a chunk of texts in a row, each text closed by its end."""

    doc: np.ndarray
    hashed: np.ndarray
    classes: np.ndarray
    starts: np.ndarray  # byte span of each word, in order
    ends: np.ndarray
    word_at: np.ndarray  # place of each word among the tokens
    end_at: np.ndarray

    def features(self) -> np.ndarray:
        """Rows of weights of each token's history, one line per feature."""
        before = np.append(END, self.hashed[:-1])
        before2 = np.append(END, before[:-1])
        class1 = np.append(0, self.classes[:-1])
        class2 = np.append(0, class1[:-1])
        first = np.append(0, self.end_at[:-1] + 1)  # at the start of a text the history is all ends
        before2[first], class2[first] = END, 0
        cut = lambda x, bits: (x >> np.uint64(64 - bits)).astype(np.int64)
        columns = [
            cut(c.mix(before + np.uint64(1)), WORD_BITS), cut(c.mix(before + c.mix(before2 + np.uint64(2))), PAIR_BITS),
            cut(c.mix(before2 + np.uint64(3)), SKIP_BITS), class1 * CLASSES + class2]
        return np.stack([x + at for x, at in zip(columns, FIRST_ROW, strict=False)])


def tokens_of(data: np.ndarray, offsets: np.ndarray, vocabulary: Vocabulary, pw: c.Powers) -> Tokens:
    """``data`` is lower-cased already."""
    starts, ends = c.word_bounds(data)
    doc = np.searchsorted(offsets, starts, "right") - 1
    docs = len(offsets) - 1
    words = c.word_hashes(data, starts, ends, CODES, pw)
    classes = suffix_class(np.where(ends - starts > 1, data[np.maximum(ends - 2, 0)], 0), data[ends - 1])
    if len(vocabulary.own):
        at = np.minimum(np.searchsorted(vocabulary.own, words), len(vocabulary.own) - 1)
        classes = np.where(vocabulary.own[at] == words, vocabulary.own_class[at], classes)
    word_at = np.arange(len(words)) + doc
    end_at = np.cumsum(np.bincount(doc, minlength=docs) + 1) - 1
    hashed, kinds = np.full(len(words) + docs, END, np.uint64), np.zeros(len(words) + docs, np.int64)
    hashed[word_at], kinds[word_at] = words, classes
    owner = np.empty(len(hashed), np.int64)
    owner[word_at], owner[end_at] = doc, np.arange(docs)
    return Tokens(owner, hashed, kinds, starts, ends, word_at, end_at)


def class_logits(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray) -> np.ndarray:
    out = np.take(weights, rows[0], axis=0)
    other = np.empty_like(out)
    for row in rows[1:]:
        out += np.take(weights, row, axis=0, out=other, mode="clip")
    out += bias
    out -= out.max(axis=1, keepdims=True)
    return out


class Trainer:
    """Stochastic gradient steps of one task, with a step size per row of weights (AdaGrad)."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray) -> None:
        self.weights, self.bias = weights.copy(), bias
        self.squares = np.full(len(weights), 1e-2, np.float32)
        self.seen = np.zeros(len(weights), np.float32)

    def step(self, rows: np.ndarray, classes: np.ndarray) -> None:
        gradient = np.exp(class_logits(self.weights, self.bias, rows))
        gradient /= np.einsum("ij->i", gradient)[:, None]
        gradient[np.arange(len(classes)), classes] -= 1
        for place in rows:
            order = np.argsort(place.astype(np.uint16), kind="stable")
            row = place[order]
            first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
            total = np.add.reduceat(np.take(gradient, order, axis=0), first, axis=0)
            row = row[first]
            self.squares[row] += np.einsum("ij,ij->i", total, total)
            total *= (RATE / np.sqrt(self.squares[row]))[:, None]
            self.weights[row] -= total
            self.seen[row] += np.diff(np.append(first, len(order)))


def _lowered(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for first, data, offsets in c.chunks(column):
        yield first, c.lower_ascii(data), offsets


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) to (token, n), combined over up to 200,000 words of a task."""
    counts: Counter[bytes] = Counter()

    def out() -> pa.RecordBatch:
        found = pa.record_batch([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["token", "n"])
        counts.clear()
        return found

    for batch in batches:
        for text in batch.column(0).cast(pa.large_binary()):
            counts.update((text.as_py() or b"").lower().split())
            if len(counts) > 200_000:
                yield out()
    yield out()


def _trained(weights, vocabulary: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        start = weights.value
        trainer, pw = Trainer(start, vocabulary.bias), c.Powers()
        for batch in batches:
            for _, data, offsets in _lowered(batch.column(0)):
                tokens = tokens_of(data, offsets, vocabulary, pw)
                rows = tokens.features()
                for at in range(0, rows.shape[1], STEP):
                    trainer.step(rows[:, at: at + STEP], tokens.classes[at: at + STEP])
        change = (trainer.weights - start).astype(np.float16)
        salt = TaskContext.get().partitionId() % 64
        blocks = [b for b in range(ROWS // BLOCK) if trainer.seen[b * BLOCK: (b + 1) * BLOCK].any()]
        cut = [slice(b * BLOCK, (b + 1) * BLOCK) for b in blocks]
        yield pa.record_batch(
            [pa.array(blocks, pa.int32()), pa.array([salt] * len(blocks), pa.int32()),
             pa.array([change[s].tobytes() for s in cut], pa.binary()), pa.array([trainer.seen[s].tobytes() for s in cut], pa.binary())],
            names=["block", "salt", "change", "seen"])

    return run


CHANGES = "block int, salt int, change binary, seen binary"


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block and salt: the mean change of each row, weighted by the tokens seen."""
    key, total, seen = None, None, None

    def out() -> pa.RecordBatch:
        mean = total / np.maximum(seen, 1)[:, None]
        return pa.record_batch(
            [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([mean.astype(np.float16).tobytes()], pa.binary()),
             pa.array([seen.astype(np.float32).tobytes()], pa.binary())], names=["block", "salt", "change", "seen"])

    for batch in batches:
        for block, salt, change, n in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if (block, salt) != key:
                if key is not None:
                    yield out()
                key, total, seen = (block, salt), np.zeros((BLOCK, CLASSES)), np.zeros(BLOCK)
            n = np.frombuffer(n, np.float32)
            total += np.frombuffer(change, np.float16).reshape(BLOCK, CLASSES).astype(np.float64) * n[:, None]
            seen += n
    if key is not None:
        yield out()


def train(texts: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """The weights after ROUNDS rounds over the ``text`` of all texts.

    A task sends its changes in blocks of rows; they are
    averaged in two steps, so that no task reads those of all others. The weights are ROWS x CLASSES.
    """
    spark = texts.sparkSession
    weights = np.zeros((ROWS, CLASSES), np.float32)
    for _ in range(ROUNDS):
        held = spark.sparkContext.broadcast(weights)
        changes = texts.select("text").mapInArrow(_trained(held, vocabulary), CHANGES)
        changes = changes.repartition("block", "salt").sortWithinPartitions("block", "salt").mapInArrow(_averaged, CHANGES)
        changes = changes.withColumn("salt", F.lit(0)).repartition("block").sortWithinPartitions("block").mapInArrow(_averaged, CHANGES)
        weights = weights.copy()
        changed = c.stored(changes, "lm-weights").select("block", "change").toArrow()
        for block, change in zip(changed["block"].to_pylist(), changed["change"].to_pylist(), strict=True):
            weights[block * BLOCK: (block + 1) * BLOCK] += np.frombuffer(change, np.float16).reshape(BLOCK, CLASSES)
        held.unpersist()
    return weights


def count_words(texts: DataFrame) -> DataFrame:
    """(token, n) of all words of the texts, lower-cased."""
    counts = texts.select("text").mapInArrow(_word_counts, "token binary, n long")
    return c.stored(counts.groupBy("token").agg(F.sum("n").alias("n")), "lm-words")


def _frequent(words: DataFrame, bound: int) -> pa.Table:
    """The (token, n) rows of the most frequent words, at most ``bound``, the most frequent first.

    The least count is read from a histogram with 64 bins per doubling, so what reaches the driver
    is bounded by the histogram and ``bound`` rows, whatever the vocabulary holds.
    """
    binned = F.floor(F.log2("n") * 64).cast("long")
    least = None
    total = 0
    for row in words.groupBy(binned.alias("bin")).count().orderBy(F.desc("bin")).collect():
        total += row["count"]
        if total > bound:
            break
        least = row["bin"]
    if least is None:
        return pa.table({"token": pa.array([], pa.binary()), "n": pa.array([], pa.int64())})
    found = words.where(binned >= least).select("token", "n").toArrow()
    return found.sort_by([("n", "descending"), ("token", "ascending")])


def vocabulary_of(words: DataFrame, ends: int) -> Vocabulary:
    top = _frequent(words, KNOWN)
    tokens = top["token"].to_pylist()
    hashed = hashes_of(tokens)
    counts = top["n"].to_numpy().astype(np.int64)
    order = np.argsort(hashed)
    own = hashed[:OWN_CLASS]
    own_order = np.argsort(own)
    mass = np.zeros(CLASSES)
    mass[0] = ends + SMOOTH
    mass[1: 1 + len(own)] = counts[:OWN_CLASS] + SMOOTH
    # the other words by their last two bytes: at most 65,792 groups
    apart = words.sparkSession.createDataFrame([(bytearray(t),) for t in tokens[:OWN_CLASS]], "token binary")
    rest = words.join(F.broadcast(apart), "token", "left_anti")
    groups = rest.groupBy(F.substring("token", -2, 2).alias("tail")).agg(F.sum("n").alias("n"), F.count("*").alias("types")).toArrow()
    tails = [t.rjust(2, b"\0") for t in groups["tail"].to_pylist()]
    if tails:
        kinds = suffix_class(np.array([t[0] for t in tails], np.uint8), np.array([t[1] for t in tails], np.uint8))
        np.add.at(mass, kinds, groups["n"].to_numpy() + SMOOTH * groups["types"].to_numpy())
    mass[SUFFIX_FIRST:] += SMOOTH  # an unseen word of the class
    mass[mass == 0] = SMOOTH  # classes of too small a vocabulary
    totals = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("types")).first()
    return Vocabulary(hashed[order], counts[order], own[own_order], 1 + own_order, mass, totals["n"] + ends, totals["types"] + (ends > 0), ends)


def _scored(weights, vocabulary: Vocabulary):
    log_mass = np.log10(vocabulary.mass)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pw, bias = c.Powers(), vocabulary.bias
        for batch in batches:
            for first, data, offsets in _lowered(batch.column(1)):
                docs = len(offsets) - 1
                tokens = tokens_of(data, offsets, vocabulary, pw)
                rows, gain = tokens.features(), np.empty(len(tokens.doc))
                for at in range(0, rows.shape[1], STEP):
                    logits, kinds = class_logits(weights.value, bias, rows[:, at: at + STEP]), tokens.classes[at: at + STEP]
                    gain[at: at + STEP] = (logits[np.arange(len(kinds)), kinds] - np.log(np.einsum("ij->i", np.exp(logits)))) / np.log(10)
                gain -= log_mass[tokens.classes]
                words = tokens.hashed[tokens.word_at]
                doc = tokens.doc[tokens.word_at]
                if len(vocabulary.hashes):
                    place = np.minimum(np.searchsorted(vocabulary.hashes, words), len(vocabulary.hashes) - 1)
                    known = vocabulary.hashes[place] == words
                    count = np.where(known, vocabulary.counts[place], 0)
                else:
                    known, count = np.zeros(len(words), bool), np.zeros(len(words), np.int64)
                logs = np.bincount(doc[known], np.log10(count[known] + SMOOTH), minlength=docs) + np.log10(vocabulary.ends + SMOOTH)
                n_known = np.bincount(doc[known], minlength=docs) + (vocabulary.ends > 0)
                rest = np.flatnonzero(~known)
                text = data.tobytes()
                rare: list[Counter] = [Counter() for _ in range(docs)]
                for d, s, e in zip(doc[rest].tolist(), tokens.starts[rest].tolist(), tokens.ends[rest].tolist(), strict=True):
                    rare[d][text[s:e]] += 1
                ends = np.concatenate(([0], np.cumsum([len(x) for x in rare]))).astype(np.int32)
                pairs = pa.StructArray.from_arrays(
                    [pa.array([t for x in rare for t in x], pa.binary()), pa.array([n for x in rare for n in x.values()], pa.int64())], ["token", "n"])
                yield pa.record_batch(
                    [batch.column(0).slice(first, docs), pa.array(np.bincount(tokens.doc, minlength=docs)), pa.array(n_known.astype(np.int64)),
                     pa.array(logs), pa.array(np.bincount(tokens.doc, gain, minlength=docs)), pa.ListArray.from_arrays(ends, pairs)],
                    names=["_row", "n_tokens", "known", "logs", "gain", "rare"])

    return run


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_row, id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of a stored table.

    Rows with crc32(id as text) mod 10 = 0 are held out of all training; a null id counts as empty
    text, whose crc32 is 0. Tokens are the words, A-Z lower-cased, and one end; a null or empty text
    is its end alone. ``base_score`` is the smoothed unigram log10 probability, ``score`` the model's.
    With nothing to train on, all words are unseen and the classes keep their smoothed shares.
    Repeated rows are scored, and trained on, each for itself; further columns are ignored.

    Each task holds the counts of the KNOWN most frequent words. Other words are joined with
    the full table of counts, one row per text and word.
    """
    spark = docs.sparkSession
    crc = F.crc32(F.coalesce(F.col("_id").cast("string"), F.lit("")).cast("binary"))
    rows = c.with_row(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")))
    training = rows.where(crc % 10 != 0).select("text")
    words = count_words(training)
    vocabulary = vocabulary_of(words, training.count())
    weights = spark.sparkContext.broadcast(train(training, vocabulary))
    schema = "_row long, n_tokens long, known long, logs double, gain double, rare array<struct<token:binary,n:long>>"
    parts = c.stored(rows.select("_row", "text").mapInArrow(_scored(weights, vocabulary), schema), "lm-parts")
    rare = parts.select("_row", F.explode("rare").alias("r")).select("_row", "r.token", F.col("r.n").alias("times"))
    counted = rare.join(words, "token", "left").groupBy("_row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + SMOOTH)).alias("rare_logs"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known"))
    total = float(np.log10(vocabulary.tokens + SMOOTH * (vocabulary.types + 1)))
    found = parts.drop("rare").join(counted, "_row", "left").join(rows.select("_row", "_id"), "_row")
    logs = F.col("logs") + F.coalesce("rare_logs", F.lit(0.0))
    return found.select(
        "_row", F.col("_id").alias(id_col), (crc % 10 == 0).alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"), F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * total).alias("base_score"), (logs + F.col("gain")).alias("score"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(c.documents(spark, sf_dir)).drop("_row")
