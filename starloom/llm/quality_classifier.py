"""A quality classifier: random Fourier features of document statistics, ridge regression, isotonic calibration.

A text is a short vector of statistics of its characters, words and lines. Cosines of random
projections of it approximate a Gaussian kernel, so a linear model over them is a kernel machine.
Tasks sum its normal equations over their rows; the driver sees the sums alone. Scores of rows that a
model has not seen give the monotone map from margins to probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm import common as c

SAMPLE = 200_000  # labelled ids that the model is fitted on, at most: those with the least md5
FEATURES = 192
PARTS = 16  # tasks that sum the normal equations
FOLDS = 5  # crc32 of the id modulo this; fold 0 is never learned from
RIDGES = (0.01, 0.1, 1.0, 10.0)
SEED = 13
CUTOFF = 0.3
UNIT = 1 << 12  # statistics are whole multiples of 1 / UNIT, so that sums do not depend on their order
STEP = 1 << 10  # and so are features of 1 / STEP
BINS = 1 << 10  # margins are calibrated in bins of 1 / BINS between LOW and HIGH
LOW, HIGH = -1, 2
STATISTICS = (
    "words", "word_length", "upper", "digits", "high", "symbols", "exclaim", "points", "lines",
    "distinct", "adjacent", "windows", "symbol_ends", "exclaim_ends", "point_ends", "letterless", "capitals", "same_lines")
CODES = c.byte_codes(47)


def _among(values: bytes) -> np.ndarray:
    found = np.zeros(256, bool)
    found[list(values)] = True
    return found


UPPER, DIGIT = _among(bytes(range(65, 91))), _among(bytes(range(48, 58)))
LETTER = UPPER | _among(bytes(range(97, 123))) | _among(bytes(range(128, 256)))
SYMBOL, EXCLAIM, POINT = _among(b"#$%&*+<=>@\\^_`{|}~/[]"), _among(b"!?"), _among(b".,;:")


def _again(doc: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether a value has been there before in its document."""
    key = c.mix(value + c.mix(doc.astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    later = np.zeros(len(key), bool)
    later[order[1:]] = key[order][1:] == key[order][:-1]
    return later


def statistics(data: np.ndarray, offsets: np.ndarray, pw: c.Powers) -> np.ndarray:
    """One row of STATISTICS per text, in units of 1 / UNIT; a text without words has zeros.

    Logarithms of the counts of words and of the mean word length, and square roots of shares: of
    character kinds in characters, of words with a property in words, of lines in words and of repeated
    lines in lines.
    """
    docs = len(offsets) - 1
    starts, ends = c.word_bounds(data)
    doc = np.searchsorted(offsets, starts, "right") - 1
    in_texts = lambda mask: np.add.reduceat(mask.astype(np.int64), offsets[:-1])
    in_words = lambda mask: np.bincount(doc[mask], minlength=docs)
    words = np.bincount(doc, minlength=docs)
    chars = in_texts(((data & 0xC0) != 0x80) & ~c.SPACES[data])
    word = c.word_hashes(data, starts, ends, CODES, pw)
    after = np.zeros(len(word), bool)
    after[1:] = (word[1:] == word[:-1]) & (doc[1:] == doc[:-1])
    at = np.flatnonzero(doc[2:] == doc[:-2]) if len(doc) > 2 else np.zeros(0, np.int64)
    window = _again(doc[at], c.mix(word[at] + c.mix(word[at + 1] + c.mix(word[at + 2]))))
    last = data[ends - 1]
    letters = np.concatenate(([0], np.cumsum(LETTER[data])))
    capitals = np.concatenate(([0], np.cumsum(UPPER[data])))
    own = letters[ends] - letters[starts]
    breaks = np.flatnonzero(data == 10)
    first = np.concatenate(([0], breaks[:-1] + 1)) if len(breaks) else breaks
    filled = np.searchsorted(starts, first) < np.searchsorted(starts, breaks)
    line_doc = np.searchsorted(offsets, first[filled], "right") - 1
    line = c.word_hashes(data, first[filled], breaks[filled], CODES, pw)
    lines = np.bincount(line_doc, minlength=docs)
    shares = [
        *((in_texts(kind[data]), chars) for kind in (UPPER, DIGIT)), (in_texts(data >= 0xC0), chars),
        *((in_texts(kind[data]), chars) for kind in (SYMBOL, EXCLAIM, POINT)), (lines, words),
        (in_words(~_again(doc, word)), words), (in_words(after), words), (np.bincount(doc[at][window], minlength=docs), words),
        *((in_words(kind[last]), words) for kind in (SYMBOL, EXCLAIM, POINT)), (in_words(own == 0), words),
        (in_words((own > 1) & (capitals[ends] - capitals[starts] == own)), words),
        (np.bincount(line_doc[_again(line_doc, line)], minlength=docs), lines)]
    columns = [np.log1p(words), np.log1p(chars / np.maximum(words, 1)), *(np.sqrt(n / np.maximum(of, 1)) for n, of in shares)]
    return np.rint(np.stack(columns, axis=1) * UNIT * (words > 0)[:, None]).astype(np.int64)


def _statistic_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, fold, label) to (fold, label, statistics)."""
    pw = c.Powers()
    for batch in batches:
        for first, data, offsets in c.chunks(batch.column(0)):
            found = statistics(data, offsets, pw)
            own = [batch.column(i).slice(first, len(found)) for i in (1, 2)]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1) * found.shape[1], pa.int32()), pa.array(found.ravel()))
            yield pa.record_batch([*own, lists], names=["fold", "label", "stats"])


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    fold, label = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
    return fold, label, batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))


def _moment_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = np.zeros((3, len(STATISTICS)), np.int64)
    for batch in batches:
        _, _, x = _arrays(batch)
        sums += np.stack([np.full(x.shape[1], len(x)), x.sum(0), (x * x).sum(0)])
    yield pa.record_batch([pa.array(v) for v in (np.arange(sums.shape[1]), *sums)], names=["i", "n", "s", "ss"])


@dataclass
class Fourier:
    """Random Fourier features of standardised statistics, in units of 1 / STEP; the last one is constant."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    phase: np.ndarray

    @staticmethod
    def over(mean: np.ndarray, spread: np.ndarray, features: int = FEATURES, seed: int = SEED) -> Fourier:
        """The kernel's width is the root of the number of statistics, the scale of distances between standardised rows."""
        rng = np.random.default_rng(seed)
        weights = rng.normal(size=(len(mean), features)) / np.sqrt(len(mean))
        return Fourier(mean, np.where(spread > 0, spread, 1.0), weights, rng.uniform(0, 2 * np.pi, features))

    def of(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.spread, -8, 8)
        z = np.rint(np.cos(x @ self.weights + self.phase) * STEP)
        return np.concatenate((z, np.full((len(z), 1), float(STEP))), axis=1)


def _equation_rows(fourier: Fourier):
    """(fold, cell, value): the upper triangle of the products of features and label, whole numbers, once per task and fold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(fourier.phase) + 2
        sums = np.zeros((FOLDS, size, size))
        for batch in batches:
            fold, label, x = _arrays(batch)
            z = np.concatenate((fourier.of(x), label[:, None].astype(float)), axis=1)
            for f in np.unique(fold):
                sums[f] += z[fold == f].T @ z[fold == f]
        upper = np.triu_indices(size)
        for f in range(1, FOLDS):
            if sums[f, -2, -2]:
                cells = pa.array((upper[0] * size + upper[1]).astype(np.int32))
                yield pa.record_batch([pa.array(np.full(len(upper[0]), f, np.int32)), cells, pa.array(sums[f][upper].astype(np.int64))], names=["fold", "cell", "value"])

    return run


def solve(equations: np.ndarray, ridge: float) -> np.ndarray:
    """Ridge weights from the products of features and label; the constant feature is not held small."""
    gram, target = equations[:-1, :-1] / STEP**2, equations[:-1, -1] / STEP
    penalty = np.full(len(target), ridge)
    penalty[-1] = 1e-6
    return np.linalg.solve(gram + np.diag(penalty), target)


def margins(z: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Bins of the margins of rows."""
    return np.clip(np.rint((z @ weights / STEP - LOW) * BINS), 0, (HIGH - LOW) * BINS).astype(np.int64)


def _margin_rows(fourier: Fourier, models: np.ndarray):
    """(ridge, bin, rows, rows labelled 1): margins by the model of the other folds, for each ridge."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(models), 2, (HIGH - LOW) * BINS + 1), np.int64)
        for batch in batches:
            fold, label, x = _arrays(batch)
            z = fourier.of(x)
            for f in np.unique(fold):
                for r in range(len(models)):
                    at = margins(z[fold == f], models[r, f])
                    np.add.at(sums[r, 0], at, 1)
                    np.add.at(sums[r, 1], at, label[fold == f])
        ridge, where = np.nonzero(sums[:, 0])
        columns = [ridge, where, sums[ridge, 0, where], sums[ridge, 1, where]]
        yield pa.record_batch([pa.array(v) for v in columns], names=["ridge", "bin", "n", "good"])

    return run


def isotonic(n: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean place and share of good rows of the pooled blocks of bins, both rising."""
    blocks: list[list[float]] = []
    for place in np.flatnonzero(n):
        blocks.append([float(n[place]), float(good[place]), float(n[place] * place)])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    rows = np.array(blocks).reshape(-1, 3)
    return rows[:, 2] / rows[:, 0], rows[:, 1] / rows[:, 0]


@dataclass
class Classifier:
    fourier: Fourier
    weights: np.ndarray
    places: np.ndarray
    shares: np.ndarray

    def score(self, stats: np.ndarray) -> np.ndarray:
        at = (self.fourier.of(stats) @ self.weights / STEP - LOW) * BINS
        return np.interp(at, self.places, self.shares)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Classifier:
    """A classifier of the texts whose ids ``labels`` has, fold 0 left out.

    Of more than ``sample`` labelled ids those with the least md5 count; that bound is what allows them to be
    broadcast. An id with several labels has the greatest, null ids and labels are ignored. All rows of an id
    are examples. Without any example every score is 0.5.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("label"))
    known = known.withColumn("fold", fold_of("_id")).where("fold > 0")
    known = known.orderBy(F.md5(F.col("_id").cast("string").cast("binary")), "_id").limit(sample)
    marked = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(known), "_id")
    rows = marked.select("_text", "fold", "label").mapInArrow(_statistic_rows, "fold int, label int, stats array<long>")
    rows = c.stored(rows, "quality-sample").coalesce(PARTS)

    sums = np.zeros((3, len(STATISTICS)))
    for i, *values in rows.mapInArrow(_moment_rows, "i long, n long, s long, ss long").groupBy("i").agg(F.sum("n"), F.sum("s"), F.sum("ss")).collect():
        sums[:, i] = values
    count = np.maximum(sums[0], 1)
    fourier = Fourier.over(sums[1] / count, np.sqrt(np.maximum(sums[2] / count - (sums[1] / count) ** 2, 0)))

    size = FEATURES + 2
    equations = np.zeros((FOLDS, size, size))
    for fold, cell, value in rows.mapInArrow(_equation_rows(fourier), "fold int, cell int, value long").groupBy("fold", "cell").agg(F.sum("value")).collect():
        i, j = divmod(cell, size)
        equations[fold, i, j] = equations[fold, j, i] = value
    total = equations.sum(0)
    models = np.array([[solve(total - equations[f], ridge) for f in range(FOLDS)] for ridge in RIDGES])

    bins = np.zeros((len(RIDGES), 2, (HIGH - LOW) * BINS + 1))
    held = rows.mapInArrow(_margin_rows(fourier, models), "ridge long, bin long, n long, good long")
    for ridge, place, n, good in held.groupBy("ridge", "bin").agg(F.sum("n"), F.sum("good")).collect():
        bins[ridge, :, place] = n, good
    at = np.arange(bins.shape[2]) / BINS + LOW
    loss = [float((g * (1 - at) ** 2 + (n - g) * at**2).sum()) for n, g in bins]
    best = int(np.argmin(loss))
    places, shares = isotonic(*bins[best])
    if not len(places):
        places, shares = np.zeros(1), np.full(1, 0.5)
    return Classifier(fourier, solve(total, RIDGES[best]), places, shares)


def fold_of(id_col: str) -> F.Column:
    """The fold of an id; a row without one is never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS, F.lit(0)).cast("int")


def _score_rows(model: Classifier, text_at: int, keep: list[int], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pw = c.Powers()
        for batch in batches:
            for first, data, offsets in c.chunks(batch.column(text_at)):
                found = model.score(statistics(data, offsets, pw))
                yield pa.record_batch([*(batch.column(i).slice(first, len(found)) for i in keep), pa.array(found)], names=names)

    return run


def score_quality(
    docs: DataFrame, labels: DataFrame, keep: list[str] | None = None, cutoff: float = CUTOFF, sample: int = SAMPLE,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default all) with held_out, score and predicted of every row.

    ``score`` (0 to 1) is the probability of label 1 as the statistics of the whole text tell it; nothing else
    about a row enters. ``held_out`` rows (crc32 of the id as text divisible by 5, or no id) teach
    nothing. ``predicted`` is 1 from ``cutoff`` on. A null or empty text has a score like any other; repeated
    rows are scored row by row; columns of ``docs`` with an added name are replaced. Two passes over the
    texts, the first only over those with a label; no text is shuffled. The driver gets sums whose size
    depends on the number of features and bins alone.
    """
    docs = docs.drop("held_out", "score", "predicted")
    model = fit(docs, labels, id_col, text_col, label_col, sample)
    carried = docs.columns if keep is None else keep
    used = docs.select(*carried, *([] if text_col in carried else [text_col]))
    schema = T.StructType([*used.select(*carried).schema.fields, T.StructField("score", T.DoubleType())])
    run = _score_rows(model, used.columns.index(text_col), [used.columns.index(x) for x in carried], schema.names)
    scored = used.mapInArrow(run, schema)
    return scored.select(*carried, (fold_of(id_col) == 0).alias("held_out"), "score", (F.col("score") >= cutoff).cast("int").alias("predicted"))


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(c.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"), ["doc_id"])
