"""Periodic runs of words: repetitions that go on, found through a dictionary of basic factors.

A basic factor is a stretch of 2 ** k words. Level by level every position gets the name of the factor
that starts there: equal names, equal words. The next occurrence of a factor proposes a period where it
lies within a window of twice the factor's length, for such occurrences form arithmetic progressions.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm import common as c

MIN_LENGTH = 6  # words of a run, at least
MIN_EXPONENT = 4  # periods of a run, at least
RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
SPACE = r"[\x20\x09-\x0D]+"


def factor_runs(names: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> np.ndarray:
    """Rows (start, length, period) of all runs in a sequence of names, by start, then period.

    At width w = 2 ** k the periods q with w / 2 < q <= w are found, so no run is found twice. Inside a
    run of smallest period q every factor of that width recurs after exactly q: an earlier recurrence
    would overlap it and leave a smaller period. Positions side by side with the same distance belong
    to one stretch, and the first position of any wider stretch would propose as well, so joining them
    extends a proposal to its full run. A position whose factor is unique has no recurring wider
    factor either and leaves the dictionary, which ends when none is left.
    """
    if min_exponent < 3:
        raise ValueError("a factor recurs for sure in runs of three periods or more")
    n, width = len(names), 1
    at, key = np.arange(n), np.asarray(names, np.int64)
    found = [np.zeros((0, 3), np.int64)]
    while len(at) > 1 and width * (min_exponent // 2) <= n:
        order = np.argsort(key, kind="stable")
        p, sorted_key = at[order], key[order]
        same = sorted_key[1:] == sorted_key[:-1]
        gap = p[1:] - p[:-1]
        near = same & (gap <= width) & (2 * gap > width)
        found.append(_stretches(p[:-1][near], gap[near], width, min_length, min_exponent))
        group = np.concatenate(([0], np.cumsum(~same)))
        again = np.concatenate((same, [False])) | np.concatenate(([False], same))
        name = np.full(n + width, -1)
        name[p[again]] = group[again]
        at = np.sort(p[again])
        at = at[name[at + width] >= 0]
        key = name[at] * (group[-1] + 1) + name[at + width]
        width *= 2
    runs = np.concatenate(found)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _stretches(at: np.ndarray, period: np.ndarray, width: int, min_length: int, min_exponent: int) -> np.ndarray:
    """Runs of neighbouring positions whose factors recur after the same distance."""
    if not len(at):
        return np.zeros((0, 3), np.int64)
    order = np.argsort(at)
    at, period = at[order], period[order]
    edge = np.flatnonzero((at[1:] != at[:-1] + 1) | (period[1:] != period[:-1]))
    first, last = np.concatenate(([0], edge + 1)), np.concatenate((edge, [len(at) - 1]))
    start, q = at[first], period[first]
    length = at[last] + width + q - start
    long = length >= np.maximum(min_length, min_exponent * q)
    return np.stack([start, length, q], axis=1)[long]


def _named(texts: list[bytes]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """Words of each text, one sequence of names with a name of its own after each text, and where texts start.

    No name occurs in two texts, so no factor recurs across them.
    """
    words, names, used = [], [], 0
    for text in texts:
        found = text.split()
        number = {w: i for i, w in enumerate(dict.fromkeys(found), used)}
        names.append(np.fromiter(map(number.__getitem__, found), np.int64, len(found)))
        used += len(number) + 1
        names.append(np.array([used - 1]))
        words.append(found)
    starts = np.concatenate(([0], np.cumsum([len(w) + 1 for w in words]))).astype(np.int64)
    return words, np.concatenate(names), starts


def _run_rows(text_at: int, keep: list[int], names: list[str], min_length: int, min_exponent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in c.text_chunks(batch.column(text_at)):
                words, sequence, starts = _named(texts)
                runs = factor_runs(sequence, min_length, min_exponent)
                cover = np.zeros(len(sequence) + 1, np.int64)
                np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
                np.add.at(cover, runs[:, 0] + runs[:, 1], -1)
                stays = np.cumsum(cover[:-1]) == 0
                left = [b" ".join(compress(w, stays[s: s + len(w)].tolist())) for w, s in zip(words, starts, strict=False)]
                bounds = np.searchsorted(runs[:, 0], starts)
                doc = np.searchsorted(starts, runs[:, 0], "right") - 1
                values = [runs[:, 0] - starts[doc], runs[:, 1], runs[:, 2]]
                items = pa.StructArray.from_arrays([pa.array(v) for v in values], RUN.names)
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), items)
                carried = [batch.column(i).slice(first, len(texts)) for i in keep]
                added = [pa.array(np.diff(starts) - 1), pa.array(np.diff(bounds)), lists, pa.array(left, pa.binary()).cast(pa.string())]
                yield pa.record_batch([*carried, *added], names=names)

    return run


def collapse_runs(
    docs: DataFrame, keep: list[str] | None = None, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT, text_col: str = "text",
) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default all) with the periodic runs of each text and the text without their repetitions.

    A run is a stretch of words, as wide as it goes, with smallest period q (words q apart are equal),
    ``min_length`` words and ``min_exponent`` (3 or more) periods at least. Added: n_words, n_runs, runs (array of
    start, length, period in words, by start, then period) and collapsed (the words that no run holds
    after its first q words, joined by one blank). Runs may overlap; all of them count. Words are
    compared byte by byte, never by a hash. Columns of ``docs`` with an added name are replaced. A null or
    empty text has no words, no runs and an empty ``collapsed``; repeated rows and null ids are handled
    row by row; texts are read whole. Each text is dealt with in the task that holds its row, without
    a shuffle; memory follows 1 MB of text, or one longer text.
    """
    docs = docs.drop("n_words", "n_runs", "runs", "collapsed")
    carried = docs.columns if keep is None else keep
    used = docs.select(*carried, *([] if text_col in carried else [text_col]))
    added = [T.StructField("n_words", T.LongType()), T.StructField("n_runs", T.LongType()),
             T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())]
    schema = T.StructType([*used.select(*carried).schema.fields, *added])
    run = _run_rows(used.columns.index(text_col), [used.columns.index(x) for x in carried], schema.names, min_length, min_exponent)
    return used.mapInArrow(run, schema)


def plant_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with a periodic tail in every text whose id has a crc32 that ends in 0.

    With g = crc32 / 10 and n words, word i from a = g % n on becomes word a + (i - a) % p, where
    p = 1 + (n - a) / (3 + g % 8), divisions rounded down. A row without an id keeps its text.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.filter(F.split("text", SPACE), lambda w: w != ""))
    cut = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), words.alias("words")).withColumn("n", F.size("words").cast("long"))
    cut = cut.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    cut = cut.withColumn("p", 1 + F.expr("(n - a) div (3 + g % 8)"))
    head = F.expr("slice(words, 1, int(a))")
    tail = F.expr("slice(flatten(array_repeat(slice(words, int(a) + 1, int(p)), int(ceil((n - a) / p)))), 1, int(n - a))")
    return cut.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(F.concat(head, tail), " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collapse_runs(plant_repeats(c.documents(spark, sf_dir)), ["doc_id"])
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    listed = F.when(F.col("n_runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    return found.select(
        "doc_id", "n_runs", "n_words", best.alias("best"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256", "n_words")
