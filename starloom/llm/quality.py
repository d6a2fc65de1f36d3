"""Quality rules: a hashed n-gram log-likelihood ratio between trusted text and the raw corpus.

Every text is the bag of its overlapping 4-byte grams, hashed to 65,536 buckets. Two multinomials
over the buckets, one of trusted texts and one of all texts, give each bucket a log ratio; a text's
score is the mean over its grams, so it does not grow with length. Texts that the raw corpus
explains better than trusted text by more than the threshold go.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm import common as c

GRAM = 4
BUCKET_BITS = 16
MULTIPLIER = 2654435761
SCALE = 1 << 20  # ratios are whole multiples of 1 / SCALE, so that sums do not depend on their order
THRESHOLD = -0.5  # nats a gram
TRUSTED = 20_000  # labelled texts that the target multinomial is fitted on, at most
MIN_WORDS = 50
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
CODES = c.byte_codes(31)
FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_grams", "llr_sum"]


def gram_buckets(data: np.ndarray) -> np.ndarray:
    """Bucket of the gram at each byte that has three more after it."""
    x = data.astype(np.uint64)
    value = x[:-3] << np.uint64(24) | x[1:-2] << np.uint64(16) | x[2:-1] << np.uint64(8) | x[3:]
    return ((value * np.uint64(MULTIPLIER) & np.uint64(0xFFFFFFFF)) >> np.uint64(32 - BUCKET_BITS)).astype(np.int64)


def _gram_docs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of the grams that lie inside one text."""
    if len(data) < GRAM:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    bucket = gram_buckets(data)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(bucket)]
    inside = np.arange(len(bucket)) + GRAM < offsets[doc + 1]  # the separator after a text is none of its bytes
    return doc[inside], bucket[inside]


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, trusted) to (bucket, raw, target) counts, once per task."""
    raw, target = np.zeros(1 << BUCKET_BITS, np.int64), np.zeros(1 << BUCKET_BITS, np.int64)
    for batch in batches:
        trusted = np.asarray(batch.column(1).cast(pa.int8()))
        for first, data, offsets in c.chunks(batch.column(0)):
            doc, bucket = _gram_docs(data, offsets)
            raw += np.bincount(bucket, minlength=len(raw))
            target += np.bincount(bucket[trusted[first + doc] > 0], minlength=len(raw))
    seen = np.flatnonzero(raw)
    yield pa.record_batch([pa.array(seen), pa.array(raw[seen]), pa.array(target[seen])], names=["bucket", "raw", "target"])


def log_ratios(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """The scaled log ratio of every bucket: counts of all texts, and of those in ``trusted`` (distinct ids, TRUSTED at most).

    Both multinomials add one to each bucket. The table of 65,536 buckets is all that reaches the driver.
    """
    ids = trusted.select(F.col(trusted.columns[0]).alias("_trusted"))
    marked = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(ids), F.col("_id") == F.col("_trusted"), "left")
    counts = marked.select("_text", F.col("_trusted").isNotNull().alias("trusted")).mapInArrow(_count_rows, "bucket long, raw long, target long")
    raw, target = np.zeros(1 << BUCKET_BITS), np.zeros(1 << BUCKET_BITS)
    for bucket, n, m in counts.groupBy("bucket").agg(F.sum("raw"), F.sum("target")).collect():
        raw[bucket], target[bucket] = n, m
    ratio = np.log((target + 1) / (target.sum() + len(target))) - np.log((raw + 1) / (raw.sum() + len(raw)))
    return np.floor(ratio * SCALE + 0.5).astype(np.int64)


def trusted_ids(labels: DataFrame, bound: int = TRUSTED) -> DataFrame:
    """Ids labelled of good quality; of more than ``bound`` those with the least md5."""
    good = labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return good.orderBy(F.md5(F.col("doc_id").cast("string").cast("binary")), "doc_id").limit(bound)


def _repeat_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, doc: np.ndarray, pw: c.Powers) -> np.ndarray:
    """Whether each word lies in a 3-word window that its text has twice or more."""
    words = c.word_hashes(data, starts, ends, CODES, pw)
    covered = np.zeros(len(words), bool)
    at = np.flatnonzero(doc[2:] == doc[:-2]) if len(doc) > 2 else np.zeros(0, np.int64)
    window = c.mix(words[at] + c.mix(words[at + 1] + c.mix(words[at + 2] + doc[at].astype(np.uint64))))
    order = np.argsort(window, kind="stable")
    same = window[order][1:] == window[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    for i in range(3):
        covered[at[twice] + i] = True
    return covered


def features(data: np.ndarray, offsets: np.ndarray, ratios: np.ndarray, pw: c.Powers) -> list[np.ndarray]:
    docs = len(offsets) - 1
    starts, ends = c.word_bounds(data)
    doc = np.searchsorted(offsets, starts, "right") - 1
    total = lambda mask: np.add.reduceat(mask.astype(np.int64), offsets[:-1])
    lines = []
    for i in range(docs):
        found = [x for x in data[offsets[i]: offsets[i + 1] - 1].tobytes().split(b"\n") if x.strip()]
        lines.append(len(found) - len(set(found)))
    owner, bucket = _gram_docs(data, offsets)
    sums = np.zeros(docs, np.int64)
    np.add.at(sums, owner, ratios[bucket])
    covered = _repeat_words(data, starts, ends, doc, pw)
    return [
        np.bincount(doc, minlength=docs), total(((data & 0xC0) != 0x80) & ~c.SPACES[data]), total(SYMBOLS[data]), np.array(lines, np.int64),
        np.bincount(doc[covered], minlength=docs), np.bincount(owner, minlength=docs), sums]


def _feature_rows(ratios: np.ndarray, text_at: int, keep: list[int], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pw = c.Powers()
        for batch in batches:
            for first, data, offsets in c.chunks(batch.column(text_at)):
                found = features(data, offsets, ratios, pw)
                carried = [batch.column(i).slice(first, len(offsets) - 1) for i in keep]
                yield pa.record_batch(carried + [pa.array(f.astype(np.int64)) for f in found], names=names)

    return run


def judge_quality(
    docs: DataFrame, trusted: DataFrame, keep: list[str] | None = None, threshold: float = THRESHOLD,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default all) with counts, score and verdict of every row.

    Added: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_grams, llr_sum (scaled sum
    of log ratios), llr (mean, 0 without grams), base_failed (under 50 words, or more than half of
    them repeated in 3-word windows) and kept (not base_failed and llr at least ``threshold``).
    ``trusted`` has the ids of the target texts in its first column: distinct, not null, TRUSTED at
    most, so it is broadcast. Without any, the target is uniform. Columns of ``docs`` with an added
    name are replaced. A null or empty text has no words and fails; repeated rows and null ids are
    judged row by row; texts are read whole.
    """
    added = [*FEATURES, "llr", "base_failed", "kept"]
    docs = docs.drop(*added)
    ratios = log_ratios(docs, trusted, id_col, text_col)
    carried = docs.columns if keep is None else keep
    used = docs.select(*carried, *([] if text_col in carried else [text_col]))
    schema = T.StructType([*used.select(*carried).schema.fields, *[T.StructField(f, T.LongType()) for f in FEATURES]])
    run = _feature_rows(ratios, used.columns.index(text_col), [used.columns.index(x) for x in carried], schema.names)
    found = used.mapInArrow(run, schema)
    limit = int(np.floor(threshold * SCALE + 0.5))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return found.select(
        *carried, *FEATURES, F.when(F.col("n_grams") > 0, F.col("llr_sum") / F.col("n_grams") / SCALE).otherwise(0.0).alias("llr"),
        failed.alias("base_failed"), (~failed & (F.col("llr_sum") >= limit * F.col("n_grams"))).alias("kept"))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = judge_quality(c.documents(spark, sf_dir), trusted_ids(labels), ["doc_id"])
    return found.select("doc_id", *FEATURES, "base_failed", "kept")


OP1_SQL = rf"""
WITH trusted AS (SELECT doc_id FROM (SELECT DISTINCT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL)
                 ORDER BY md5(doc_id::VARCHAR), doc_id LIMIT {TRUSTED}),
texts AS (SELECT doc_id, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS h FROM documents),
grams AS (SELECT doc_id, ((('0x' || substr(h, (2 * i + 1)::BIGINT, 8))::UBIGINT * {MULTIPLIER} % 4294967296) >> {32 - BUCKET_BITS})::BIGINT AS bucket
          FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - {GRAM - 1})) AS i FROM texts)),
own AS (SELECT doc_id, bucket, count(*) AS n FROM grams GROUP BY doc_id, bucket),
counts AS (SELECT bucket, sum(n)::DOUBLE AS raw, coalesce(sum(n) FILTER (WHERE doc_id IN (SELECT doc_id FROM trusted)), 0)::DOUBLE AS target
           FROM own GROUP BY bucket),
sums AS (SELECT sum(raw) AS raws, sum(target) AS targets FROM counts),
ratios AS (SELECT bucket, floor((ln((target + 1) / (targets + {1 << BUCKET_BITS})) - ln((raw + 1) / (raws + {1 << BUCKET_BITS}))) * {SCALE} + 0.5)::BIGINT AS ratio
           FROM counts, sums),
scores AS (SELECT doc_id, sum(n)::BIGINT AS n_grams, sum(n * ratio)::BIGINT AS llr_sum FROM own JOIN ratios USING (bucket) GROUP BY doc_id),
words AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
            list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM texts),
windows AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
base AS (SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
           (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
           (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
         FROM words LEFT JOIN covered c USING (doc_id)),
judged AS (SELECT b.*, coalesce(n_grams, 0)::BIGINT AS n_grams, coalesce(llr_sum, 0)::BIGINT AS llr_sum,
             n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed
           FROM base b LEFT JOIN scores USING (doc_id))
SELECT *, NOT base_failed AND llr_sum >= {int(np.floor(THRESHOLD * SCALE + 0.5))} * n_grams AS kept FROM judged
"""
