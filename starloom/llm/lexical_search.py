"""Ranked lexical search, term at a time, with a limit on accumulators.

Queries come in blocks of bounded size, and each block meets all documents: tasks turn their texts into
small inverted lists and take a query's terms in order, rarest first. While a document without an
accumulator could still reach the k-th best partial score, postings create accumulators; once the
bounds of the terms that remain fall below that score, they only update those that exist, exactly.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm import common as c

TOP = 10
QUERIES = 4096  # queries of a block, at most
TERMS = 1 << 18  # distinct terms of its queries together, at most, unless one query alone has more
SPREAD = 64  # parts that the best documents of one query are first ranked in
TERM_BYTES = bytes(range(48, 58)) + bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))
TO_TERMS = bytes((b + 32 if 65 <= b <= 90 else b) if b in TERM_BYTES else 32 for b in range(256))
POSTINGS = [T.StructField("_n", T.LongType()), T.StructField("_terms", T.ArrayType(T.IntegerType())), T.StructField("_counts", T.ArrayType(T.IntegerType()))]


def terms_of(text: bytes) -> list[bytes]:
    """Maximal stretches of ASCII letters and digits and of anything beyond ASCII; A-Z in lower case."""
    return text.translate(TO_TERMS).split()


@dataclass
class Block:
    """Some queries: their numbers, and for each its term numbers with how often it has them."""

    queries: list[int]
    vocabulary: dict[bytes, int]
    wanted: list[dict[int, int]]


def query_blocks(texts: Iterator[tuple[int, bytes]], queries: int = QUERIES, terms: int = TERMS) -> Iterator[Block]:
    """(query number, text) as blocks of bounded size; queries without terms are left out."""
    block, held = Block([], {}, []), 0
    for number, text in texts:
        counts = Counter(terms_of(text))
        if block.queries and (len(block.queries) >= queries or held + len(counts) > terms):
            yield block
            block, held = Block([], {}, []), 0
        if counts:
            held += len(counts)
            block.queries.append(number)
            block.wanted.append({block.vocabulary.setdefault(t, len(block.vocabulary)): n for t, n in counts.items()})
    if block.queries:
        yield block


def _posting_rows(vocabulary: dict[bytes, int], text_at: int, id_at: int, names: list[str]):
    """Documents with a term, as (id, number of terms, numbers of the block's terms, occurrences)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in c.text_chunks(batch.column(text_at)):
                found, size, doc = [], [], []
                for i, text in enumerate(texts):
                    own = terms_of(text)
                    size.append(len(own))
                    found.append(np.fromiter(map(vocabulary.get, own, repeat(-1)), np.int64, len(own)))
                    doc.append(np.full(len(own), i, np.int64))
                term, doc = np.concatenate(found), np.concatenate(doc)
                key, count = np.unique((doc * len(vocabulary) + term)[term >= 0], return_counts=True)
                bounds = np.searchsorted(key, np.arange(len(texts) + 1) * len(vocabulary))
                offsets = pa.array(bounds, pa.int32())
                size = np.array(size, np.int64)
                out = pa.record_batch([
                    batch.column(id_at).slice(first, len(texts)), pa.array(size),
                    pa.ListArray.from_arrays(offsets, pa.array((key % len(vocabulary)).astype(np.int32))),
                    pa.ListArray.from_arrays(offsets, pa.array(count.astype(np.int32)))], names=names)
                yield out.filter(pa.array(size > 0))

    return run


def _frequency_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, documents that hold it) of a task."""
    total = np.zeros(0, np.int64)
    for batch in batches:
        count = np.bincount(_values(batch.column(0)), minlength=len(total))
        count[: len(total)] += total
        total = count
    seen = np.flatnonzero(total)
    yield pa.record_batch([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["term", "df"])


def _values(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False)


def impacts(tf: np.ndarray, n: np.ndarray, total_docs: int, total_terms: int) -> np.ndarray:
    """What an occurrence count is worth in a text of n terms, in whole millionths."""
    m = 25 + (75 * n * total_docs) // total_terms
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Lists:
    """Inverted lists of a batch of documents."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, docs: int, terms: int) -> None:
        order = np.argsort(term, kind="stable")
        self.doc, self.impact, self.docs = doc[order], impact[order], docs
        self.first = np.searchsorted(term[order], np.arange(terms + 1))
        self.bound = np.zeros(terms, np.int64)  # the greatest impact of each term here
        held = np.flatnonzero(np.diff(self.first))
        if len(held):
            self.bound[held] = np.maximum.reduceat(self.impact, self.first[held])

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        s = slice(self.first[term], self.first[term + 1])
        return self.doc[s], self.impact[s]

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents and scores of all that may be among the k best, and how many accumulators there were.

        ``terms`` come rarest first; ``floor`` is a score that k documents elsewhere reach. No document
        gets an accumulator once the bounds that remain are less than the k-th partial score or the floor; it
        could not reach them. Scores are exact sums of whole numbers.
        """
        held = self.first[terms + 1] > self.first[terms]
        terms, weights = terms[held], weights[held]
        left = np.concatenate((np.cumsum((weights * self.bound[terms])[::-1])[::-1], [0]))
        score = np.zeros(self.docs, np.int64)
        for j, (term, weight) in enumerate(zip(terms.tolist(), weights.tolist(), strict=True)):
            if left[j] < floor or (j and left[j] < self._kth(score, k, left[j])):
                return *self._update(score, terms[j:], weights[j:]), int(np.count_nonzero(score))
            doc, impact = self.of(term)
            score[doc] += weight * impact
        kept = np.flatnonzero(score)
        return kept, score[kept], len(kept)

    @staticmethod
    def _kth(score: np.ndarray, k: int, worth: int) -> int:
        """The k-th best partial score, 0 when it cannot exceed ``worth``."""
        high = score[score > worth]
        return int(np.partition(high, len(high) - k)[len(high) - k]) if len(high) >= k else 0

    def _update(self, score: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The exact scores of the documents that have an accumulator."""
        kept = np.flatnonzero(score)
        total = score[kept]
        for term, weight in zip(terms.tolist(), weights.tolist(), strict=True):
            if not len(kept):
                break
            doc, impact = self.of(term)
            at = np.minimum(np.searchsorted(doc, kept), len(doc) - 1)
            total += np.where(doc[at] == kept, weight * impact[at], 0)
        return kept, total


class Ranking:
    """The k best documents of a query so far: score falling, then id rising, null ids last."""

    def __init__(self, k: int) -> None:
        self.k, self.rows = k, []

    @property
    def floor(self) -> int:
        return self.rows[-1][0] if len(self.rows) == self.k else 1

    def add(self, score: np.ndarray, place: np.ndarray, doc: np.ndarray, ids: pa.Array) -> None:
        """``place`` is the rank of each document's id in its batch."""
        good = np.flatnonzero(score >= self.floor)
        best = good[np.lexsort((place[good], -score[good]))][: self.k]
        self.rows += [(s, ids[d].as_py()) for s, d in zip(score[best].tolist(), doc[best].tolist(), strict=True)]
        self.rows = sorted(self.rows, key=lambda r: (-r[0], r[1] is None, 0 if r[1] is None else r[1]))[: self.k]


def _ranked_rows(queries: list[int], plans: list[tuple[np.ndarray, np.ndarray]], terms: int, total_docs: int, total_terms: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, kind = [Ranking(k) for _ in queries], pa.null()
        for batch in batches:
            kind = batch.column(0).type
            ids, n = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
            lengths = pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False)
            doc = np.repeat(np.arange(len(n)), lengths)
            impact = impacts(_values(batch.column(3)).astype(np.int64), n[doc], total_docs, total_terms)
            lists = Lists(_values(batch.column(2)), doc, impact, len(n), terms)
            place = np.empty(len(n), np.int64)
            place[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(n))
            for ranking, (order, weights) in zip(found, plans, strict=True):
                docs, scores, _ = lists.best(order, weights, k, ranking.floor)
                if len(docs):
                    ranking.add(scores, place[docs], docs, ids)
        rows = [(q, i, s) for q, ranking in zip(queries, found, strict=True) for s, i in ranking.rows]
        if rows:
            columns = zip(zip(*rows, strict=True), (pa.int64(), kind, pa.int64()), strict=True)
            yield pa.record_batch([pa.array(values, of) for values, of in columns], names=["_query", "_id", "score"])

    return run


def _search_block(docs: DataFrame, block: Block, k: int) -> DataFrame:
    """(_query, _id, score): the k best documents of every task for each query of the block."""
    terms = len(block.vocabulary)
    schema = T.StructType([docs.schema["_id"], *POSTINGS])
    postings = c.stored(docs.select("_id", "_text").mapInArrow(_posting_rows(block.vocabulary, 1, 0, schema.names), schema), "search-postings")
    total_docs, total_terms = postings.agg(F.count("*"), F.coalesce(F.sum("_n"), F.lit(0))).first()
    counts = postings.select("_terms").mapInArrow(_frequency_rows, "term int, df long")
    df = np.zeros(terms, np.int64)
    for term, n in counts.groupBy("term").agg(F.sum("df")).collect():  # one row per term of the block
        df[term] = n
    weight = np.floor(1000 * np.log((2 * total_docs + 2) / (2 * df + 1))).astype(np.int64)
    plans = []
    for wanted in block.wanted:
        own = np.array([t for t in wanted if df[t] and weight[t]], np.int64)
        own = own[np.lexsort((own, df[own]))]
        plans.append((own, weight[own] * np.array([wanted[t] for t in own.tolist()], np.int64)))
    run = _ranked_rows(block.queries, plans, terms, total_docs, total_terms, k)
    return postings.mapInArrow(run, T.StructType([
        T.StructField("_query", T.LongType()), schema["_id"], T.StructField("score", T.LongType())]))


def search(
    docs: DataFrame, queries: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
    query_col: str = "item_id", query_text: str = "text", block_queries: int = QUERIES, block_terms: int = TERMS,
) -> DataFrame:
    """(query_col, rank, id_col, score): the k best documents of every query, scores above 0 only.

    A text's terms are the stretches of ASCII letters and digits and of characters beyond ASCII, A-Z in
    lower case. With N documents that have a term, L terms in them, n in one of them, tf occurrences of a term
    there and df documents that hold it, the score sums floor(1000 ln((2N + 2) / (2df + 1))) * (10^9 tf
    div (1000 tf + 8m)) over the query's terms, repeats included, where m = 25 + 75nN div L. Equal
    scores rank by id, null ids last. Every row of ``queries`` is a query of its own, and every row of
    ``docs`` a document, whatever their ids; a null or empty text has no terms, finds nothing and is
    not found. Texts are read whole; other columns are ignored. Ids must have an order.

    Queries are read in turn and cut into blocks of ``block_queries`` queries or ``block_terms`` of
    their distinct terms; only one block is sent to the tasks at a time, which read all documents for it. A task keeps k
    documents per query; those are ranked in parts first, so that no query goes to one task whole.
    """
    table = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    asked = c.stored(queries.select(F.monotonically_increasing_id().alias("_query"), F.col(query_col).alias("_asked"), F.col(query_text).alias("_text")), "search-queries")
    texts = ((q, (t or "").encode()) for q, t in asked.select("_query", "_text").toLocalIterator())
    parts = [c.stored(_search_block(table, block, k), "search-found") for block in query_blocks(texts, block_queries, block_terms)]
    if not parts:
        kinds = T.StructType([asked.schema["_query"], table.schema["_id"], T.StructField("score", T.LongType())])
        parts = [docs.sparkSession.createDataFrame([], kinds)]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    order = [F.desc("score"), F.asc_nulls_last("_id")]
    spread = F.pmod(F.xxhash64("_id"), F.lit(SPREAD))
    some = found.withColumn("_r", F.row_number().over(Window.partitionBy("_query", spread).orderBy(*order))).where(F.col("_r") <= k)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("_query").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.join(asked.select("_query", "_asked"), "_query").select(
        F.col("_asked").alias(query_col), "rank", F.col("_id").alias(id_col), "score")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(c.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP12_SQL = rf"""
WITH texts AS (SELECT doc_id, row_number() OVER () AS d, regexp_extract_all({_LOWER.format("text")}, '{_TERM}') AS t FROM documents WHERE text IS NOT NULL),
docs AS (SELECT doc_id, d, t, len(t)::BIGINT AS n FROM texts WHERE len(t) > 0),
sums AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM docs),
postings AS (SELECT d, term, count(*)::BIGINT AS tf FROM (SELECT d, unnest(t) AS term FROM docs) GROUP BY d, term),
weights AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
            FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), sums),
items AS (SELECT item_id, row_number() OVER () AS q, regexp_extract_all({_LOWER.format("text")}, '{_TERM}') AS t FROM benchmark WHERE text IS NOT NULL),
asked AS (SELECT q, item_id, term, count(*)::BIGINT AS qtf FROM (SELECT q, item_id, unnest(t) AS term FROM items) GROUP BY q, item_id, term),
scores AS (SELECT q, item_id, doc_id, d, sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
           FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN docs USING (d), sums GROUP BY q, item_id, doc_id, d)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score FROM scores WHERE score > 0)
WHERE rank <= {TOP}
"""
