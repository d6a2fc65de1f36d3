"""Token counts under a unigram model, with the dynamic programme shared along a trie.

The best segmentation of a pre-token into pieces of a vocabulary is a forward pass: the best score
of a prefix is the best over the pieces that end it. It depends on the prefix alone, so distinct
pre-tokens are inserted in a trie, each node gets its forward score once, and the terminal node
holds the token count.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starloom.llm.packing import tokenizer_files

NODES = 400_000  # nodes a task keeps; a full trie is emptied, which changes no result


def unigram_scores(ranks: str) -> dict[bytes, float]:
    """Natural log probabilities of the pieces of a rank file.

    The files hold no probabilities, and tokenizers are not trained here: pieces get Zipf's law by
    their rank, p(rank) in proportion to 1 / (rank + 2.7). The 256 single bytes are pieces, so every text
    has a segmentation.
    """
    with open(ranks, "rb") as lines:
        pieces = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    total = math.log(sum(1 / (rank + 2.7) for rank in pieces.values()))
    return {piece: -math.log(rank + 2.7) - total for piece, rank in pieces.items()}


class Trie:
    """Forward scores along a trie of byte strings.

    A node is [children, best score, its token count, terminal]. Of segmentations with the same
    score, the one whose last piece is longest counts.
    """

    def __init__(self, scores: dict[bytes, float], nodes: int = NODES) -> None:
        self.scores, self.limit = scores, nodes
        self.tails = {piece[i:] for piece in scores for i in range(len(piece))}
        self._empty()

    def _empty(self) -> None:
        self.root, self.nodes = [{}, 0.0, 0, False], 1

    def count(self, text: bytes) -> int:
        """Tokens of the best segmentation."""
        if self.nodes > self.limit:
            self._empty()
        node, path = self.root, [self.root]
        for i, byte in enumerate(text):
            child = node[0].get(byte)
            if child is None:
                child = node[0][byte] = self._forward(text, i + 1, path)
                self.nodes += 1
            node = child
            path.append(node)
        node[3] = True
        return node[2]

    def _forward(self, text: bytes, end: int, path: list[list]) -> list:
        best, tokens = -math.inf, 0
        for start in range(end - 1, -1, -1):
            piece = text[start:end]
            if piece not in self.tails:
                break
            score = self.scores.get(piece)
            if score is not None and path[start][1] + score >= best:
                best, tokens = path[start][1] + score, path[start][2] + 1
        return [{}, best, tokens, False]


_TRIES: dict[str, Trie] = {}  # one per worker process


def _counted(files: tuple[str, str, str], text_at: int, keep: list[int], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, ranks, pattern = files
        if ranks not in _TRIES:
            _TRIES[ranks] = Trie(unigram_scores(ranks))
        trie, split = _TRIES[ranks], regex.compile(pattern).findall
        known: dict[str, int] = {}
        for batch in batches:
            pre, tokens = [], []
            for scalar in batch.column(text_at):
                parts = split(scalar.as_py() or "")
                for part in set(parts):
                    if part not in known:
                        if len(known) > NODES:
                            known.clear()
                        known[part] = trie.count(part.encode())
                pre.append(len(parts))
                tokens.append(sum(known[p] if p in known else trie.count(p.encode()) for p in parts))
            yield pa.record_batch([*(batch.column(i) for i in keep), pa.array(pre, pa.int64()), pa.array(tokens, pa.int64())], names=names)

    return run


def count_tokens(docs: DataFrame, keep: list[str] | None = None, files: tuple[str, str, str] | None = None, text_col: str = "text") -> DataFrame:
    """The columns ``keep`` of ``docs`` (default all) with n_pretokens and n_tokens of every row.

    Pre-tokens follow the tokenizer's pattern over the whole text; each costs the tokens of its best
    unigram segmentation over the UTF-8 bytes. A null or empty text has none; repeated rows and null
    ids are counted row by row; columns of ``docs`` with an added name are replaced. One pass, no
    shuffle; a task keeps a bounded trie.
    """
    docs = docs.drop("n_pretokens", "n_tokens")
    carried = docs.columns if keep is None else keep
    used = docs.select(*carried, *([] if text_col in carried else [text_col]))
    schema = T.StructType([*used.select(*carried).schema.fields, T.StructField("n_pretokens", T.LongType()), T.StructField("n_tokens", T.LongType())])
    run = _counted(files or tokenizer_files(), used.columns.index(text_col), [used.columns.index(x) for x in carried], schema.names)
    return used.mapInArrow(run, schema)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), ["doc_id"])
