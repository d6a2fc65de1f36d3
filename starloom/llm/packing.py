"""Bounded-space online packing of documents into windows of 2048 tokens.

A task keeps a fixed number of open windows. A piece goes to the open window it fits best; when it
fits none, the fullest window is emitted and the piece opens a new one. A window with a gap worth
more than WASTE tokens is not emitted with it: the piece is cut and its head fills the gap. What is
open when a task ends is a leftover; leftovers of many tasks are merged in the same way until few
are left, and only their last windows may be short.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import common as c

WINDOW = 2048
OPEN = 64  # windows that a task keeps open
WASTE = 16  # tokens of padding that a window may be emitted with
MERGED = 16  # the leftovers of so many tasks are merged by one
PIECE = "_row long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids array<int>"
NAMES = ["_row", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
NO_SEQUENCE = -1


class Tokens:
    """Token ids of a public byte-level BPE vocabulary.

    ``path`` is its tokenizers file, ``ranks`` the same vocabulary as ranks: both libraries give the
    same ids, the second several times faster. A text that holds the string of a special token goes
    through the tokenizers file, which gives it the special id.
    """

    def __init__(self, path: str, ranks: str, pattern: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32)
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.int32)


_TOKENS: dict[tuple, Tokens] = {}  # one per worker process: loading takes about a second


def tokens_of(*files: str) -> Tokens:
    if files not in _TOKENS:
        _TOKENS[files] = Tokens(*files)
    return _TOKENS[files]


class Packer:
    """Open windows of one task; ``emit`` gets (row, start, doc_tokens, ids) pieces of a finished window."""

    def __init__(self, first_id: int, windows: int = OPEN) -> None:
        self.next_id, self.windows = first_id, windows
        self.open: dict[int, list[tuple]] = {}
        self.gaps: list[tuple[int, int]] = []  # (free tokens, window) of the open windows, sorted
        self.opened = 0
        self.done: list[tuple] = []

    @property
    def free(self) -> list[int]:
        return [room for room, _ in self.gaps]

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for row, start, total, ids in pieces:
            self.done.append((row, start, total, ids, self.next_id, offset))
            offset += len(ids)
        self.next_id += 1

    def add(self, row: int, start: int, total: int, ids: np.ndarray) -> None:
        while len(ids) >= WINDOW:
            self._close([(row, start, total, ids[:WINDOW])])
            ids, start = ids[WINDOW:], start + WINDOW
        while len(ids):
            best = bisect_left(self.gaps, (len(ids), -1))
            if best < len(self.gaps):
                room, window = self.gaps.pop(best)
                self.open[window].append((row, start, total, ids))
                if room > len(ids):
                    insort(self.gaps, (room - len(ids), window))
                else:
                    self._close(self.open.pop(window))
                return
            if len(self.open) < self.windows:
                self.open[self.opened] = [(row, start, total, ids)]
                insort(self.gaps, (WINDOW - len(ids), self.opened))
                self.opened += 1
                return
            room, window = self.gaps.pop(0)  # the fullest
            pieces = self.open.pop(window)
            if room > WASTE:
                pieces.append((row, start, total, ids[:room]))
                ids, start = ids[room:], start + room
            self._close(pieces)

    def _end(self) -> list[tuple]:
        rest = [p for pieces in self.open.values() for p in pieces]
        self.open, self.gaps = {}, []
        return rest

    def leftovers(self) -> Iterator[tuple]:
        for row, start, total, ids in self._end():
            yield row, start, total, ids, NO_SEQUENCE, 0

    def settle(self) -> None:
        """Ends with no open window: the leftovers in a row, the last window cut at powers of two."""
        rest = self._end()
        left = sum(len(p[3]) for p in rest)
        pieces, room = [], min(WINDOW, 1 << max(left.bit_length() - 1, 0))
        for row, start, total, ids in rest:
            while len(ids):
                pieces.append((row, start, total, ids[:room]))
                room -= len(pieces[-1][3])
                left -= len(pieces[-1][3])
                start, ids = start + len(pieces[-1][3]), ids[len(pieces[-1][3]):]
                if not room:
                    self._close(pieces)
                    pieces, room = [], min(WINDOW, 1 << max(left.bit_length() - 1, 0))

    def take(self) -> list[tuple]:
        done, self.done = self.done, []
        return done


def _batch(found: list[tuple], keep: bool) -> pa.RecordBatch:
    """Without ``keep``, finished pieces have no ids: only leftovers are read again."""
    crc = [zlib.crc32(np.ascontiguousarray(f[3], "<i4")) for f in found]
    lengths = [len(f[3]) for f in found]
    columns = [[f[0] for f in found], [f[1] for f in found], lengths, crc, [f[2] for f in found], [f[4] for f in found], [f[5] for f in found]]
    held = [f[3] if keep or f[4] == NO_SEQUENCE else None for f in found]
    ends = np.cumsum([0] + [0 if i is None else len(i) for i in held]).astype(np.int32)
    flat = np.concatenate([np.zeros(0, np.int32)] + [i for i in held if i is not None])
    void = pa.array([i is None for i in held], pa.bool_())
    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat), mask=void)
    return pa.record_batch([pa.array(x, pa.int64()) for x in columns] + [lists], names=NAMES)


def _packed(pieces: Iterator[tuple], merges: int, last: bool, windows: int, keep: bool) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    # a task numbers its sequences on from (round of merging, partition)
    packer, held = Packer((merges << 58) + (TaskContext.get().partitionId() << 32), windows), 0
    for row, start, total, ids in pieces:
        packer.add(row, start, total, ids)
        held += len(ids)
        if held > 1 << 20:
            if packer.done:
                yield _batch(packer.take(), keep)
            held = 0
    if last:
        packer.settle()
    yield _batch(packer.take() + list(packer.leftovers()), keep)


def _tokenised(files: tuple[str, str, str], end_id: int, windows: int, keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(*files)

        def pieces():
            for batch in batches:
                for row, text in zip(batch.column(0), batch.column(1), strict=True):
                    ids = np.append(tokens.ids(text.as_py() or ""), np.int32(end_id))
                    yield row.as_py(), 0, len(ids), ids

        yield from _packed(pieces(), 0, False, windows, keep)

    return run


def _merged(merges: int, last: bool, windows: int, keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces():
            for batch in batches:
                rows, starts, totals = (batch.column(i).to_pylist() for i in (0, 1, 4))
                for i, ids in enumerate(batch.column(7)):
                    yield rows[i], starts[i], totals[i], np.asarray(ids.values)

        yield from _packed(pieces(), merges, last, windows, keep)

    return run


def tokenizer_files(name: str = "byte_bpe_50k") -> tuple[str, str, str]:
    """The tokenizers file, the same vocabulary as ranks, and the pre-token pattern."""
    import public_tokenizers

    return public_tokenizers.path(f"{name}.json"), public_tokenizers.path(f"{name}.tiktoken"), public_tokenizers.PATTERN


def pack(
    docs: DataFrame, text_col: str = "text", files: tuple[str, str, str] | None = None, end_id: int = 1, windows: int = OPEN,
    keep_ids: bool = True,
) -> DataFrame:
    """(_row, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids): the pieces of all sequences.

    The ids of a text, then ``end_id``, lie in exactly one piece each; the pieces of a sequence fill
    it from offset 0 without gaps, to 2048 at most. A shorter sequence is meant to be padded to
    2048, unless its length is a power of two. A null or empty text is its end id alone. Rows are
    packed as they come, so repeated rows and repeated or null ids each have pieces; further
    columns are ignored; no rows give no pieces. ``_row`` is the number that ``with_row`` gives a
    row of a table. ``files`` are a tokenizer's, as in ``Tokens``. Without ``keep_ids`` the ids are left
    out of the result, whose lengths and checksums stay.

    Memory of a task: ``windows`` open windows, one text and a million tokens of output. Leftovers are merged in
    rounds, those of MERGED tasks by one, until one task can take what is left.
    """
    rows = c.with_row(docs.select(F.col(text_col).alias("text"))).select("_row", "text")
    found = c.stored(rows.mapInArrow(_tokenised(files or tokenizer_files(), end_id, windows, keep_ids), PIECE), "pack-first")
    tables, merges, last = [], 0, False
    while not last:
        tables.append(found.where(F.col("sequence_id") != NO_SEQUENCE))
        rest = found.where(F.col("sequence_id") == NO_SEQUENCE)
        tokens = rest.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")).first()["n"]
        parts = -(-tokens // (MERGED * windows * WINDOW))
        merges, last = merges + 1, parts <= 1
        # whole leftovers of tasks go together; each round leaves ``windows`` of them a task at most
        found = c.stored(rest.coalesce(max(1, parts)).mapInArrow(_merged(merges, last, windows, keep_ids), PIECE), "pack-merged")
    tables.append(found)
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out if keep_ids else out.drop("ids")


def pack_documents(docs: DataFrame) -> DataFrame:
    """The pieces of ``documents`` with their doc_id, without the ids themselves."""
    docs = c.as_table(docs)
    ids = c.with_row(docs.select("doc_id"))
    pieces = pack(docs, keep_ids=False)
    return pieces.join(ids, "_row").select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(c.documents(spark, sf_dir))
