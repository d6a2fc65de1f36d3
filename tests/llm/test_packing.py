import zlib

import numpy as np
import pytest
from starloom.llm import packing as P


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(P.tokenizer_files()[0])


def check(pieces, texts, tokenizer):
    """Every id in one piece, sequences without gaps; returns sequence lengths."""
    ids = {k: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for k, t in enumerate(texts)}
    at = dict.fromkeys(ids, 0)
    for p in sorted(pieces, key=lambda p: (p["_row"], p["start"])):
        k = p["key"]
        own = ids[k][p["start"]: p["start"] + p["length"]]
        assert p["start"] == at[k] and p["length"] == len(own) > 0 and p["ids"] == own
        assert p["ids_crc32"] == zlib.crc32(np.array(own, "<u4").tobytes()) and p["doc_tokens"] == len(ids[k])
        at[k] += len(own)
    assert at == {k: len(v) for k, v in ids.items()}
    lengths = {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["offset"] == lengths.get(p["sequence_id"], 0)
        lengths[p["sequence_id"]] = p["offset"] + p["length"]
    return list(lengths.values())


TEXTS = [None, "", "a", "special <|endoftext|> text", "Ünïcödé  \n\n text  ", "word " * 5000] + [f"document {i} " * (i % 90) for i in range(300)]


@pytest.mark.parametrize("parts, merged", [(1, 16), (6, 2)])
def test_pieces_hold_every_id(spark, docs, tokenizer, monkeypatch, parts, merged):
    from starloom.session import materialise

    monkeypatch.setattr(P, "MERGED", merged)
    frame = spark.createDataFrame([(k, t, "x") for k, t in enumerate(TEXTS)], "key long, text string, ids string").repartition(parts, "key")
    table = materialise(frame, "pack")
    keys = P.c.with_row(table).select("_row", "key")
    pieces = [r.asDict() for r in P.pack(table, windows=3).join(keys, "_row").collect()]
    lengths = check(pieces, TEXTS, tokenizer)
    assert max(lengths) <= P.WINDOW
    padding = sum(P.WINDOW - n for n in lengths if n & (n - 1))
    assert padding < 0.02 * sum(lengths)


def test_repeated_and_null_ids(docs):
    found = P.pack_documents(docs([(7, "x y"), (7, "x y"), (None, None)])).collect()
    starts = sorted((r["doc_id"] or 0, r["doc_tokens"]) for r in found if r["start"] == 0)
    assert starts == [(0, 1), (7, 3), (7, 3)] and sum(r["length"] for r in found) == 7


def test_empty_table(docs):
    assert P.pack(docs([])).collect() == []


def test_the_fast_library_gives_the_same_ids(tokenizer, spark, sf):
    tokens = P.Tokens(*P.tokenizer_files())
    texts = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    for text in texts + ["it's  we'll\n\n x ", "日本語 ​", "a<|endoftext|>b", "\x00\x01", "  \n \t "]:
        assert tokens.ids(text or "").tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


def test_best_fit_and_the_fullest_goes():
    packer = P.Packer(0, windows=2)
    for row, n in enumerate((2000, 1000, 40, 1500)):
        packer.add(row, 0, n, np.zeros(n, np.int32))
    # 40 fits best beside 2000; 1500 fits nowhere, so the fullest window (8 tokens free) goes
    done = packer.take()
    assert [(d[0], len(d[3]), d[5]) for d in done] == [(0, 2000, 0), (2, 40, 2000)]
    assert sorted(packer.free) == [548, 1048]
