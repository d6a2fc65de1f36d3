"""Row numbers come from storage: other splits between two steps change no result."""

import itertools
import random
from collections import Counter

import pytest
from starloom.llm import common as c
from starloom.llm import packing as P
from starloom.llm.jaccard_join import jaccard_classes
from starloom.llm.language_model import score_texts
from starloom.llm.passage_dedup import remove_passages
from starloom.llm.repeated_text import remove_repeats
from starloom.llm.vector_dedup import link_vectors

import corpus_pipeline

SPLITS = "spark.sql.files.minPartitionNum"


@pytest.fixture
def resplit(spark, monkeypatch):
    """Every stored step is followed by scans of another number of splits."""
    numbers = itertools.cycle((1, 23, 4, 11))
    plain = c.stored

    def stored(df, label):
        out = plain(df, label)
        spark.conf.set(SPLITS, str(next(numbers)))
        return out

    monkeypatch.setattr(c, "stored", stored)
    monkeypatch.setattr(corpus_pipeline, "stored", stored)
    yield
    spark.conf.unset(SPLITS)


@pytest.fixture
def table(spark, prose, tmp_path):
    """Texts with copies, edited copies and shared passages, in three files of many row groups."""
    rng, shared = random.Random(5), prose(70, 99)
    texts = [prose(60 + 3 * i, i) for i in range(12)]
    texts += texts[:4] + [t.replace("ka", "kar", 1) for t in texts[4:8]]
    texts += [prose(30, 50 + i) + "\n" + shared + "\n" + prose(30, 80 + i) for i in range(4)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(30, None), (31, "")]
    rng.shuffle(rows)
    path = str(tmp_path / "documents")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.option("parquet.block.size", 1024).parquet(path)
    return spark.read.parquet(path)


def digest(df, *columns):
    return sorted(tuple(str(r[k]) for k in columns) for r in df.select(*columns).collect())


TEXT_OPERATORS = {
    "op7": (remove_repeats, ("doc_id", "n_bytes", "spans")),
    "op8": (score_texts, ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")),
    "op9": (remove_passages, ("doc_id", "text", "n_duplicated", "n_removed")),
    "op10": (jaccard_classes, ("doc_id", "n_shingles", "component_id")),
    "pipeline": (lambda d: corpus_pipeline.near_duplicates(d.sparkSession, d, ""), ("doc_id", "text")),
}


@pytest.mark.parametrize("name", TEXT_OPERATORS)
def test_texts_stay_with_their_rows(spark, table, request, name):
    operator, columns = TEXT_OPERATORS[name]
    want = digest(operator(table), *columns)
    request.getfixturevalue("resplit")
    assert digest(operator(table), *columns) == want


def test_pieces_stay_with_their_rows(table, request):
    """Where a text is cut depends on the tasks; whose tokens the pieces hold does not."""
    tokens = P.tokens_of(*P.tokenizer_files())
    want = {r["doc_id"]: len(tokens.ids(r["text"] or "")) + 1 for r in table.collect()}
    request.getfixturevalue("resplit")
    found, total = P.pack_documents(table).collect(), Counter()
    for r in found:
        total[r["doc_id"]] += r["length"]
    assert total == want and all(r["doc_tokens"] == want[r["doc_id"]] for r in found)


def test_vectors_stay_with_their_rows(spark, tmp_path, request):
    rng, path = random.Random(3), str(tmp_path / "vectors")
    base = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(20)]
    rows = [(i, base[i % 20]) for i in range(60)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4).write.parquet(path)
    vectors = spark.read.parquet(path)
    request.getfixturevalue("resplit")
    found = digest(link_vectors(vectors), "vec_id", "n_links", "component_id")
    assert found == sorted((str(i), "2", str(i % 20)) for i in range(60))


def test_numbers_are_of_storage(spark, table):
    want = {r["_row"]: r["doc_id"] for r in c.with_row(table).collect()}
    spark.conf.set(SPLITS, "31")
    try:
        again = {r["_row"]: r["doc_id"] for r in c.with_row(table.where("doc_id >= 0")).select("_row", "doc_id").collect()}
    finally:
        spark.conf.unset(SPLITS)
    assert again == want and len(want) == table.count() and min(want) >= 0


def test_files_of_one_name_in_two_folders(spark, tmp_path):
    for k in (1, 2):
        spark.range(k * 10, k * 10 + 5).coalesce(1).write.parquet(str(tmp_path / f"k={k}"))
        (file,) = (tmp_path / f"k={k}").glob("*.parquet")
        file.rename(file.with_name("part-0.parquet"))
        for crc in (tmp_path / f"k={k}").glob(".*.crc"):
            crc.unlink()
    both = c.with_row(spark.read.parquet(str(tmp_path)))
    assert both.select("_row").distinct().count() == 10


def test_other_frames_and_clashing_columns(spark, docs):
    made = spark.createDataFrame([(1, "a"), (1, "a"), (None, None)], "doc_id long, text string")
    assert c.with_row(made).select("_row").distinct().count() == 3
    clash = docs([(1, "x"), (2, "y")], "_metadata long, file_path string")
    assert sorted(r["_metadata"] for r in c.with_row(clash, "at").collect()) == [1, 2]
    assert c.with_row(docs([])).collect() == []
    with pytest.raises(ValueError):
        c.with_row(clash.selectExpr("*", "explode(array(1, 2)) AS twice"))
