import __spark_entry__ as entry
import corpus_pipeline
import duckdb
import pytest
from starloom.llm import queries as Q
from starloom.session import materialise

TABLES = ("documents", "labels", "embeddings", "benchmark")


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in Q.QUERIES if n.startswith("op")) == list(range(1, 14))
    assert Q.QUERIES.keys() <= entry.queries().keys() and Q.SQL.keys() <= entry.oracle_sql().keys()
    assert entry.queries()["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_queries_agree_with_their_sql(spark, sf, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    found = Q.QUERIES[name](spark, sf)
    columns = sorted(found.columns)
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({Q.SQL[name]})").fetchall()
    got = [tuple(r) for r in found.select(*columns).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_stages_keep_their_contract(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, sf), "stage")
        rows[name] = docs.collect()
        if name != "packing":
            assert docs.columns == columns
    judged = {r["doc_id"]: r["kept"] for r in Q.QUERIES["op1_quality_rules"](spark, sf).collect()}
    assert {r["doc_id"] for r in rows["quality rules"]} == {i for i, k in judged.items() if k}
    assert {r["text"] for r in rows["quality rules"]} <= set(before.values())
    # one of each group: no two that stay are linked, each that went is linked with a group that stays
    stay = {r["doc_id"] for r in rows["n-gram Jaccard join"]}
    texts = {r["doc_id"]: (r["text"] or "").lower().encode().split() for r in rows["quality rules"]}
    sets = {i: set(zip(*(w[k:] for k in range(5)), strict=False)) or ({tuple(w)} if w else set()) for i, w in texts.items()}
    linked = lambda a, b: len(sets[a] & sets[b]) * 5 >= 4 * len(sets[a] | sets[b]) > 0
    ids = sorted(sets)
    comp = {i: i for i in ids}
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if comp[a] != comp[b] and linked(a, b):
                low, high = sorted((comp[a], comp[b]))
                comp = {i: low if r == high else r for i, r in comp.items()}
    assert stay == set(comp.values())
    assert len(rows["PII"]) == len(stay)
    assert {r["doc_id"] for r in rows["mixing"]} <= stay
    tokens = {}
    for r in rows["packing"]:
        tokens[r["doc_id"]] = tokens.get(r["doc_id"], 0) + r["length"]
    copies = {}
    for r in rows["mixing"]:
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
    totals = {r["doc_id"]: r["doc_tokens"] for r in rows["packing"]}
    assert tokens == {i: totals[i] * n for i, n in copies.items()}


def test_run_is_all_stages(spark, sf):
    found = corpus_pipeline.run(spark, sf)
    assert found.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and found.count() > 50


def test_near_copies_at_five_words_and_four_fifths_go(spark, docs, prose):
    base = prose(120, 3).split()
    copies = []
    for places in ((20, 80), (10, 60, 110)):  # 5-word Jaccard 106/126 and 101/131, 3-word 112/124 and 109/127
        copies.append(" ".join(f"edit{i}" if i in places else w for i, w in enumerate(base)))
    stage = dict(corpus_pipeline.STAGES)["n-gram Jaccard join"]
    stay = stage(spark, docs([(0, " ".join(base)), (1, copies[0]), (2, copies[1]), (3, prose(120, 4))]), "")
    assert sorted(r["doc_id"] for r in stay.collect()) == [0, 2, 3]
    assert stay.columns == ["doc_id", "text"]
    # three edits in 140 words: 121/151 is 5-word 0.801, 3-word 129/147 is 0.878
    base = prose(140, 5).split()
    edited = " ".join(f"edit{i}" if i in (30, 70, 110) else w for i, w in enumerate(base))
    assert [r["doc_id"] for r in stage(spark, docs([(0, " ".join(base)), (1, edited)]), "").collect()] == [0]


def test_the_join_stage_keeps_clashing_columns_and_rows_without_text(spark, docs, prose):
    stage = dict(corpus_pipeline.STAGES)["n-gram Jaccard join"]
    text = prose(60, 9)
    rows = [(4, text, -7, "a"), (3, text, 5, "b"), (None, None, 2, None), (8, None, 9, "c"), (9, "", 4, "d"), (9, "", 4, "d")]
    table = docs(rows, "doc_id long, text string, _row int, class_row string")
    found = stage(spark, table, "")
    assert found.columns == table.columns
    want = [rows[1], *rows[2:]]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == sorted(want, key=repr)
    assert stage(spark, docs([], "doc_id long, text string, _row int"), "").collect() == []
