import json
import os

import pytest
from pyspark.sql import functions as F
from starloom.schemas import INT, LONG, STRING, WHOLE_18, struct
from starloom.sinks import write_csv
from starloom.sources import (
    conform_types,
    label_pairs,
    mapping_for,
    read_csv,
    read_json,
    read_json_tree,
    read_whole_text,
    stage_json,
)


def put(folder, name, text):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_glob_depth_and_tree(spark, tmp_path, rows):
    root = str(tmp_path)
    put(root, "song_data/A/B/C/one.json", '{"song_id": "S1", "year": 0}\n')
    put(root, "song_data/A/B/D/two.json", '{"song_id": "S2"}\n{"song_id": "S3", "year": 2000}\n')
    put(root, "song_data/A/B/D/notes.txt", "not data")
    put(root, "song_data/A/shallow.json", '{"song_id": "S9"}\n')
    schema = struct(song_id=STRING, year=INT)
    deep = read_json(spark, f"{root}/song_data", schema, depth=3)
    # Every record of a file counts, not only its first.
    assert rows(deep) == [("S1", 0), ("S2", None), ("S3", 2000)]
    assert rows(read_json_tree(spark, f"{root}/song_data", schema), "song_id") == [
        ("S1",), ("S2",), ("S3",), ("S9",)
    ]


def test_json_paths_are_positional(spark, tmp_path, rows):
    root = str(tmp_path)
    good = json.dumps({"a": "x", "deep": {"n": 7}, "long": "abcdef"}) + "\n"
    put(root, "log.json", good)
    schema = struct(first=LONG, second=STRING)
    nested = stage_json(spark, f"{root}/log.json", schema, ["$.deep.n", "$['a']"])
    assert rows(nested) == [(7, "x")]
    flat = stage_json(spark, f"{root}/log.json", struct(p=STRING, q=STRING), ["$['long']", "$.none"])
    assert rows(flat) == [("abcdef", None)]
    with pytest.raises(ValueError):
        stage_json(spark, f"{root}/log.json", schema, ["$.a"])
    by_name = stage_json(spark, f"{root}/log.json", struct(a=STRING, long=STRING), widths={"long": 3})
    assert ("x", "abc") in rows(by_name)


@pytest.mark.parametrize("bad", ["broken", '{"a": "x", "n": "no number"}'])
@pytest.mark.parametrize("paths", [None, ["$.a", "$.n"], ["$.a", "$['n']", "$.deep.n"]])
def test_bad_json_stops_the_load_or_is_kept(spark, tmp_path, rows, bad, paths):
    root = str(tmp_path)
    put(root, "log.json", '{"a": "x", "n": 3, "deep": {"n": 4}}\n' + bad + "\n")
    names = {"a": STRING, "n": LONG} | ({"deep_n": LONG} if paths and len(paths) == 3 else {})
    with pytest.raises(Exception, match="(?i)malformed|bad record|FAILED_READ_FILE"):
        stage_json(spark, f"{root}/log.json", struct(**names), paths).collect()
    kept = stage_json(spark, f"{root}/log.json", struct(**names), paths, mode="keep").cache()
    assert sorted(r["_bad_record"] or "" for r in kept.collect()) == ["", bad]
    assert [r["n"] for r in kept.collect() if r["_bad_record"] is None] == [3]
    with pytest.raises(ValueError):
        stage_json(spark, root, struct(**names), paths, mode="drop")


def test_bad_json_in_trees(spark, tmp_path):
    put(str(tmp_path), "x/log.json", '{"a": 1}\n{"a": \n')
    for read in (lambda **o: read_json(spark, str(tmp_path), struct(a=LONG), depth=1, **o),
                 lambda **o: read_json_tree(spark, str(tmp_path), struct(a=LONG), **o)):
        with pytest.raises(Exception, match="(?i)malformed|bad record|FAILED_READ_FILE"):
            read().collect()
        assert sorted(r["_bad_record"] or "" for r in read(mode="keep").collect()) == ["", '{"a": ']


def test_bad_csv_stops_the_load_or_is_kept(spark, tmp_path):
    put(str(tmp_path), "a.csv", "x,y\n1,one\nnone,two\n")
    declared = struct(x=LONG, y=STRING)
    with pytest.raises(Exception, match="(?i)malformed|bad record|FAILED_READ_FILE"):
        read_csv(spark, str(tmp_path), declared).collect()
    kept = read_csv(spark, str(tmp_path), declared, mode="keep").collect()
    assert [(r["x"], r["y"], r["_bad_record"]) for r in kept] == [(1, "one", None), (None, "two", "none,two")]


@pytest.mark.parametrize("quote_all", [False, True])
def test_csv_round_trip(spark, tmp_path, rows, quote_all):
    texts = ["a\nb", "a\r\nb", "\r", "\n", "  both  ", "tail ", " ", "\t", 'say "x", then y', "", None, "é\\n"]
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, text string").withColumn("last", F.when(F.col("id") != 4, F.col("id") + 0.5))
    write_csv(frame, str(tmp_path / "csv"), quote_all=quote_all, max_records_per_file=5)
    got = read_csv(spark, str(tmp_path / "csv"), frame.schema)
    assert sorted(tuple(r) for r in got.collect()) == [(i, t, None if i == 4 else i + 0.5) for i, t in enumerate(texts)]


def test_whole_number_staging(spark, rows):
    frame = spark.createDataFrame([("210.5", "7"), ("209.5", "x")], "length string, year string")
    declared = struct(length=WHOLE_18, year=INT)
    got = conform_types(frame, declared, tolerant=True)
    assert [(float(a), b) for a, b in rows(got)] == [(210.0, None), (211.0, 7)]


def test_csv_headers_quotes_and_blanks(spark, tmp_path, rows):
    root = str(tmp_path / "csv")
    for i, line in enumerate(['Tin Harbour,"The ""Q""","Bern, CH"', ",,", 'B,"x;y",']):
        put(root, f"{i}.csv", f"artist,song,location\n{line}\n")
    got = read_csv(spark, root, struct(artist=STRING, song=STRING, location=STRING))
    assert rows(got) == [
        ("B", "x;y", None), ("Tin Harbour", 'The "Q"', "Bern, CH"), (None, None, None)
    ]
    put(root, "semi/s.csv", "City;Count\nSilver Spring;21\n")
    assert rows(read_csv(spark, f"{root}/semi", struct(City=STRING, Count=INT), sep=";")) == [
        ("Silver Spring", 21)
    ]


DOCUMENT = """
/* I94CIT & I94RES - countries
   value i94cntyl */
libname library 'x' ;
proc format ;
/*  value i94cntyl
  582 =  'MEXICO Air Sea, and Not Reported (I-94, no land arrivals)'
   236='AFGHANISTAN'
;
/* I94PORT - ports */
value $i94prtl
  'ALC' = 'ALCAN, AK   '
  'XXX'\t=\t'NOT REPORTED/UNKNOWN' ;
/* I94MODE */
value i94model
  1 = 'Air'
  9 = 'Not reported' ;
/* ADDR */
value i94addrl
  'AL'='ALABAMA'
  'AK'='A' ;
/* VISA
   I94VISA - categories:
   1 = Business
   2 = Pleasure */
"""


def test_label_document(spark, tmp_path, rows):
    put(str(tmp_path), "labels.sas", DOCUMENT)
    pairs = label_pairs(read_whole_text(spark, str(tmp_path)))
    assert rows(mapping_for(pairs, "i94cntyl")) == [
        ("236", "AFGHANISTAN"), ("582", "MEXICO Air Sea, and Not Reported (I-94, no land arrivals)")
    ]
    assert rows(mapping_for(pairs, "i94prtl")) == [
        ("ALC", "ALCAN, AK "), ("XXX", "NOT REPORTED/UNKNOWN")
    ]
    assert rows(mapping_for(pairs, "i94model")) == [("1", "Air"), ("9", "Not reported")]
    # By position: a label shorter than its code, or as long, is no problem.
    assert rows(mapping_for(pairs, "i94addrl")) == [("AK", "A"), ("AL", "ALABAMA")]
    assert rows(mapping_for(pairs, "I94VISA")) == [("1", "Business"), ("2", "Pleasure")]
