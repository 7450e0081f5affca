from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tarnwerk.sources import files
from tarnwerk.streaming import facts


def test_csv_of_both_encodings(spark, tmp_path):
    (tmp_path / "u.csv").write_bytes("a,b\n1,é\n".encode())
    (tmp_path / "l.csv").write_bytes("a,b\n1,é\n".encode("latin-1"))
    for name in ("u.csv", "l.csv"):
        assert files.read_csv(spark, str(tmp_path / name)).first().b == "é"


def test_json_lines_leave_out_what_is_no_json(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\nbroken\n{"a": 2}\n')
    assert {r.a for r in files.read_json_lines(spark, str(tmp_path / "x.jsonl"), "a int").collect()} == {1, 2}


def test_round_trips(spark, tmp_path):
    df = spark.createDataFrame([(1, "x,\"y\"\nz"), (2, None)], "a int, b string")
    for p in files.write_table(df, str(tmp_path / "t"), ("parquet", "csv", "json")):
        got = files.read_table(spark, p).select(F.col("a").cast("int").alias("a"), "b").orderBy("a").collect()
        assert [(r.a, r.b) for r in got] == [(1, "x,\"y\"\nz"), (2, None)], p
    files.write_with_preview(df, str(tmp_path / "p"), 1)
    assert files.read_csv(spark, str(tmp_path / "p.preview")).count() == 1


def test_resume(spark, tmp_path):
    out = str(tmp_path / "chunks")
    want = spark.createDataFrame([(i,) for i in range(4)], "chunk int")
    assert files.pending(spark, want, out, "chunk").count() == 4
    for _ in range(2):
        files.append_chunks(spark.createDataFrame([(0, "a"), (1, "b")], "chunk int, v string"), out, "chunk")
    assert spark.read.parquet(out).count() == 2
    assert {r.chunk for r in files.pending(spark, want, out, "chunk").collect()} == {2, 3}


def test_stream_equals_batch(spark, tmp_path):
    rows = [(i % 3, dt.datetime(2024, 1, 1 + i % 5, i % 24), float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "u int, ts timestamp_ntz, v double")
    df.write.parquet(str(tmp_path / "in"))
    s = facts.read_events(spark, str(tmp_path / "in"), df.schema, 10)
    facts.run_once(facts.windowed_counts(s, "ts", ["u"], measures={"total": F.col("v")}), "facts_out", str(tmp_path / "cp"), "complete")
    a = sorted(map(tuple, spark.table("facts_out").collect()))
    b = sorted(map(tuple, facts.windowed_counts(df, "ts", ["u"], measures={"total": F.col("v")}).collect()))
    assert a == b and len(a) == 15


def test_cases_by_suffix(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\n\n two \n")
    (tmp_path / "a.csv").write_text("ID,description\n7,three\n8,\n")
    (tmp_path / "a.jsonl").write_text('{"text": "four"}\n{"title": "five", "case_id": "c"}\n')
    (tmp_path / "a.json").write_text('[{"query": "six"}]')
    got = {k: sorted((r.case_id, r.query) for r in files.read_cases(spark, str(tmp_path / f"a.{k}")).collect()) for k in ("txt", "csv", "jsonl", "json")}
    assert [q for _, q in sorted(got["txt"], key=lambda x: x[1])] == ["one", "two"] and got["csv"] == [("7", "three")]
    assert ("c", "five") in got["jsonl"] and len(got["jsonl"]) == 2 and got["json"][0][1] == "six"
    sample = spark.createDataFrame([("s", "sample")], "case_id string, query string")
    assert files.first_source(spark, [None, str(tmp_path / "none.txt")], sample).count() == 1
    assert files.first_source(spark, [str(tmp_path / "a.txt")], sample).count() == 2
    with pytest.raises(ValueError):
        files.read_cases(spark, str(tmp_path / "a.xml"))


def test_chunks_have_a_manifest_and_one_length(spark, tmp_path):
    path = str(tmp_path / "v")
    wanted = spark.createDataFrame([(1,), (2,)], "part int")
    files.append_chunks(spark.createDataFrame([(1, [1.0, 2.0]), (1, [0.0, 1.0])], "part int, v array<double>"), path, "part")
    assert [tuple(r) for r in files.manifest(spark, path, "part", "v").collect()] == [(1, 2, 2)]
    with pytest.raises(ValueError):
        files.merged_chunks(spark, path, "part", "v", wanted)
    files.append_chunks(spark.createDataFrame([(2, [1.0, 2.0])], "part int, v array<double>"), path, "part")
    assert files.merged_chunks(spark, path, "part", "v", wanted).count() == 3
    assert files.write_report(spark.createDataFrame([(1, None)], "n int, x string"), str(tmp_path / "r")) == {"n": 1, "x": None}


def test_stored_index_scores_like_the_live_one(spark, tmp_path):
    from tarnwerk.operators import learning, retrieval

    docs = spark.createDataFrame([(i, " ".join(w for k, w in enumerate("ramp belt crane hook valve dust".split()) if (i >> k) & 1)) for i in range(40)], "doc_id int, text string")
    c = retrieval.term_counts(docs, "doc_id", "text", up_to=1)
    q = c.where("doc_id % 10 = 7").select(F.col("doc_id").alias("query_id"), "term", F.col("tf").alias("qtf"))
    retrieval.write_index(c, str(tmp_path / "ix"), "doc_id", min_df=1, max_df=0.98)
    key = lambda df: sorted((r.query_id, r.doc_id, r.rank_no) for r in df.collect())
    live, stored = retrieval.bm25(c, q, "doc_id", 5), retrieval.search_index(spark, str(tmp_path / "ix"), q, "doc_id", 5)
    assert key(live) == key(stored) and live.count() > 0
    lexical = lambda n: retrieval.bm25(c, q, "doc_id", n)
    assert key(retrieval.search(" Keyword ", lexical, None, ["query_id", "doc_id"], 5)) == key(live)
    assert key(retrieval.search("rrf", lexical, lexical, ["query_id", "doc_id"], 5)) == key(live)
    with pytest.raises(ValueError):
        retrieval.search("magic", lexical, lexical, ["query_id", "doc_id"], 5)
    v = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.9, 0.1]), (2, [0.0, 1.0]), (None, [1.0, 1.0])], "c int, v array<double>")
    assert {r.c: r.theme for r in learning.theme_layer(v, "c", "v", 0.3).collect()} == {0: 0, 1: 0, 2: 1, None: None}
