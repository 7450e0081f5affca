from __future__ import annotations

import math
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from tarnwerk.functions.scalars import rounded
from tarnwerk.operators import calibration, retrieval
from tarnwerk.operators.topk import bags, best_by_terms


@pytest.fixture
def small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def _brute(rows, queries, k):
    out = set()
    for q, ws in queries.items():
        hits = [(-round(sum(w * rows[d][t] for t, w in ws.items() if t in rows[d]), 6), d) for d in rows if d != q and ws.keys() & rows[d].keys()]
        out |= {(q, d, -s, i + 1) for i, (s, d) in enumerate(sorted(hits)[:k])}
    return out


@pytest.mark.parametrize("kind", ["bigint", "int", "string"])
@pytest.mark.parametrize("block", [7, 1000])
def test_best_rows_equal_all_pairs(spark, small_batches, kind, block):
    """Common and rare terms, equal rows, queries without any hit, several batches and blocks of queries."""
    rnd, key = random.Random(5), (lambda i: f"d{i:04d}") if kind == "string" else int
    rows = {key(i): {f"t{int(rnd.expovariate(0.1))}": rnd.choice([0.5, 1.0, 1.25, rnd.random() + 1e-4]) for _ in range(rnd.randrange(1, 12))} for i in range(900)}
    rows |= {key(i): {"t1": 1.0, "t2": 0.5} for i in range(900, 1100)}  # ties over several batches
    queries = {d: rows[d] for d in list(rows)[::45]} | {key(5000): {"none": 1.0}}
    w = spark.createDataFrame([(d, t, x) for d, r in rows.items() for t, x in r.items()], f"id {kind}, term string, w double").repartition(3)
    q = spark.createDataFrame([(d, t, x) for d, r in queries.items() for t, x in r.items()], f"query_id {kind}, term string, weight double")
    got = {tuple(r) for r in best_by_terms(bags(w, "id", "w"), q, "id", 5, block=block).collect()}
    want = _brute(rows, queries, 5)
    assert {(q, d, n) for q, d, _, n in got} == {(q, d, n) for q, d, _, n in want}
    assert sorted(s for _, _, s, _ in got) == pytest.approx(sorted(s for _, _, s, _ in want), abs=2e-6)


def _texts(spark, n=400):
    rnd = random.Random(6)
    said = [" ".join(rnd.choice("ramp belt crane hook valve dust oil floor".split()) for _ in range(rnd.randrange(0, 9))) for _ in range(n)]
    return said, spark.createDataFrame([*enumerate(said), (None, "ramp belt"), (7, "crane again"), (8, None)], "doc_id bigint, text string").repartition(3)


def test_bm25_of_texts_equals_that_of_counts(spark, small_batches):
    """A document in two rows, one without an id and some without text."""
    _, docs = _texts(spark)
    c = retrieval.term_counts(docs, "doc_id", "text")
    q = c.where("doc_id % 50 = 7").select(F.col("doc_id").alias("query_id"), "term", F.col("tf").alias("qtf"))
    got = retrieval.bm25_bags(retrieval.term_bags(docs, "doc_id", "text"), F.col("doc_id") % 50 == 7, "doc_id", 10)
    lens = {r.doc_id: r.n for r in c.groupBy("doc_id").agg(F.sum("tf").alias("n")).collect()}
    tf = {(r.doc_id, r.term): r.tf for r in c.collect()}
    df, mean = {}, sum(lens.values()) / len(lens)
    for _, t in tf:
        df[t] = df.get(t, 0) + 1
    idf = {t: math.log(1 + (len(lens) - n + 0.5) / (n + 0.5)) for t, n in df.items() if n <= 0.98 * len(lens)}
    rows = {}
    for (d, t), n in tf.items():
        if d is not None:
            rows.setdefault(d, {})[t] = n * 2.5 / (n + 1.5 * (0.25 + 0.75 * lens[d] / mean))
    queries = {d: {t: idf[t] * (1 + math.log(1 + tf[d, t])) for t in rows[d] if t in idf} for d in rows if d % 50 == 7}
    want = {(q, d, n) for q, d, _, n in _brute(rows, queries, 10)}
    for x in (got, retrieval.bm25(c, q, "doc_id", 10)):
        assert {(r.query_id, r.doc_id, r.rank_no) for r in x.collect()} == want


def test_bm25_of_no_documents(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert retrieval.bm25_bags(retrieval.term_bags(none, "doc_id", "text"), F.col("doc_id") % 2 == 0, "doc_id", 3).count() == 0


@pytest.mark.parametrize("name", ["tx8_bm25", "tx10_rank_fusion"])
def test_bm25_makes_no_row_per_query_document_and_term(spark, name):
    """The join of queries and postings grew with the square of the documents."""
    plan = __spark_entry__.queries()[name](spark, __spark_entry__.SMALLEST)._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and not re.search(r"Join.*\bterm#", plan)


def _sql(name, folder):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    return con.sql(f"SELECT * FROM ({__spark_entry__.oracle_sql()[name]})").fetchall()


def test_fusion_equals_sql_with_equal_lengths_and_no_ids(spark, tmp_path):
    """Most documents have one length, so the nearest are those of the smallest ids; some have no id or no length."""
    rnd = random.Random(8)
    text = lambda: " ".join(rnd.choice("ramp belt crane hook valve dust".split()) for _ in range(5))
    rows = [(i if i % 37 else None, text(), rnd.choice([30, 30, 30, 31, 36, None])) for i in range(1, 700)] + [(200, text(), 30), (300, text(), 29)]
    spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint").write.parquet(str(tmp_path / "documents.parquet"))
    got = __spark_entry__.queries()["tx10_rank_fusion"](spark, str(tmp_path)).select("query_id", "doc_id", "fused").collect()
    plain = lambda x: sorted((q, d, round(f, 9)) for q, d, f in x)
    assert plain(got) == plain(_sql("tx10_rank_fusion", tmp_path)) and got


@pytest.mark.parametrize("max_terms", [0, 1_000])
def test_nearest_texts_equal_the_join_of_all_weights(spark, small_batches, max_terms):
    """With idf broadcast or joined by shuffle: no row per query, document and term, and the scores of the join of them all."""
    _, docs = _texts(spark)
    w = retrieval.tf_idf(retrieval.term_counts(docs, "doc_id", "text"), "doc_id", docs.count())
    of = {}
    for r in w.where("doc_id is not null").collect():
        of.setdefault(r.doc_id, {})[r.term] = r.weight
    want = _brute(of, {d: of[d] for d in of if d % 50 == 7}, 5)
    v = retrieval.TermVectors(docs, "doc_id", "text", max_terms=max_terms)
    queries = docs.where("doc_id % 50 = 7").select(F.col("doc_id").alias("query_id"))
    near = v.nearest(queries, 5)
    assert not re.search(r"Join.*\bterm#", near._jdf.queryExecution().toString())
    for x in (near, calibration.nearest_by_terms(w, queries.distinct(), "doc_id", 5)):
        assert {(r.query_id, r.doc_id, r.rank_no) for r in x.collect()} == {(q, d, n) for q, d, _, n in want}
    got = {(r.doc_id, r.term): r.weight for r in v.weights(docs.where("doc_id < 60")).collect()}
    assert got == pytest.approx({(d, t): x for d, ws in of.items() if d < 60 for t, x in ws.items()})


def test_rounded_again_like_sql(spark):
    """0.526565 lies below its half in binary, 0.5 does not."""
    values = [0.526565, 0.508925, 0.556765, 2.5, -2.5, 0.1234565]
    want = duckdb.sql("SELECT round(x, 5) FROM (SELECT unnest([" + ", ".join(f"{v}::double" for v in values) + "]) AS x)").fetchall()
    got = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").select("i", rounded(F.col("v"), 5).alias("r")).orderBy("i").collect()
    assert [r.r for r in got] == [r[0] for r in want]


MATCHED = ["tx11_merged", "ag35_match_metrics", "tx13_thresholds", "wn19_reranked", "tx12_banded_matches", "tx6_keyphrases"]


@pytest.fixture(scope="module")
def odd_documents(spark, tmp_path_factory):
    """Equal texts, texts of one common term, none at all and null facts."""
    rnd, folder = random.Random(9), tmp_path_factory.mktemp("odd")
    words = "ramp belt crane hook valve dust oil floor hatch rope chain drum".split()
    texts = ["crane hook"] * 5 + ["", None, "a"] + [" ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 50))) for _ in range(90)]
    rows = []
    for i in range(1, 900):
        x = rnd.choice(texts)
        rows.append((i, x and f"crane {x}", rnd.choice(["en", "de", None]), rnd.choice(["a", "b", " "]), rnd.choice([None, 150, 400, 700]), rnd.choice([None, 1, 2])))
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, location_id bigint").write.parquet(str(folder / "documents.parquet"))
    return folder


@pytest.mark.parametrize("name", MATCHED)
def test_matches_make_no_row_per_query_document_and_term(spark, odd_documents, name):
    """None of the plans that ran sets queries against documents by a join; the result is that of SQL."""
    bus, store = spark.sparkContext._jsc.sc().listenerBus(), spark._jsparkSession.sharedState().statusStore()
    bus.waitUntilEmpty(30_000)
    had = store.executionsCount()
    df = __spark_entry__.queries()[name](spark, str(odd_documents))
    plain = lambda rows: sorted((tuple(round(v, 4) if isinstance(v, float) else v for v in r) for r in rows), key=repr)
    got = plain(df.collect())
    bus.waitUntilEmpty(30_000)
    ran = store.executionsList()
    plans = [ran.apply(i).physicalPlanDescription() for i in range(had, ran.size())]
    assert plans and not [p for p in plans if re.search(r"NOT \(query_id#\w+ = doc_id#", p)]
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{odd_documents}/documents.parquet/*.parquet'")
    want = con.sql(__spark_entry__.oracle_sql()[name])
    assert got == plain(con.sql(f"SELECT {', '.join(df.columns)} FROM want").fetchall()) and got
