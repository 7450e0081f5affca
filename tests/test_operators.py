from __future__ import annotations

import datetime as dt
import random

import numpy as np
from pyspark.sql import functions as F

from tarnwerk.functions import scalars, text
from tarnwerk.operators import aggregates, hierarchy, joins, learning, metrics, retrieval, sampling, windows
from tarnwerk.plans import events


def one(spark, c, **cols):
    return spark.createDataFrame([tuple(cols.values())], ", ".join(f"{k} string" for k in cols)).select(c).first()[0]


def test_ids_and_truth(spark):
    for raw, want in ((" 12.0 ", "12"), ("12", "12"), ("nan", None), ("  ", None), (None, None), ("a7", "a7"), ("007", "007")):
        assert one(spark, scalars.norm_id(F.col("x")), x=raw) == want
    assert [one(spark, scalars.truthy(F.col("x")), x=v) for v in ("X", " yes ", "T", "0", None, "")] == [True, True, True, False, False, False]
    assert [one(spark, scalars.three_valued(F.col("x")), x=v) for v in ("y", "N", "?", None)] == [True, False, None, None]


def test_text(spark):
    assert one(spark, text.clean(F.col("x")), x="<p>A&nbsp;b\n c</p>") == "A b c"
    assert one(spark, text.clean(F.col("x")), x="NaN") == ""
    assert one(spark, text.compact(F.col("x"), 10), x="abcdefghijkl") == "abcdefg..."
    assert one(spark, text.text_block("x", "y"), x="a", y=None) == "x: a"
    assert one(spark, scalars.word_count(F.col("x")), x="  ") == 0
    assert one(spark, scalars.source_key(F.col("x")), x=" Near-Miss  Card ") == "near_miss_card"


def test_first_delivery_and_lookup(spark):
    rows = [(1, "b", dt.datetime(2024, 1, 2)), (1, "a", dt.datetime(2024, 1, 1)), (None, "z", dt.datetime(2024, 1, 1)), (2, None, None)]
    got = joins.first_delivery(spark.createDataFrame(rows, "k int, v string, loaded_at timestamp_ntz"), "k", ["v"]).collect()
    assert {(r.k, r.v) for r in got} == {(1, "a"), (2, None)}
    facts = spark.createDataFrame([(i, i % 3 if i % 5 else None) for i in range(40)], "i int, k int")
    dim = spark.createDataFrame([(0, "x"), (1, "y")], "k int, name string")
    small = sorted(map(tuple, joins.lookup_join(facts, dim, "k").select("i", "name").collect()))
    large = sorted(map(tuple, joins.lookup_join(facts, dim, "k", rows=1, salts=4).select("i", "name").collect()))
    assert small == large and len(small) == 40


def test_hierarchy_survives_loops(spark):
    rows = [(1, None, "Top"), (2, 1, "Works"), (3, 2, "Works"), (4, 3, "8045"), (5, 99, "Lost"), (6, 7, "A"), (7, 6, "B"), (8, 8, "Self"), (None, 1, "x"), (2, 1, "Works")]
    p = {r.node: r for r in hierarchy.ancestor_paths(spark.createDataFrame(rows, "id bigint, parent bigint, name string"), "id", "parent", "name").collect()}
    assert p[4].name_path == "Top > Works" and p[4].id_path == "1/2/3/4" and p[4].depth == 3
    assert p[5].name_path == "Lost" and p[8].id_path == "8" and p[6].id_path == "7/6"
    assert len(p) == 8


def test_ranked_has_no_gaps(spark):
    rows = [(i, float(i % 7) if i % 11 else None) for i in range(200)]
    got = windows.ranked(spark.createDataFrame(rows, "id int, s double").repartition(5), "s", ["id"]).collect()
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert [r.id for r in sorted(got, key=lambda r: r.rank_no)] == [r[0] for r in want]
    assert sum(r.tier == "top" for r in got) == 10


def test_panel_windows(spark):
    f = spark.createDataFrame([(1, dt.date(2024, 1, 1), 2), (1, dt.date(2024, 4, 1), 1), (2, dt.date(2024, 2, 1), 5)], "e int, m date, n bigint")
    p = windows.month_panel(f, ["e"], "m").join(f, ["e", "m"], "left").na.fill(0, ["n"])
    assert p.count() == 8
    t = {(r.e, r.m): r for r in windows.trailing_features(p, ["e"], "m", ["n"], [2]).collect()}
    assert t[1, dt.date(2024, 4, 1)].n_last_2m == 1 and t[1, dt.date(2024, 4, 1)].n_prev_2m == 2
    u = {(r.e, r.m): r.x for r in windows.future_sum(p, ["e"], "m", "n", 3, "x").collect()}
    assert u[1, dt.date(2024, 1, 1)] == 1 and u[1, dt.date(2024, 4, 1)] == 0


def test_rolling_distinct(spark):
    rnd = random.Random(3)
    rows = [(rnd.randrange(2), dt.date(2024, rnd.randrange(1, 9), 1), rnd.randrange(5)) for _ in range(60)] + [(None, None, None)]
    got = {(r.e, r.m): r.x for r in windows.rolling_distinct(spark.createDataFrame(rows, "e int, m date, i int"), ["e"], "m", "i", 3, "x").collect()}
    want = {(e, m): len({i for f, d, i in rows[:-1] if f == e and m.month - 3 < d.month <= m.month}) for e, m, _ in rows[:-1]}
    assert got == want


def test_samples_do_not_depend_on_order(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2] if i % 10 else None, i % 4) for i in range(200)], "id int, s string, w int")
    for f in (lambda d: sampling.uniform(d, "id", 20), lambda d: sampling.stratified(d, "s", "id", 0.1), lambda d: sampling.weighted(d, "w", "id", 20)):
        a, b = ({r.id for r in f(x).collect()} for x in (df, df.repartition(7)))
        assert a == b and a
    assert all(r.w > 0 for r in sampling.weighted(df, "w", "id", 200).collect())
    assert sampling.quotas({"a": 3, "b": 3, "c": 1}, 10) == {"a": 4, "b": 4, "c": 2} or sum(sampling.quotas({"a": 3, "b": 3, "c": 1}, 10).values()) == 10


def test_nearest_is_exact(spark):
    rnd = np.random.default_rng(1)
    x = rnd.standard_normal((60, 5))
    rows = [(i, [float(v) for v in x[i]]) for i in range(60)] + [(60, None), (61, [0.0] * 5)]
    df = spark.createDataFrame(rows, "id bigint, v array<double>").repartition(3)
    q = df.where("id < 8").select(F.col("id").alias("query_id"), F.col("v").alias("query_vector"))
    n = x / np.linalg.norm(x, axis=1, keepdims=True)
    for block in (100, 3):
        got = retrieval.nearest(df, q, 4, "id", "v", block=block).collect()
        for i in range(8):
            s = n @ n[i]
            s[i] = -9
            assert [r.id for r in sorted((r for r in got if r.query_id == i), key=lambda r: r.rank_no)] == list(np.argsort(-s)[:4])


def test_fusion(spark):
    a = spark.createDataFrame([(1, 10, 1), (1, 11, 2)], "query_id int, d int, rank_no int")
    b = spark.createDataFrame([(1, 10, 1), (1, 12, 1)], "query_id int, d int, rank_no int")
    got = {r.d: r.fused for r in retrieval.fuse(a, b, ["query_id", "d"], 60, 10).collect()}
    assert got[10] == round(2 / 61, 9) and got[12] == round(1 / 61, 9)


def test_metrics(spark):
    rows = [(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.1), (None, 0.5), (1, None)]
    m = metrics.summary(spark.createDataFrame(rows, "y int, s double"), "y", "s", 0.5).first()
    assert m.roc_auc == 0.875 and (m.tp, m.fp, m.fn, m.tn) == (2, 1, 0, 1)
    assert metrics.summary(spark.createDataFrame([(1, 0.5)], "y int, s double"), "y", "s", 0.5).first().roc_auc is None


def test_agglomerate():
    c = [(1, [1.0, 0.0], 5), (2, [0.99, 0.01], 1), (3, [0.0, 1.0], 9)]
    assert learning.agglomerate(c, 0.3) == {3: 0, 1: 1, 2: 1}
    assert learning.agglomerate([], 0.3) == {}


def test_aggregates(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (" ", 4)], "g string, v int")
    assert {(r.value, r.n, r.percent) for r in aggregates.value_counts(df, "g").collect()} == {("a", 2, 50.0), ("Unknown", 2, 50.0)}
    assert {(r.column_name, r.null_count) for r in aggregates.missingness(df).collect()} == {("g", 1), ("v", 0)}
    assert aggregates.mix(spark.createDataFrame([(1, "x"), (1, "x"), (1, "y"), (1, None)], "k int, v string"), ["k"], "v", 5).first().mix == "x=2; y=1"
    assert aggregates.missingness(df.limit(0)).collect()[0].null_rate == 0.0


def test_rules(spark):
    df = spark.createDataFrame([("A crane",), ("none",), (None,)], "t string")
    assert [r[0] for r in df.select(events.any_pattern(F.col("t"), ["CRANE", "x{3}"])).collect()] == [True, False, False]
    assert [r[0] for r in df.select(events.first_match([("n", F.col("t").isNull()), ("c", F.col("t").contains("crane"))], "other")).collect()] == ["c", "other", "n"]
