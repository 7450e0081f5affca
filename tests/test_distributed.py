from __future__ import annotations

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnwerk.functions import json_text, terms
from tarnwerk.operators import aggregates, calibration, lineage, metrics, profiles, risk, sampling, windows
from tarnwerk.operators.learning import agglomerate


def test_running_sums_and_ranks_of_one_hot_group(spark):
    rnd = random.Random(1)
    rows = [(i, "hot" if rnd.random() < 0.6 else rnd.choice(["a", None]), rnd.choice([None, 1, 2, 3])) for i in range(2000)]
    df = spark.createDataFrame(rows, "id int, g string, v int").repartition(7)
    got = {r.id: r.s for r in windows.running(df, ["id"], {"s": F.col("v")}).collect()}
    total = 0
    for i, _, v in rows:
        assert got[i] == total
        total += v or 0
    ranks = {r.id: (r.r, r.n) for r in windows.rank_within(df, "g", [F.desc("id")], "r", "n").collect()}
    for g in ("hot", "a", None):
        ids = sorted((i for i, x, _ in rows if x == g), reverse=True)
        assert [ranks[i] for i in ids] == [(k, len(ids)) for k in range(1, len(ids) + 1)]
    assert windows.running(df.limit(0), ["id"], {"s": F.col("v")}).count() == 0


def test_quantiles_agree_with_numpy(spark):
    rnd = random.Random(2)
    rows = [(g, rnd.choice([None, rnd.random(), 0.5])) for g in "abb" for _ in range(211)] + [("one", 4.0), (None, 1.0)]
    at = {"q10": 0.1, "q50": 0.5, "q99": 0.99}
    got = {r.g: r for r in aggregates.quantiles(aggregates.value_table(spark.createDataFrame(rows, "g string, v double"), "g", "v"), "g", "v", at).collect()}
    assert set(got) == {"a", "b", "one"}
    for g, r in got.items():
        x = [v for k, v in rows if k == g and v is not None]
        assert [r.q10, r.q50, r.q99] == pytest.approx(np.quantile(x, [0.1, 0.5, 0.99]).tolist())


def test_strata_quotas_and_caps(spark):
    df = spark.createDataFrame([(i, "big" if i % 3 else None, i % 50 == 0) for i in range(600)], "id int, g string, must boolean")
    s = sampling.stratified(df, "g", "id", 0.1)
    assert {r.g: r["count"] for r in s.groupBy("g").count().collect()} == {"big": 40, None: 20}
    q = sampling.quota_sample(df, "g", {"big": 7, "none": 3}, "id")
    assert q.count() == 7 and q.columns == ["g", "id", "must"]
    c = sampling.capped(df, "g", F.col("must"), 2, "id")
    assert c.where("must").count() == 12 and c.where("not must").count() == 0


def test_agglomeration_against_all_pair_means():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(14, 5))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    d = 1 - unit @ unit.T
    groups = [[i] for i in range(14)]
    while len(groups) > 1:
        best = min((d[np.ix_(a, b)].mean(), i, j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j)
        if best[0] > 0.8:
            break
        groups[best[1]] += groups.pop(best[2])
    got = agglomerate([(i, x[i].tolist(), 1.0) for i in range(14)], 0.8)
    assert {frozenset(g) for g in groups} == {frozenset(i for i in got if got[i] == t) for t in set(got.values())}
    assert agglomerate([], 0.5) == {} and agglomerate([(7, [1.0], 2.0)], 0.5) == {7: 0}


def test_json_round_trips_and_repairs():
    rnd = random.Random(4)

    def value(depth):
        kind = rnd.randrange(6 if depth else 4)
        return [None, rnd.randrange(99), 'a "b" \\ {', True][kind] if kind < 4 else [value(depth - 1) for _ in range(3)] if kind == 4 else {f"k{i}": value(depth - 1) for i in range(3)}

    for _ in range(200):
        v = {"x": value(3), "y": 1}
        text = json.dumps(v)
        assert json_text.extract(f"Here: {text} and more }}") == (text, "valid")
        cut = text[: rnd.randrange(2, len(text))]
        whole, how = json_text.extract(cut)
        assert how in ("valid", "repaired", "none") and (whole is None or json.loads(whole) is not None)
    whole, how = json_text.extract('{"a": [1, 2,], }')
    assert json.loads(whole) == {"a": [1, 2]} and how == "repaired"
    assert json_text.extract('{"a": "open') == ('{"a": "open"}', "repaired") and json_text.extract('{"a": 1, "b":') == ('{"a": 1}', "repaired")
    assert json_text.extract(None) == (None, "none") and json_text.extract("plain") == (None, "none")


def test_phrases_do_not_repeat_each_other():
    assert terms.distinct_phrases(["hook", "hook latch", "hook latch", "the hook latch broke", "latch", "floor floor", "oil spill"], 5) == ["the hook latch broke", "oil spill"]
    assert terms.distinct_phrases([], 3) == []


def test_thresholds_are_ordered_and_have_defaults(spark):
    none = spark.createDataFrame([], "score double")
    r = calibration.thresholds(none, none).first()
    assert r is None or r.weak < r.possible < r.strong
    some = calibration.thresholds(spark.createDataFrame([(0.5,), (0.6,)], "score double"), spark.createDataFrame([(0.1,)], "score double")).first()
    assert some.possible >= some.weak + 0.02 - 1e-9 and some.strong >= some.possible + 0.02 - 1e-9


def test_split_falls_back_without_dates(spark):
    df = spark.createDataFrame([(i, None if i < 95 else "2024-01-01") for i in range(100)], "id int, d string").withColumn("d", F.to_date("d"))
    assert {r.part: r["count"] for r in calibration.temporal_split(df, "d", "id").groupBy("part").count().collect()} == {"train": 80, "test": 20}
    dated = spark.createDataFrame([(i, f"2024-{i % 12 + 1:02d}-01") for i in range(100)], "id int, d string").withColumn("d", F.to_date("d"))
    s = calibration.temporal_split(dated, "d", "id")
    assert s.where("part = 'train'").agg(F.max("d")).first()[0] <= s.where("part = 'test'").agg(F.min("d")).first()[0]


def test_profiles_keep_null_keys_and_bounds(spark):
    df = spark.createDataFrame([(None if i % 2 else "s", i, i / 40, None) for i in range(40)], "site string, id int, c double, d date")
    p = {r.site: r for r in profiles.profile(df, ["site"], {"low": F.col("id") < 10}, "d", "c", {"low": 2.0}, {"m": ("id", 2)}, "id", [F.desc("c")], 3).collect()}
    assert p[None].event_count == 20 and p[None].low == 5 and p[None].review_score == 10.0 and p[None].ids == "39;37;35" and p["s"].ids == "38;36;34"


def test_thresholds_and_folds_of_risk(spark):
    rows = [(int(i % 4 == 0), (i % 100) / 100) for i in range(1000)]
    t = {r.strategy: r for r in risk.choose_threshold(spark.createDataFrame(rows, "y int, s double"), "y", "s").collect()}
    assert t["top_share"].threshold == pytest.approx(float(np.quantile([s for _, s in rows], 0.9)))
    f2 = lambda th: 5 * sum(y for y, s in rows if s >= th) / (4 * 250 + sum(s >= th for _, s in rows))
    assert t["f2"].value == pytest.approx(max(f2(k / 100) for k in range(1, 100)), abs=1e-6)
    folds = risk.expanding_folds(spark.createDataFrame([(f"{m:02d}",) for m in range(13)], "m string"), "m", 3).collect()
    for k in (1, 2, 3):
        train, test = ([r.m for r in folds if r.fold == k and r.part == p] for p in ("train", "test"))
        assert len(test) == 3 and max(train) < min(test)


def test_separation_of_clusters(spark):
    x = [(0, [0.0, 0.0]), (0, [0.0, 2.0]), (1, [10.0, 0.0]), (1, [10.0, 2.0]), (None, [1.0, 1.0]), (1, None)]
    r = metrics.separation(spark.createDataFrame(x, "c int, v array<double>"), "c", "v").first()
    assert r.davies_bouldin == pytest.approx(0.2) and r.calinski_harabasz == pytest.approx(50.0)


def test_checkpoints_on_a_cluster_need_a_shared_folder():
    assert lineage._own_folder("local[4]") and lineage._own_folder("local")
    for master in ("local-cluster[2,1,1024]", "spark://host:7077", "yarn"):
        with pytest.raises(ValueError):
            lineage._own_folder(master)
