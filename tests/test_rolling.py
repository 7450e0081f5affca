from __future__ import annotations

import datetime as dt
import random

from tarnwerk.operators import rolling as r

D = dt.date
SCHEMA = "e bigint, day date, n bigint"


def brute(rows, lo, hi, windows, every=None):
    out = {}
    for e in every or {x[0] for x in rows}:
        day = lo
        while day <= hi:
            tot = tuple(sum(n for f, d, n in rows if f == e and 0 <= (day - d).days < w) for w in windows)
            live = any(f == e and 0 <= (day - d).days < max(windows) for f, d, n in rows)
            if live or every:
                out[e, day] = tot
            day += dt.timedelta(1)
    return out


def state(spark, rows, lo, hi, every=None):
    daily = r.daily_amounts(spark.createDataFrame(rows, SCHEMA), "e", "day", ["n"])
    ents = spark.createDataFrame([(e,) for e in every], "e bigint") if every else None
    return r.rolling_state(daily, "e", "day", ["n"], [7, 30], str(lo), str(hi), entities=ents)


def as_dict(df):
    return {(x.e, x.day): (x.n_7d, x.n_30d) for x in df.collect()}


def test_against_brute_force(spark):
    rnd = random.Random(1)
    lo, hi = D(2024, 1, 1), D(2024, 4, 30)
    rows = [(rnd.randrange(3), D(2023, 12, 1) + dt.timedelta(rnd.randrange(160)), rnd.randrange(1, 4)) for _ in range(60)]
    assert as_dict(state(spark, rows, lo, hi)) == brute(rows, lo, hi, (7, 30))
    assert as_dict(state(spark, rows, lo, hi, every=[0, 1, 2, 9])) == brute(rows, lo, hi, (7, 30), every=[0, 1, 2, 9])


def test_nulls_and_empty(spark):
    lo, hi = D(2024, 1, 1), D(2024, 1, 10)
    assert as_dict(state(spark, [], lo, hi)) == {}
    assert as_dict(state(spark, [(None, lo, 1), (1, None, 1), (1, lo, None)], lo, D(2024, 1, 1))) == {(1, lo): (0, 0)}


def test_maintained_day_by_day_or_in_blocks_agrees_with_the_whole(spark):
    rnd = random.Random(2)
    lo, hi = D(2024, 1, 1), D(2024, 4, 30)
    rows = [(rnd.randrange(4), D(2023, 11, 20) + dt.timedelta(rnd.randrange(170)), rnd.randrange(0, 4)) for _ in range(50)]
    daily = r.daily_amounts(spark.createDataFrame(rows, SCHEMA), "e", "day", ["n"])
    for block in (17, 60, 366):
        got = r.maintain(daily, "e", "day", ["n"], [7, 30], str(lo), str(hi), block_days=block)
        assert got.count() == len(as_dict(got))
        assert as_dict(got) == brute(rows, lo, hi, (7, 30))
    few = (D(2024, 2, 1), D(2024, 2, 4))
    assert as_dict(r.maintain(daily, "e", "day", ["n"], [7, 30], str(few[0]), str(few[1]), block_days=1)) == brute(rows, *few, (7, 30))
    assert r.maintain(daily.limit(0), "e", "day", ["n"], [7, 30], str(lo), str(hi)).count() == 0


def test_quiet_days_and_averages(spark):
    rows = [(1, D(2024, 1, 2), 7)]
    daily = r.daily_amounts(spark.createDataFrame(rows, SCHEMA), "e", "day", ["n"])
    state = r.maintain(daily, "e", "day", ["n"], [7, 30], "2024-01-01", "2024-02-29")
    every = spark.createDataFrame([(1,), (2,)], "e bigint")
    full = r.with_averages(r.with_quiet_days(state, every, "e", "day", ["n"], [7, 30], "2024-01-01", "2024-02-29"), ["n"], [7, 30])
    assert as_dict(full) == brute(rows, D(2024, 1, 1), D(2024, 2, 29), (7, 30), every=[1, 2])
    assert full.where("e = 1 and day = '2024-01-08'").first().n_7d_avg == 1.0


def test_corrections_recompute_only_what_they_reach(spark):
    lo, hi = D(2024, 1, 1), D(2024, 3, 31)
    early, late = [(1, D(2024, 1, 10), 1), (2, D(2024, 1, 20), 4)], [(1, D(2024, 2, 1), 2), (3, D(2024, 1, 2), 1)]
    first = state(spark, early, lo, hi)
    fixed = r.correct(first, spark.createDataFrame(late, SCHEMA), "e", "day", ["n"], [7, 30], str(lo), str(hi), 1)
    assert {x.e for x in fixed.select("e").distinct().collect()} == {1, 3}
    from pyspark.sql import functions as F

    both = r.latest(first.withColumn("version", F.lit(0)).unionByName(fixed), "e", "day")
    assert as_dict(both) == brute(early + late, lo, hi, (7, 30))
