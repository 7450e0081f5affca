from __future__ import annotations

import os
import random

import pytest

from tarnwerk.llm import mixing

TARGETS = [("a", "a", 5.0, 2), ("b", "b", 3.0, 1), ("c", "c", 2.0, 4), ("none", "none", 1.0, 4)]


def test_plan_fills_up_to_limits():
    sizes = {"a": (100, 10), "b": (900, 90), "c": (50, 5)}
    plan = {s.source_name: s for s in mixing.plan(sizes, TARGETS, 1050)}
    assert {n for n, s in plan.items() if s.short} == {"a", "none"} | ({"c"} if 200 < 2 / 11 * 1050 else set())
    assert all(s.planned <= s.capacity + 1e-6 for s in plan.values())
    assert plan["b"].planned == pytest.approx(1050 - plan["a"].planned - plan["c"].planned) or plan["b"].planned == 900
    assert mixing.plan({}, [], 0) == [] and mixing.plan({}, TARGETS, 0)[0].planned == 0


def test_exponents_decide_the_plan():
    sizes = {"a": (100, 1), "b": (600, 1), "c": (500, 1), "d": (800, 1)}
    targets = [("a", "a", 4.0, 2), ("b", "b", 2.0, 1), ("c", "c", 1.0, 1), ("d", "d", 1.0, 1)]
    got = mixing.plan(sizes, targets, 2000)
    assert [s.short for s in got] == [True, False, False, False]
    # a goes from its natural 100 tokens towards 1000 until its limit of 200 stops it.
    assert 0 < got[0].exponent < 1 and mixing.path(0.05, 0.5, got[0].exponent) * 2000 == pytest.approx(200) == pytest.approx(got[0].planned)
    assert sum(s.planned for s in got) == pytest.approx(2000) and all(s.planned <= s.capacity + 1e-6 for s in got)
    # What a leaves (800) goes along the path from the rooms to the targets until b is at its limit; none falls below its target.
    assert got[1].planned == pytest.approx(600, abs=1e-3)
    assert 250 / 550 < (got[2].planned - 250) / (got[3].planned - 250) < 1
    tighter = mixing.plan(sizes, [("a", "a", 4.0, 1), *targets[1:]], 2000)
    assert tighter[0].exponent < got[0].exponent and tighter[0].planned == pytest.approx(100)


def test_even_plan_meets_the_limits():
    got = mixing.even_plan({"a": (100, 1), "b": (900, 1)}, [("a", "a", 3), ("b", "b", 1)], 1000)
    assert got[0].planned == pytest.approx(300, abs=1e-3) and sum(s.planned for s in got) == pytest.approx(1000)
    natural = mixing.even_plan({"a": (100, 1), "b": (900, 1)}, [("a", "a", 1), ("b", "b", 1)], 1000)
    assert [s.planned for s in natural] == pytest.approx([100, 900])


def test_exponent_meets_entropy_and_limits():
    t = [1000, 100, 10]
    even = mixing.exponent_for(t, entropy=2.0)
    half = mixing.exponent_for(t, entropy=0.8)
    assert even == 0.0 and 0 < half < 1 and mixing._entropy(mixing.temperature_shares(t, half)) <= 0.8 + 1e-6
    cap = mixing.exponent_for(t, capacity=[1000, 200, 40], budget=1000)
    assert all(p * 1000 <= c + 1e-3 for p, c in zip(mixing.temperature_shares(t, cap), [1000, 200, 40]))


def test_realised_budgets(spark):
    rnd = random.Random(4)
    rows = [(i, "ab"[i % 2], rnd.randrange(0, 40)) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id bigint, key string, tokens bigint").repartition(5)
    n = {k: sum(t for _, s, t in rows if s == k) for k in "ab"}
    shares = mixing.plan({k: (n[k], 1500) for k in "ab"}, [("A", "a", 3.0, 2), ("B", "b", 1.0, 3)], n["a"] + n["b"])
    one = mixing.realise(df, shares, "doc_id", blocks=64).collect()
    again = mixing.realise(df.repartition(3), shares, "doc_id", blocks=64).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, again))
    for s in shares:
        used = sum(r.tokens * r.copies for r in one if r.source_name == s.source_name)
        assert s.planned - 41 <= used <= s.planned + 1e-6
        assert max(r.copies for r in one if r.source_name == s.source_name) <= {"A": 2, "B": 3}[s.source_name]
    assert len({r.doc_id for r in one}) == len(one)
    assert mixing.realise(df.limit(0), [], "doc_id").count() == 0


@pytest.mark.skipif(not os.path.exists(mixing.TOKENIZER), reason="no vocabulary here")
def test_tokens(spark):
    df = spark.createDataFrame([(1, "hello world"), (2, None), (3, ""), (4, "x " * 20000)], "doc_id int, text string")
    got = {r.doc_id: r.tokens for r in mixing.count_tokens(df, "text", keep=("doc_id",)).collect()}
    assert got[1] >= 2 and got[2] == got[3] == 0 and got[4] >= 20000
