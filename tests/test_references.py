from __future__ import annotations

import datetime as dt

from tarnwerk.operators import references as r

D = dt.datetime
CHILD = "record bigint, parent_id string, loaded_at timestamp_ntz, table_name string"
PARENT = "id bigint, loaded_at timestamp_ntz, deleted_at timestamp_ntz, table_name string"


def run(spark, children, parents):
    c = r.children("child", spark.createDataFrame(children, CHILD), "record", {"parent_id": "p"})
    p = r.Parent("p", spark.createDataFrame(parents, PARENT), "id", "deleted_at")
    return {(x.record_id, x.orphan_kind, x.load_month) for x in r.find_orphans(c, [p]).collect()}


def test_kinds(spark):
    day = lambda n: D(2024, 1, n)
    children = [
        (1, "10", day(5), "x"), (2, " 10.0 ", day(5), "x"), (3, "99", day(5), "x"), (4, "11", day(5), "x"), (5, "12", day(5), "x"), (6, "nan", day(5), "x"), (7, None, day(5), "x"), (8, " ", day(5), "x"),
        (4, "11", day(20), "x"), (None, "99", day(5), "x"), (9, "12", day(3), "x"), (10, "99", None, "x"),
    ]
    parents = [(10, day(1), None, "y"), (10, day(2), None, "y"), (11, day(9), None, "y"), (12, day(1), day(5), "y"), (None, day(1), None, "y")]
    assert run(spark, children, parents) == {(3, "missing", "2024-01"), (4, "late", "2024-01"), (5, "deleted", "2024-01"), (10, "missing", None)}


def test_a_parent_with_one_living_row_is_not_deleted(spark):
    assert run(spark, [(1, "1", D(2024, 5, 1), "x")], [(1, D(2024, 1, 1), D(2024, 2, 1), "y"), (1, D(2024, 1, 1), None, "y")]) == set()


def test_hot_key_and_empty(spark):
    assert run(spark, [], []) == set()
    children = [(i, "7", D(2024, 1, 1), "x") for i in range(3000)] + [(5000 + i, str(i), D(2024, 1, 1), "x") for i in range(50)]
    got = run(spark, children, [(i, D(2023, 1, 1), None, "y") for i in range(50) if i != 7])
    assert len(got) == 3001 and {k for _, k, _ in got} == {"missing"}


def test_counts(spark):
    c = r.children("child", spark.createDataFrame([(1, "5", D(2024, 1, 1), "x"), (2, "5", D(2024, 1, 9), "x"), (3, "5", D(2024, 2, 1), "x")], CHILD), "record", {"parent_id": "p"})
    o = r.count_orphans(r.find_orphans(c, [r.Parent("p", spark.createDataFrame([], PARENT), "id", "deleted_at")]))
    assert {(x.load_month, x.orphans) for x in o.collect()} == {("2024-01", 2), ("2024-02", 1)}
