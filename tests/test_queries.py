from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__

DIR = "/root/testdata/sf0.001"
CHECKED = ["p2_found", "p2_counts", "p7_events", "gr1_ancestor_paths", "j1_decode_with_fallback", "j5_monthly_features", "ag13_profile", "wn1_trailing", "wn7_rolling_distinct", "tx8_bm25", "tx9_nearest", "sm2_stratified", "ml11_metrics", "fl7_reject_reasons"]


def test_every_sql_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables here")
@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(DIR):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DIR}/{f}'")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        got = __spark_entry__.queries()[name](spark, DIR)
        cols = sorted(got.columns)
        want = con.sql(__spark_entry__.oracle_sql()[name])
        assert cols == sorted(want.columns)
        plain = lambda v: f"{v:.5g}" if isinstance(v, float) else str(v)
        a = sorted(tuple(plain(v) for v in r) for r in got.select(*cols).collect())
        b = sorted(tuple(plain(v) for v in r) for r in con.sql(f"SELECT {', '.join(cols)} FROM want").fetchall())
        assert a == b
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
