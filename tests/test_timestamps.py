from __future__ import annotations

import datetime as dt
import zoneinfo

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarnwerk.operators import timestamps as t

CHI, BER, UTC = "America/Chicago", "Europe/Berlin", "UTC"
CASES = [
    ("2024-07-01 12:00", CHI, "en-US", "2024-07-01T17:00:00.000000Z"), ("03/04/2024 1:05 PM", CHI, "en-US", "2024-03-04T19:05:00.000000Z"), ("03/04/2024 13:05", BER, "de-DE", "2024-04-03T11:05:00.000000Z"),
    ("2024-03-10 02:30:00", CHI, "en-US", "skipped"), ("2024-11-03 01:30", CHI, "en-US", "ambiguous"), ("2024-11-03 01:30-0500", CHI, "en-US", "2024-11-03T06:30:00.000000Z"),
    ("2024-11-03 01:30:00 America/Chicago", BER, "de-DE", "ambiguous"), ("2024-02-16 04:58 CST", CHI, "en-US", "2024-02-16T10:58:00.000000Z"), ("1713597121337", CHI, "en-US", "2024-04-20T07:12:01.337000Z"),
    ("1637836024", None, None, "2021-11-25T10:27:04.000000Z"), ("20210512T080910Z", None, None, "2021-05-12T08:09:10.000000Z"), ("20210512", BER, "de-DE", "2021-05-11T22:00:00.000000Z"),
    ("30. Juni 2021, 01:33 Uhr", BER, "de-DE", "2021-06-29T23:33:00.000000Z"), ("30 de noviembre de 2021 00:20", "Europe/Madrid", "es-ES", "2021-11-29T23:20:00.000000Z"), ("22-Sep-24 13:49", UTC, "en-GB", "2024-09-22T13:49:00.000000Z"),
    ("Mon, 14 Feb 2022 08:56:44 +1100", None, None, "2022-02-13T21:56:44.000000Z"), ("2025-02-19T13:58:00+00:00[Europe/London]", BER, "de-DE", "2025-02-19T13:58:00.000000Z"), ("2021-05-30T08:59:31.456037Z", None, None, "2021-05-30T08:59:31.456037Z"),
    ("Mar 20, 2022 12:39 AM", UTC, "en-GB", "2022-03-20T00:39:00.000000Z"), ("2024-04-31T06:30:00Z", UTC, "en-GB", "invalid"), ("2023-02-30 08:15", UTC, "en-GB", "invalid"), ("24:75", UTC, "en-GB", "invalid"), ("TBD", UTC, "en-GB", "invalid"),
    ("2024-05-05 10:00", None, None, "zoneless"), ("05/05/2024", None, None, "zoneless"), ("00/00/0000", CHI, "en-US", "invalid"), ("99991399", UTC, "en-GB", "invalid"), ("", UTC, "en-GB", "invalid"), (None, UTC, "en-GB", "invalid"),
    ("2024-07-01 12:00 " + "x" * 5000, UTC, "en-GB", "invalid"), ("2024-07-01 12:00:00 Mars/Base", UTC, "en-GB", "invalid"),
]


def run(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, text string, tz string, loc string")
    out = t.normalise(df, "text", "tz", "loc")
    got = out.select("i", F.when(F.col("status") == "ok", t.utc_text(F.col("utc_s"), F.col("us"))).otherwise(F.col("status")).alias("u")).collect()
    return [u for _, u in sorted((r.i, r.u) for r in got)]


def test_cases(spark):
    assert run(spark, [c[:3] for c in CASES]) == [c[3] for c in CASES]


def test_empty(spark):
    assert run(spark, []) == []


def test_against_zoneinfo(spark):
    base = dt.datetime(2019, 1, 1)
    rows, want = [], []
    for z in (CHI, BER, "Australia/Sydney", "Asia/Kolkata", "Europe/London"):
        tz = zoneinfo.ZoneInfo(z)
        for k in range(400):
            local = base + dt.timedelta(hours=37 * k, minutes=17 * k % 60)
            hits = {u for f in (0, 1) if (u := local.replace(tzinfo=tz, fold=f).astimezone(dt.UTC)).astimezone(tz).replace(tzinfo=None) == local}
            rows.append((local.isoformat(" "), z, "en-GB"))
            want.append("skipped" if not hits else "ambiguous" if len(hits) > 1 else min(hits).strftime("%Y-%m-%dT%H:%M:%S.%fZ"))
    assert run(spark, rows) == want


@settings(max_examples=50, deadline=None)
@given(st.integers(-(2**33), 2**33), st.sampled_from([CHI, BER, "Pacific/Auckland"]))
def test_spans_give_the_offset_of_every_instant(s, zone):
    at = dt.datetime(1970, 1, 1, tzinfo=dt.UTC) + dt.timedelta(seconds=s)
    if not 1905 < at.year < 2190:
        return
    off = at.astimezone(zoneinfo.ZoneInfo(zone)).utcoffset().total_seconds()
    assert [o for lo, hi, o in SPANS(zone) if lo <= s < hi] == [off]


_cache: dict = {}


def SPANS(zone):
    if zone not in _cache:
        _cache[zone] = t.offset_spans(zone)
    return _cache[zone]


@pytest.mark.parametrize("y,m,d", [(1970, 1, 1), (2000, 2, 29), (1900, 2, 28), (2024, 12, 31), (1, 1, 1), (9999, 12, 31)])
def test_epoch_day(spark, y, m, d):
    got = spark.range(1).select(t.epoch_day(F.lit(y), F.lit(m), F.lit(d))).first()[0]
    assert got == dt.date(y, m, d).toordinal() - dt.date(1970, 1, 1).toordinal()


def test_no_such_day(spark):
    assert spark.range(1).select(t.epoch_day(F.lit(1900), F.lit(2), F.lit(29))).first()[0] is None
