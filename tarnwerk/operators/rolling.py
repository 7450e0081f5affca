"""Rolling totals over trailing periods, kept as versioned daily state (problem 7).

The state of an entity on a day is yesterday's state plus today's arrivals less the amounts that expire today.
``advance`` carries the state on by a block of days: the totals of the day before are joined with the arrivals and the
expiring amounts of the block and added up day by day. ``maintain`` goes through a period block by block. Late or
changed amounts are ``correct``, which recomputes only the days they reach and writes them as a new version;
``latest`` reads the state. ``rolling_state`` gives the totals of a finished history in one pass.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnwerk.operators.lineage import cut


def _total(m: str, w: int) -> str:
    return f"{m}_{w}d"


def daily_amounts(rows: DataFrame, entity: str, day: str, measures: Sequence[str]) -> DataFrame:
    """One row per entity and day with the sums of the measures; rows without entity or day are left out, null amounts
    count as 0. Combined before the shuffle, so a hot entity costs a row per day and map task."""
    return rows.where(F.col(entity).isNotNull() & F.col(day).isNotNull()).groupBy(entity, day).agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures])


def rolling_state(daily: DataFrame, entity: str, day: str, measures: Sequence[str], windows: Sequence[int], first_day: str, last_day: str, entities: DataFrame | None = None, averages: bool = False) -> DataFrame:
    """Totals of every measure over every trailing window, one row per entity and day of [first_day, last_day].

    daily: one row per entity and day (see daily_amounts). A window of w days holds the day and the w - 1 before it;
    amounts before first_day count inside the windows. With ``entities`` (one column, named as ``entity``) each of them
    has a row for every day, quiet ones included; without it only days are given on which the longest window holds a
    row of ``daily``. averages: adds {measure}_{w}d_avg, the total by w. Empty input gives no rows, or zeros.

    Each amount arrives on its day and expires w days later. These changes are summed per entity and day, then added
    up in day order: a window partition holds at most (1 + number of windows) rows per active day of one entity. Days
    between two changes are filled in afterwards, without any further shuffle.
    """
    lo, hi = F.to_date(F.lit(first_day)), F.to_date(F.lit(last_day))
    names = [_total(m, w) for m in measures for w in windows]
    zero = [F.lit(0).alias(n) for n in names]

    def change(by: int) -> DataFrame:
        sign = lambda w: 1 if by == 0 else (-1 if by == w else 0)
        return daily.select(entity, F.date_add(day, by).alias("_day"), F.lit(1 if by == 0 else -1 if by == max(windows) else 0).alias("_live"), *[(F.col(m) * sign(w)).alias(_total(m, w)) for m in measures for w in windows])

    parts = [change(by) for by in (0, *windows)]
    if entities is not None:
        parts.append(entities.select(entity, lo.alias("_day"), F.lit(0).alias("_live"), *zero))
    changes = reduce(DataFrame.unionByName, parts).groupBy(entity, "_day").agg(F.sum("_live").alias("_live"), *[F.sum(n).alias(n) for n in names])
    w = Window.partitionBy(entity).orderBy("_day")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    states = changes.select(entity, "_day", F.lead("_day").over(w).alias("_next"), *[F.sum(n).over(run).alias(n) for n in ["_live", *names]])
    begin, end = F.greatest(F.col("_day"), lo), F.least(F.coalesce(F.date_add("_next", -1), hi), hi)
    states = states.where(begin <= end)
    if entities is None:
        states = states.where(F.col("_live") > 0)
    out = states.select(entity, F.explode(F.sequence(begin, end)).alias(day), *names)
    return with_averages(out, measures, windows) if averages else out


def advance(yesterday: DataFrame, daily: DataFrame, first: str, last: str, entity: str, day: str, measures: Sequence[str], windows: Sequence[int]) -> DataFrame:
    """The state of the days [first, last]: the totals of the day before joined with what arrives and what expires.

    yesterday: entity, totals, _live (the rows of ``daily`` within the longest window). daily: the history of amounts,
    of which only the block and the days that expire in it are read. The result has one row per entity and run of equal
    days: entity, _from, _to, totals, _live. An entity without yesterday's totals begins at zero. One shuffle by
    entity; a window partition holds at most (1 + number of windows) rows per active day of the block.
    """
    lo, hi = F.to_date(F.lit(first)), F.to_date(F.lit(last))
    names = [_total(m, w) for m in measures for w in windows]
    change = [F.struct(F.lit(0).alias("by"), F.lit(1).alias("sign"))] + [F.struct(F.lit(w).alias("by"), F.lit(-1).alias("sign")) for w in windows]
    near = daily.where(F.col(day).between(F.date_add(lo, -max(windows)), hi)).withColumn("_c", F.explode(F.array(*change)))
    at = F.date_add(F.col(day), F.col("_c.by"))
    part = lambda w: F.when(F.col("_c.by") == 0, 1).when(F.col("_c.by") == w, -1).otherwise(0)
    moves = near.select(entity, at.alias("_from"), part(max(windows)).cast("bigint").alias("_live"), *[(F.col(m) * part(w)).alias(_total(m, w)) for m in measures for w in windows]).where(F.col("_from").between(lo, hi))
    opening = yesterday.select(entity, lo.alias("_from"), "_live", *names)
    both = moves.unionByName(opening).groupBy(entity, "_from").agg(*[F.sum(n).alias(n) for n in ("_live", *names)])
    by_day = Window.partitionBy(entity).orderBy("_from")
    run = by_day.rowsBetween(Window.unboundedPreceding, 0)
    until = F.coalesce(F.date_add(F.lead("_from").over(by_day), -1), hi)
    return both.select(entity, "_from", until.alias("_to"), *[F.sum(n).over(run).alias(n) for n in ("_live", *names)])


def maintain(daily: DataFrame, entity: str, day: str, measures: Sequence[str], windows: Sequence[int], first_day: str, last_day: str, block_days: int = 366) -> DataFrame:
    """Version 0 of the state over [first_day, last_day], carried on block by block from the amounts before first_day.

    One row per entity and day whose longest window holds a row of ``daily``. Each block's runs are cut, and the totals
    of its last day are where the next begins; the driver holds nothing but the dates. Empty input gives no rows.
    """
    names = [_total(m, w) for m in measures for w in windows]
    begin, end = dt.date.fromisoformat(first_day), dt.date.fromisoformat(last_day)
    before = F.datediff(F.lit(first_day).cast("date"), F.col(day))
    past = daily.where(before.between(1, max(windows)))
    totals = [F.sum(F.when(before <= w, F.col(m)).otherwise(0)).alias(_total(m, w)) for m in measures for w in windows]
    state = past.groupBy(entity).agg(F.count(F.lit(1)).alias("_live"), *totals)
    out = None
    while begin <= end:
        last = min(end, begin + dt.timedelta(days=block_days - 1))
        block = cut(advance(state, daily, begin.isoformat(), last.isoformat(), entity, day, measures, windows))
        state = block.where(F.col("_to") == F.lit(last.isoformat()).cast("date")).select(entity, "_live", *names)
        out = block if out is None else out.unionByName(block)
        begin = last + dt.timedelta(days=1)
    return out.where(F.col("_live") > 0).select(entity, F.explode(F.sequence("_from", "_to")).alias(day), *names, F.lit(0).alias("version"))


def with_quiet_days(state: DataFrame, entities: DataFrame, entity: str, day: str, measures: Sequence[str], windows: Sequence[int], first_day: str, last_day: str) -> DataFrame:
    """The state with a row of zeros for every day of an entity (one column, named as ``entity``) that it does not hold."""
    names = [_total(m, w) for m in measures for w in windows]
    days = entities.select(entity, F.explode(F.sequence(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))).alias(day), *[F.lit(0).cast("bigint").alias(n) for n in names])
    return state.select(entity, day, *names).unionByName(days).groupBy(entity, day).agg(*[F.sum(n).alias(n) for n in names])


def with_averages(state: DataFrame, measures: Sequence[str], windows: Sequence[int]) -> DataFrame:
    """Adds {measure}_{w}d_avg, the total by the days of its window."""
    return state.withColumns({f"{_total(m, k)}_avg": F.col(_total(m, k)) / F.lit(float(k)) for m in measures for k in windows})


def correct(state: DataFrame, corrections: DataFrame, entity: str, day: str, measures: Sequence[str], windows: Sequence[int], first_day: str, last_day: str, version: int) -> DataFrame:
    """New rows of the state for the days that late or changed amounts reach, marked with ``version``.

    corrections: entity, day and the change of each measure. Only entities and days within the longest window after a
    correction are recomputed: their last totals plus the corrections' own trailing totals. Days without a row so far
    begin at zero. state must hold one row per entity and day (see ``latest``).
    """
    names = [_total(m, w) for m in measures for w in windows]
    delta = rolling_state(daily_amounts(corrections, entity, day, measures), entity, day, measures, windows, first_day, last_day)
    old = state.select(entity, day, *[F.col(n).alias(f"_{n}") for n in names])
    return delta.join(old, [entity, day], "left").select(entity, day, *[(F.col(n) + F.coalesce(F.col(f"_{n}"), F.lit(0))).alias(n) for n in names], F.lit(version).alias("version"))


def latest(versions: DataFrame, entity: str, day: str) -> DataFrame:
    """Of each entity and day the row of the highest version."""
    rest = [c for c in versions.columns if c not in (entity, day)]
    return versions.groupBy(entity, day).agg(F.max(F.struct("version", *[c for c in rest if c != "version"])).alias("_v")).select(entity, day, *[F.col(f"_v.{c}").alias(c) for c in rest])


def trailing(order: str | Column, entity: Sequence[str], size: int) -> Window:
    """The last ``size`` rows of an entity on a dense calendar, this one included."""
    return Window.partitionBy(*entity).orderBy(order).rowsBetween(1 - size, 0)
