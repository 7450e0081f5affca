"""Joins and deduplication that keep their shape when one key holds a third of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
SALTS = 32


def first_delivery(df: DataFrame, key: str, columns: Sequence[str], arrived: str = "loaded_at") -> DataFrame:
    """One row per ``key``: the one delivered first.

    Rows without a key are left out. Equal arrivals are broken by the values of ``columns`` in their order, so
    the result does not depend on row order. An arrival of null counts as the latest. One shuffle on the key with
    map-side combine; only the named columns travel.
    """
    rest = [c for c in columns if c not in (key, arrived)]
    least = F.min(F.struct(F.col(arrived).isNull().alias("_n"), F.col(arrived), *[F.col(c) for c in rest])).alias("_r")
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(least).select(key, f"_r.{arrived}", *[f"_r.{c}" for c in rest])


def fits(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``rows`` rows (reads no more than needed; an action)."""
    return df.limit(rows + 1).count() <= rows


def lookup_join(facts: DataFrame, dim: DataFrame, on: str, how: str = "left", rows: int = BROADCAST_ROWS, salts: int = SALTS) -> DataFrame:
    """Join facts to a dimension that has one row per ``on``.

    The dimension is broadcast when a count proves it small. Beyond that the facts are spread over ``salts`` parts of
    each key and the dimension is repeated as often, so that a hot key is shared by that many tasks.
    Null keys find nothing. Columns of the dimension other than ``on`` must not clash with those of the facts.
    """
    if fits(dim, rows):
        return facts.join(F.broadcast(dim), on, how)
    left = facts.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in facts.columns]), F.lit(salts)))
    right = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    return left.join(right, [on, "_salt"], how).drop("_salt")


def hot_split_join(facts: DataFrame, keyed: DataFrame, on: Sequence[str], weight: str, hot_share: int = 1000) -> DataFrame:
    """Inner join of facts to one row per key, where ``weight`` of ``keyed`` is the number of facts of that key.

    A key that holds more than 1/``hot_share`` of the facts is hot; there can be at most ``hot_share`` of them, so they
    are broadcast and their facts never move. All other keys are joined by shuffle, each of a bounded size.
    """
    total = keyed.agg(F.sum(weight)).first()[0] or 0
    limit = max(1, total // hot_share)
    hot = keyed.where(F.col(weight) > limit).drop(weight)
    cold = keyed.where(F.col(weight) <= limit).drop(weight)
    return facts.join(F.broadcast(hot), list(on)).unionByName(facts.join(cold, list(on)))


def null_safe_on(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    """The condition that all keys are equal, null equal to null."""
    out = F.lit(True)
    for k in keys:
        out = out & a[k].eqNullSafe(b[k])
    return out
