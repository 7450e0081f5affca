"""Reproducible samples and splits: order by a hash of the id, never by row order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwerk.operators.aggregates import quantiles, value_table
from tarnwerk.operators.windows import rank_within


def key_of(column: str, seed: int) -> Column:
    """A hash in [0, 2^60) of an id and a seed, the same in any engine with md5."""
    return F.conv(F.substring(F.md5(F.concat(F.col(column).cast("string"), F.lit(f":{seed}"))), 1, 15), 16, 10).cast("bigint")


def uniform(df: DataFrame, column: str, n: int, seed: int = 7) -> DataFrame:
    """n rows, those of the least hashes; all where there are fewer. Each task keeps n rows at most."""
    return df.withColumn("_k", key_of(column, seed)).orderBy("_k", column).limit(n).drop("_k")


def stratified(df: DataFrame, stratum: str, column: str, share: float, least: int = 1, seed: int = 7) -> DataFrame:
    """A share of every stratum, at least ``least`` rows of each; nulls are a stratum of their own.

    The cut is a rank among the hashes of the stratum (rank_within): a stratum of any size is shared by many tasks.
    """
    out = rank_within(df.withColumn("_k", key_of(column, seed)), stratum, ["_k", column], "_r", "_n")
    return out.where(F.col("_r") <= F.greatest(F.ceil(F.col("_n") * share), F.lit(least))).drop("_k", "_r", "_n")


def weighted(df: DataFrame, weight: str, column: str, n: int, seed: int = 7) -> DataFrame:
    """n rows without replacement with chances in proportion to their weights: the least exponential keys -ln(u)/w.
    Rows of weight null, 0 or less are never drawn."""
    u = (key_of(column, seed) + 1) / F.lit(float(2**60 + 1))
    return df.where(F.col(weight) > 0).withColumn("_k", -F.log(u) / F.col(weight)).orderBy("_k", column).limit(n).drop("_k")


def split(df: DataFrame, column: str, shares: Sequence[tuple[str, float]], seed: int = 7, out: str = "part") -> DataFrame:
    """A part for every row by its hash: shares of the hash range, the last part takes the rest. No shuffle."""
    u = key_of(column, seed) / F.lit(float(2**60))
    at, case = 0.0, None
    for name, share in shares[:-1]:
        at += share
        case = F.when(u < at, name) if case is None else case.when(u < at, name)
    last = F.lit(shares[-1][0])
    return df.withColumn(out, last if case is None else case.otherwise(last))


def newest(df: DataFrame, time: str, share: float, out: str = "part") -> DataFrame:
    """``test`` for rows after the (1 - share) quantile of time, ``train`` otherwise and for rows without a time."""
    us = F.unix_micros(F.col(time).cast("timestamp"))
    cut = quantiles(value_table(df.select(F.lit(0).alias("_g"), us.alias("_us")), "_g", "_us"), "_g", "_us", {"_cut": 1 - share}).select("_cut")
    return df.join(F.broadcast(cut), F.lit(True), "left").withColumn(out, F.when(us > F.col("_cut"), "test").otherwise("train")).drop("_cut")  # one row


def last_periods(df: DataFrame, period: str, n: int, out: str = "part") -> DataFrame:
    """``test`` for the last n distinct periods, ``train`` otherwise."""
    cut = df.where(F.col(period).isNotNull()).select(period).distinct().orderBy(F.desc(period)).limit(n).agg(F.min(period).alias("_cut"))
    return df.crossJoin(F.broadcast(cut)).withColumn(out, F.when(F.col(period) >= F.col("_cut"), "test").otherwise("train")).drop("_cut")  # one row


def quotas(shares: dict[str, int], total: int) -> dict[str, int]:
    """Scale quotas to a total: floors first, the rest to the largest remainders, ties by name."""
    whole = sum(shares.values())
    if not whole:
        return dict.fromkeys(shares, 0)
    exact = {k: v * total / whole for k, v in shares.items()}
    out = {k: int(v) for k, v in exact.items()}
    for k in sorted(exact, key=lambda k: (out[k] - exact[k], k))[: total - sum(out.values())]:
        out[k] += 1
    return out


def quota_sample(df: DataFrame, group: str, wanted: dict[str, int], column: str, seed: int = 7) -> DataFrame:
    """Of each group its quota of rows, those of the least hashes; groups without a quota have none. A hot group is shared
    by many tasks (rank_within)."""
    rows = [(k, v) for k, v in wanted.items() if v > 0]
    quota = df.sparkSession.createDataFrame(rows, f"{group} string, _quota int")  # a row per group named by the caller
    ranked_rows = rank_within(df.join(F.broadcast(quota), group).withColumn("_k", key_of(column, seed)), group, ["_k", column], "_r")
    return ranked_rows.where(F.col("_r") <= F.col("_quota")).drop("_k", "_r", "_quota")


def capped(df: DataFrame, family: str, keep: Column, cap: int, column: str, seed: int = 7) -> DataFrame:
    """Of each family all rows that must be kept, filled up to ``cap`` rows with those of the least hashes."""
    r = rank_within(df.withColumns({"_must": F.coalesce(keep, F.lit(False)), "_k": key_of(column, seed)}), family, [F.desc("_must"), "_k", column], "_r")
    return r.where(F.col("_must") | (F.col("_r") <= cap)).drop("_must", "_k", "_r")
