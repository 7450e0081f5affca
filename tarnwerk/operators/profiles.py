"""Profiles of places, themes and periods: conditional counters, mixes, best ids, trends, rollups and links.

Counts are combined before every shuffle; lists are cut to their bound in each partition first (top_per_group).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwerk.operators.aggregates import mix
from tarnwerk.operators.windows import top_per_group


def same_keys(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """a with the columns of b, one row per keys; null keys meet null keys."""
    right = b.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[c for c in b.columns if c not in keys])
    on = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    return a.join(right, on, "left").drop(*[f"_k{i}" for i in range(len(keys))])


def best_ids(df: DataFrame, keys: Sequence[str], row_id: str, order: Sequence[Column | str], most: int, out: str = "ids", separator: str = ";") -> DataFrame:
    """(keys, out): the ids of the first ``most`` rows of each group in an explicit order, as one text."""
    top = top_per_group(df, keys, [*order, row_id], most, "_r")
    ids = F.transform(F.sort_array(F.collect_list(F.struct("_r", F.col(row_id).cast("string").alias("i")))), lambda x: x["i"])
    return top.groupBy(*keys).agg(F.array_join(ids, separator).alias(out))


def profile(df: DataFrame, keys: Sequence[str], counters: Mapping[str, Column], date: str, confidence: str, weights: Mapping[str, float], mixes: Mapping[str, tuple[str, int]], row_id: str, order: Sequence[Column | str], most: int = 10) -> DataFrame:
    """One row per keys: events, each counter, first and last date, mean confidence, a weighted review score, a mix per
    entry of ``mixes`` (column, top) and the ids of the best rows. Null keys are groups of their own."""
    counts = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("event_count"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in counters.items()],
        F.min(date).alias("first_date"), F.max(date).alias("last_date"), F.round(F.avg(confidence), 6).alias("mean_confidence"),
    )
    score = reduce(lambda a, b: a + b, [F.col(n) * F.lit(float(w)) for n, w in weights.items()])
    out = counts.withColumn("review_score", F.round(score, 4))
    for name, (column, top) in mixes.items():
        out = same_keys(out, mix(df, keys, column, top, name), keys)
    return same_keys(out, best_ids(df, keys, row_id, order, most), keys)


def rollup(prof: DataFrame, keys: Sequence[str], count: str, sums: Sequence[str], active: str) -> DataFrame:
    """Profiles summed over their other keys: how many different values ``count`` has, and the sums."""
    return prof.groupBy(*keys).agg(F.count_distinct(count).alias(active), *[F.sum(c).alias(c) for c in sums])


def with_ids(rolled: DataFrame, prof: DataFrame, keys: Sequence[str], order: Sequence[str], ids: str = "ids", most: int = 20, separator: str = ";") -> DataFrame:
    """Adds the id lists of the profiles in the given order, one after the other, cut at ``most`` ids.

    Profiles come before their cut: each has at least one id, so the first ``most`` of a group are enough.
    """
    top = top_per_group(prof.where(F.col(ids).isNotNull()), keys, order, most, "_r")
    each = F.transform(F.sort_array(F.collect_list(F.struct("_r", F.split(ids, separator).alias("i")))), lambda x: x["i"])
    return same_keys(rolled, top.groupBy(*keys).agg(F.array_join(F.slice(F.flatten(each), 1, most), separator).alias(ids)), keys)


def top_lines(prof: DataFrame, keys: Sequence[str], order: Sequence[Column | str], line: Column, most: int, out: str, separator: str = " || ") -> DataFrame:
    """(keys, out): a line for each of the best ``most`` profiles of a group."""
    top = top_per_group(prof.withColumn("_line", line), keys, order, most, "_r")
    return top.groupBy(*keys).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_r", "_line"))), lambda x: x["_line"]), separator).alias(out))


def several_families(prof: DataFrame, keys: Sequence[str], family: str, count: str, order: Sequence[Column | str], line: Column, most: int = 5, least: int = 2) -> DataFrame:
    """Groups in which at least ``least`` families occur: how many, events, and the best lines of each family as one text."""
    wide = prof.groupBy(*keys).agg(F.count_distinct(family).alias("families"), F.sum(count).alias(count)).where(F.col("families") >= least)
    lines = top_lines(prof, [*keys, family], order, line, most, "_top", ", ")
    joined = lines.where(F.col(family).isNotNull()).groupBy(*keys).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(family, F.concat(family, F.lit(": "), "_top").alias("x")))), lambda s: s["x"]), " | ").alias("per_family"))
    return same_keys(wide, joined, keys)


def signal_profile(df: DataFrame, key: str, texts: Sequence[str], order: Sequence[str], counters: Mapping[str, Column], distinct: Mapping[str, str], weights: Mapping[str, float]) -> DataFrame:
    """One row per key: the first non-blank value of each text in an explicit order, rows, counters, distinct values and a
    weighted score. One grouped pass; nothing is sorted."""
    firsts = [F.min(F.when(F.trim(c) != "", F.struct(*order, F.col(c)))).getField(c).alias(c) for c in texts]
    g = df.where(F.col(key).isNotNull()).groupBy(key).agg(
        *firsts, F.count(F.lit(1)).alias("event_count"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in counters.items()], *[F.count_distinct(c).alias(n) for n, c in distinct.items()]
    )
    return g.withColumn("signal_score", F.round(reduce(lambda a, b: a + b, [F.col(n) * F.lit(float(w)) for n, w in weights.items()]), 4))


def theme_links(similar: DataFrame, together: DataFrame, share: float = 0.65, full: int = 10, strong: float = 0.70, possible: float = 0.50, least: int = 2) -> DataFrame:
    """(a, b, similarity, periods, link_score, link): pairs of themes by likeness and by the periods both occur in.

    similar: a, b, similarity. together: a, b, periods; both have one row per pair of themes, never of records.
    """
    both = similar.join(together, ["a", "b"], "full").na.fill(0, ["similarity", "periods"])
    score = F.round(share * F.col("similarity") + (1 - share) * F.least(F.col("periods") / F.lit(float(full)), F.lit(1.0)), 4)
    link = F.when((F.col("link_score") >= strong) & (F.col("periods") >= least), "strong").when(F.col("link_score") >= possible, "possible").otherwise("none")
    return both.withColumn("link_score", score).withColumn("link", link)


def representatives(df: DataFrame, group: str, role: str, row_id: str, score: str, most: int) -> DataFrame:
    """(group, row_id, rank_no): the best row of each role, then the best of the others, up to ``most``; ties by id."""
    best = top_per_group(df, [group, role], [F.desc(score), row_id], most, "_in_role")
    return top_per_group(best.withColumn("_first", F.col("_in_role") == 1), [group], [F.desc("_first"), F.desc(score), row_id], most).select(group, row_id, role, "rank_no")
