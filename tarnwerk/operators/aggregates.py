"""Aggregations: conditional counts, shares, mixes, profiles and rollups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnwerk.operators.lineage import cut
from tarnwerk.operators.windows import running


def value_counts(df: DataFrame, column: str, out: str = "value", unknown: str = "Unknown") -> DataFrame:
    """(out, n, percent) of every value; null and blank count as ``unknown``; percent of all rows, 4 decimals."""
    v = F.coalesce(F.nullif(F.trim(F.col(column).cast("string")), F.lit("")), F.lit(unknown))
    counts = df.groupBy(v.alias(out)).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("_all"))
    return counts.crossJoin(F.broadcast(total)).select(out, "n", F.round(F.col("n") * 100.0 / F.col("_all"), 4).alias("percent"))  # one row


def conditional_counts(df: DataFrame, keys: Sequence[str], conditions: Mapping[str, Column], extra: Sequence[Column] = ()) -> DataFrame:
    """One pass of conditional counts per key: the rows for which each condition holds; null conditions do not."""
    return df.groupBy(*keys).agg(*[F.count(F.when(c, F.lit(1))).alias(n) for n, c in conditions.items()], *extra)


def mix(df: DataFrame, keys: Sequence[str], value: str, top: int, out: str = "mix") -> DataFrame:
    """``value=count; …`` of the ``top`` most frequent values per key, ties by value; null values are left out.

    Two levels of aggregation: the second sees one row per key and value, never the rows.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    ranked = counts.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("_n"), value))).where(F.col("_r") <= top)
    parts = F.sort_array(F.collect_list(F.struct("_r", F.concat(F.col(value).cast("string"), F.lit("="), F.col("_n").cast("string")).alias("t"))))
    return ranked.groupBy(*keys).agg(F.array_join(F.transform(parts, lambda x: x["t"]), "; ").alias(out))


def missingness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, null_count, null_rate) of every column, from one pass."""
    columns = list(columns or df.columns)
    one = df.agg(F.count(F.lit(1)).alias("_all"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = one.unpivot(["_all"], columns, "column_name", "null_count")
    return long.select("column_name", "null_count", F.round(F.coalesce(F.try_divide("null_count", "_all"), F.lit(0.0)), 6).alias("null_rate"))


def metric_table(df: DataFrame, metrics: Mapping[str, Column]) -> DataFrame:
    """(metric, n): one row per named condition, from one global aggregate."""
    one = df.agg(*[F.count(F.when(c, F.lit(1))).alias(n) for n, c in metrics.items()])
    return one.unpivot([], list(metrics), "metric", "n")


def value_table(df: DataFrame, group: str, value: str) -> DataFrame:
    """(group, value, n): how often each value occurs in each group; nulls are left out. Combined before the shuffle."""
    return df.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("n"))


def quantiles(values: DataFrame, group: str, value: str, at: Mapping[str, float]) -> DataFrame:
    """(group, names of ``at``): exact quantiles with linear interpolation, from a value_table.

    Values are ranked by running counts over a range sort, so no task holds the values of a group; of each group only
    the two values around each quantile meet. A null group is left out.
    """
    r = running(values.where(F.col(group).isNotNull()), [group, value], {"_before": F.col("n")})
    first = r.groupBy(group).agg(F.min("_before").alias("_first"), F.sum("n").alias("_n"))
    r = r.join(first, group).withColumn("_at", F.col("_before") - F.col("_first"))

    def value_at(rank: Column) -> Column:
        return F.max(F.when((F.col("_at") <= rank) & (rank < F.col("_at") + F.col("n")), F.col(value)))

    parts = []
    for name, q in at.items():
        h = (F.col("_n") - 1) * F.lit(float(q))
        parts += [value_at(F.floor(h)).alias(f"_lo_{name}"), value_at(F.ceil(h)).alias(f"_hi_{name}"), F.max(h - F.floor(h)).alias(f"_f_{name}")]
    g = r.groupBy(group).agg(*parts)
    return g.select(group, *[(F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_f_{n}")).alias(n) for n in at])


def numeric_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: missing, distinct, mean, population deviation, median, p75, p90, max, non-zero share of all rows.

    Sums are combined in one pass; distinct values and quantiles come from the table of values (value_table), which no
    task holds as a whole.
    """
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "feature", "v")
    sums = long.groupBy("feature").agg(
        F.count_if(F.col("v").isNull()).alias("missing"), F.round(F.avg("v"), 4).alias("mean"), F.round(F.stddev_pop("v"), 4).alias("std"), F.max("v").alias("max"),
        F.round(F.avg((F.coalesce("v", F.lit(0.0)) != 0).cast("double")), 6).alias("nonzero_share"),
    )
    values = cut(value_table(long, "feature", "v"))
    distinct = values.groupBy("feature").agg(F.count(F.lit(1)).alias("distinct_values"))
    q = quantiles(values, "feature", "v", {"median": 0.5, "p75": 0.75, "p90": 0.9})
    out = sums.join(distinct, "feature", "left").join(q, "feature", "left")  # a row per feature
    return out.select("feature", "missing", F.coalesce("distinct_values", F.lit(0)).alias("distinct_values"), "mean", "std", *[F.round(c, 4).alias(c) for c in ("median", "p75", "p90")], "max", "nonzero_share")


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, filled, distinct_values, top, top_count) of every column: values are counted once for all columns."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], list(columns), "column_name", "v")
    n = value_table(long, "column_name", "v")
    g = n.groupBy("column_name").agg(F.sum("n").alias("filled"), F.count(F.lit(1)).alias("distinct_values"), F.min(F.struct((-F.col("n")).alias("_n"), "v")).alias("_t"))
    return g.select("column_name", "filled", "distinct_values", F.col("_t.v").alias("top"), (-F.col("_t._n")).alias("top_count"))


def mode(column: str) -> Column:
    """Most frequent value, the smallest of ties; null where there is none."""
    return F.mode(column, True)
