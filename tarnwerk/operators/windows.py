"""Window features over dense entity x period panels, ranks, tiers and trends."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnwerk.operators.lineage import cut


def month_panel(facts: DataFrame, entity: Sequence[str], month: str) -> DataFrame:
    """Every entity in every month between the first and last of the data: the dense panel that row frames rely on.

    The calendar is a sequence of the two bounds, exploded per entity: no join of all pairs.
    """
    bounds = facts.where(F.col(month).isNotNull()).agg(F.min(month).alias("_lo"), F.max(month).alias("_hi"))
    entities = facts.where(F.col(month).isNotNull()).select(*entity).distinct()
    each = F.explode(F.sequence(F.col("_lo"), F.col("_hi"), F.expr("interval 1 month"))).alias(month)
    return entities.crossJoin(F.broadcast(bounds)).select(*entity, each)  # bounds is one row


def trailing_features(panel: DataFrame, entity: Sequence[str], month: str, measures: Sequence[str], sizes: Sequence[int]) -> DataFrame:
    """Per measure and window of w rows: the trailing sum, the sum of the w rows before it and the growth between them,
    0 where the earlier is 0. All share one sort; the panel must be dense."""
    w = Window.partitionBy(*entity).orderBy(month)
    out = {}
    for m in measures:
        for k in sizes:
            last = F.sum(m).over(w.rowsBetween(1 - k, 0))
            prev = F.coalesce(F.sum(m).over(w.rowsBetween(1 - 2 * k, -k)), F.lit(0))
            out[f"{m}_last_{k}m"], out[f"{m}_prev_{k}m"] = last, prev
            out[f"{m}_growth_{k}m"] = F.round(F.coalesce(F.try_divide((last - prev).cast("double"), prev.cast("double")), F.lit(0.0)), 6)
    return panel.withColumns(out)


def future_sum(panel: DataFrame, entity: Sequence[str], month: str, measure: str, horizon: int, out: str) -> DataFrame:
    """The sum of the next ``horizon`` rows, 0 where there are none: a target that only later months decide."""
    w = Window.partitionBy(*entity).orderBy(month).rowsBetween(1, horizon)
    return panel.withColumn(out, F.coalesce(F.sum(measure).over(w), F.lit(0)))


def open_stock(panel: DataFrame, entity: Sequence[str], month: str, opened: str, closed: str, out: str) -> DataFrame:
    """Running openings less running closings, never below 0."""
    w = Window.partitionBy(*entity).orderBy(month).rowsBetween(Window.unboundedPreceding, 0)
    return panel.withColumn(out, F.greatest(F.sum(opened).over(w) - F.sum(closed).over(w), F.lit(0)))


def rolling_distinct(events: DataFrame, entity: Sequence[str], month: str, item: str, months: int, out: str) -> DataFrame:
    """Distinct items per entity over the trailing ``months`` calendar months, one row per entity and month with events.

    Each (entity, month, item) is first reduced to one row and then spread over the months it counts in: the count is
    a plain grouped aggregate, so no window collects the items of a hot entity.
    """
    have, spread = _trailing_items(events, entity, month, item, months)
    counts = spread.groupBy(*entity, month).agg(F.count_distinct(item).alias(out))
    return have.join(counts, [*entity, month])


def _trailing_items(events: DataFrame, entity: Sequence[str], month: str, item: str, months: int) -> tuple[DataFrame, DataFrame]:
    once = events.where(F.col(month).isNotNull() & F.col(item).isNotNull()).select(*entity, month, item).distinct()
    have = once.select(*entity, month).distinct()
    return have, once.select(*entity, F.explode(F.transform(F.sequence(F.lit(0), F.lit(months - 1)), lambda k: F.add_months(F.col(month), k))).alias(month), item)


def rolling_items(events: DataFrame, entity: Sequence[str], month: str, item: str, months: int, out: str, separator: str = ",") -> DataFrame:
    """The same items as text, in order: items are codes of a bounded list, so a group holds each once at most."""
    have, spread = _trailing_items(events, entity, month, item, months)
    lists = spread.groupBy(*entity, month).agg(F.array_join(F.array_sort(F.collect_set(F.col(item).cast("string"))), separator).alias(out))
    return have.join(lists, [*entity, month])


def trend_flag(rows: DataFrame, group: Sequence[str], order: str, measure: str, last: int = 3, least_rows: int = 4, change: float = 0.25, least: float = 2.0) -> DataFrame:
    """Per group the mean of its last rows against that of all earlier ones: up, down, flat, or short history."""
    n = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc(order)))
    g = rows.withColumn("_r", n).groupBy(*group).agg(
        F.count(F.lit(1)).alias("periods"), F.avg(F.when(F.col("_r") <= last, F.col(measure))).alias("_a"), F.avg(F.when(F.col("_r") > last, F.col(measure))).alias("_b")
    )
    d = F.col("_a") - F.col("_b")
    flag = F.when(F.col("periods") < least_rows, "short_history").when((F.abs(d) >= least) & (d > change * F.col("_b")), "increasing").when((F.abs(d) >= least) & (d < -change * F.col("_b")), "decreasing").otherwise("stable")
    return g.select(*group, "periods", F.round("_a", 4).alias("recent_mean"), F.round("_b", 4).alias("earlier_mean"), flag.alias("trend"))


def running(df: DataFrame, order: Sequence[Column | str], sums: Mapping[str, Column]) -> DataFrame:
    """Adds per name of ``sums`` the sum over all rows before a row in a total order; null counts as 0.

    No task sees all rows: they are sorted by range across the cluster and cut, so that partitions stay as they are;
    the sums of whole partitions, one row each, give the offsets, and the rest is added up within partitions.
    """
    names = list(sums)
    held = df.withColumns({f"_v{i}": F.coalesce(c, F.lit(0)) for i, c in enumerate(sums.values())})
    s = cut(held.orderBy(*order).withColumns({"_p": F.spark_partition_id(), "_m": F.monotonically_increasing_id()}))
    w = Window.partitionBy("_p").orderBy("_m").rowsBetween(Window.unboundedPreceding, -1)
    parts = s.groupBy("_p").agg(*[F.sum(f"_v{i}").alias(f"_t{i}") for i in range(len(names))])
    before = Window.partitionBy().orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    offsets = parts.select("_p", *[F.coalesce(F.sum(f"_t{i}").over(before), F.lit(0)).alias(f"_o{i}") for i in range(len(names))])
    out = s.join(F.broadcast(offsets), "_p")
    out = out.withColumns({n: F.col(f"_o{i}") + F.coalesce(F.sum(f"_v{i}").over(w), F.lit(0)) for i, n in enumerate(names)})
    return out.drop("_p", "_m", *[f"{x}{i}" for x in ("_v", "_o") for i in range(len(names))])


def ranked(df: DataFrame, score: str, tie: Sequence[str], tiers: Sequence[tuple[str, float]] = (("top", 0.05), ("high", 0.10), ("watch", 0.25)), rest: str = "other", total: str = "_all") -> DataFrame:
    """Adds rank_no by falling score (ties by ``tie``), percentile among the rising scores, and the tier of the rank's
    fraction; with another name for ``total`` also the number of rows. The global rank is a running count (``running``)."""
    out = running(df, [F.desc_nulls_last(score), *tie], {"_before": F.lit(1).cast("bigint")})
    n = df.agg(F.count(F.lit(1)).alias(total))
    out = out.crossJoin(F.broadcast(n)).withColumn("rank_no", F.col("_before") + 1)  # one row
    out = out.withColumn("percentile", F.round((F.col(total) - F.col("rank_no") + 1) / F.col(total), 6))
    tier = F.lit(rest)
    for name, share in reversed(tiers):
        tier = F.when(F.col("rank_no") / F.col(total) <= share, name).otherwise(tier)
    return out.withColumn("tier", tier).drop("_before", *(["_all"] if total == "_all" else []))


def rank_within(df: DataFrame, group: str, order: Sequence[Column | str], out: str = "rank_no", total: str | None = None) -> DataFrame:
    """Adds the rank of a row in its group, null being a group of its own, and with ``total`` the size of the group. A
    group of any size is shared by many tasks: rows are ranked as a whole, and each group's first rank is taken off."""
    r = running(df, [F.col(group).asc_nulls_first(), *order], {"_before": F.lit(1).cast("bigint")})
    first = r.groupBy(F.col(group).alias("_g")).agg(F.min("_before").alias("_first"), F.count(F.lit(1)).alias("_size"))
    both = r.join(first, F.col(group).eqNullSafe(F.col("_g"))).withColumn(out, F.col("_before") - F.col("_first") + 1)
    if total:
        both = both.withColumn(total, F.col("_size"))
    return both.drop("_g", "_before", "_first", "_size")


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], k: int, out: str = "rank_no") -> DataFrame:
    """The first k rows of each group in an explicit order; Spark stops each partition's sort after k rows a group."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col(out) <= k)


def trend_label(now: Column, before: Column, change: float = 0.25, least: float = 1.0) -> Column:
    """up, down or flat of two windows: a change counts from ``least`` and ``change`` of the earlier on; new where the
    earlier is 0."""
    d = now - before
    return F.when((before == 0) & (now > 0), "new").when((F.abs(d) >= least) & (d > change * before), "up").when((F.abs(d) >= least) & (d < -change * before), "down").otherwise("flat")
