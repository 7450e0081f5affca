"""Risk panels: features over entity x month, rule scores, leakage checks, thresholds, expanding folds and drivers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnwerk.functions.terms import friendly
from tarnwerk.operators import metrics
from tarnwerk.operators.aggregates import conditional_counts, quantiles, value_table
from tarnwerk.operators.joins import lookup_join
from tarnwerk.operators.windows import future_sum, month_panel, top_per_group, trailing_features

#: Fixed value list: what a feature's name holds and its family, the first that fits.
FAMILIES = (
    ("theme", "pattern_theme"), ("cluster", "pattern_cluster"), ("pattern|membership|outlier", "pattern_aggregate"), ("task|overdue|closure", "corrective_action"), ("audit|observation|inspection", "audit_observation"),
    ("injury|severe", "injury_history"), ("near_miss|hazard|incident", "incident_history"), ("calendar|month_", "calendar"),
)


def with_monthly_counts(panel: DataFrame, events: DataFrame, entity: Sequence[str], month: str, measures: Mapping[str, Column]) -> DataFrame:
    """The panel with a count per measure, 0 where a month has no events: one conditional aggregate, one join."""
    return panel.join(conditional_counts(events, [*entity, month], measures), [*entity, month], "left").na.fill(0, list(measures))


def first_metadata(rows: DataFrame, key: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per key: the columns of its first row in an explicit order, by a grouped minimum."""
    first = F.min(F.struct(*order, *[F.col(c).alias(f"v_{c}") for c in columns]))
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(first.alias("_x")).select(key, *[F.col(f"_x.v_{c}").alias(c) for c in columns])


def risk_panel(events: DataFrame, entity: str, month: str, measures: Mapping[str, Column], sizes: Sequence[int], target: str, horizon: int, metadata: DataFrame | None = None) -> DataFrame:
    """Entity x month with counts, trailing sums, the sums before them, growth, month codes, metadata and the target: the
    sum of ``target`` in the next ``horizon`` months. Months without a whole future are marked not labelled."""
    panel = with_monthly_counts(month_panel(events, [entity], month), events, [entity], month, measures)
    panel = trailing_features(panel, [entity], month, list(measures), sizes)
    panel = future_sum(panel, [entity], month, target, horizon, "future")
    last = events.agg(F.max(month).alias("_last"))
    panel = panel.crossJoin(F.broadcast(last)).withColumn("labelled", F.col(month) <= F.add_months("_last", -horizon)).drop("_last")  # one row
    turn = 2 * F.pi() * F.month(month) / 12
    panel = panel.withColumns({"target": (F.col("future") > 0).cast("int"), "month_sin": F.round(F.sin(turn), 6) + 0.0, "month_cos": F.round(F.cos(turn), 6) + 0.0})
    return panel if metadata is None else lookup_join(panel, metadata, entity)


def rule_scores(panel: DataFrame, measure: str, sizes: Sequence[int]) -> DataFrame:
    """Scores without a model, per window: the last count, its positive increase, and their sum."""
    out = {}
    for k in sizes:
        last, before = F.col(f"{measure}_last_{k}m"), F.col(f"{measure}_prev_{k}m")
        out |= {f"count_{k}m": last, f"increase_{k}m": F.greatest(last - before, F.lit(0)), f"trend_{k}m": last + F.greatest(last - before, F.lit(0))}
    return panel.withColumns(out)


def feature_metrics(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """(feature, correlation, auc, equal_share) of each feature against the label, to find leaks. The area under the curve
    counts ties half and is of the better direction; it comes from the table of distinct values per feature."""
    long = df.select(F.col(label).cast("double").alias("y"), *[F.col(c).cast("double").alias(c) for c in features]).unpivot(["y"], list(features), "feature", "v").where("v is not null and y is not null")
    plain = long.groupBy("feature").agg(F.round(F.corr("v", "y"), 5).alias("correlation"), F.round(F.avg((F.col("v") == F.col("y")).cast("double")), 6).alias("equal_share"), F.sum("y").alias("_p"), F.count(F.lit(1)).alias("_n"))
    by_value = long.groupBy("feature", "v").agg(F.sum("y").alias("_pos"), F.sum(1 - F.col("y")).alias("_neg"))
    from tarnwerk.operators.windows import running

    r = running(by_value, ["feature", "v"], {"_below": F.col("_neg")})
    r = r.join(r.groupBy("feature").agg(F.min("_below").alias("_first")), "feature")
    wins = r.groupBy("feature").agg(F.sum(F.col("_pos") * (F.col("_below") - F.col("_first") + F.col("_neg") / 2)).alias("_w"))
    auc = F.try_divide(F.col("_w"), F.col("_p") * (F.col("_n") - F.col("_p")))
    return plain.join(wins, "feature").select("feature", "correlation", F.round(F.greatest(auc, 1 - auc), 6).alias("auc"), "equal_share")


def choose_threshold(df: DataFrame, label: str, score: str, top_share: float = 0.1, steps: int = 99) -> DataFrame:
    """(strategy, threshold, value): the score quantile that selects ``top_share``, and of ``steps`` even thresholds the one
    of best F2, of equal ones the one that selects fewest. Read off the table of distinct scores."""
    c = metrics.curve(df, label, score)
    totals = c.agg(F.sum("pos").alias("_p"))
    at = F.explode(F.transform(F.sequence(F.lit(1), F.lit(steps)), lambda i: i / F.lit(steps + 1.0)))
    grid = df.sparkSession.range(1).select(at.alias("threshold"))  # ``steps`` rows
    hit = c.join(F.broadcast(grid), F.col("score") >= F.col("threshold")).groupBy("threshold").agg(F.sum("pos").alias("tp"), F.sum("neg").alias("fp"))
    f2 = hit.crossJoin(F.broadcast(totals)).select("threshold", (F.col("tp") + F.col("fp")).alias("_sel"), F.round(5.0 * F.col("tp") / (4 * F.col("_p") + F.col("tp") + F.col("fp")), 6).alias("value"))
    best = f2.agg(F.max(F.struct("value", -F.col("_sel"), -F.col("threshold"))).alias("_b")).select(F.lit("f2").alias("strategy"), F.round(-F.col("_b.col3"), 6).alias("threshold"), F.col("_b.value").alias("value"))
    values = value_table(df.select(F.lit("all").alias("_g"), F.col(score).alias("_s")), "_g", "_s")
    top = quantiles(values, "_g", "_s", {"threshold": 1 - top_share}).select(F.lit("top_share").alias("strategy"), F.round("threshold", 6).alias("threshold"), F.lit(float(top_share)).alias("value"))
    return best.unionByName(top)


def expanding_folds(df: DataFrame, period: str, folds: int) -> DataFrame:
    """(fold, period, part): of the ordered periods the last ``folds`` equal blocks are tested one by one, each trained on
    all periods before it. One row per fold and period; rows are joined to it by period."""
    p = df.where(F.col(period).isNotNull()).select(period).distinct()
    w = Window.partitionBy()  # a row per period
    p = p.withColumns({"_i": F.row_number().over(w.orderBy(period)) - 1, "_n": F.count(F.lit(1)).over(w)})
    size = F.floor(F.col("_n") / F.lit(folds + 1))
    each = p.withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(folds))))
    start = F.col("_n") - (F.lit(folds + 1) - F.col("fold")) * size
    part = F.when(F.col("_i") < start, "train").when(F.col("_i") < start + size, "test")
    return each.select("fold", period, part.alias("part")).where(F.col("part").isNotNull())


def feature_family(name: Column, families: Sequence[tuple[str, str]] = FAMILIES, otherwise: str = "other") -> Column:
    """The family of a feature by its name, the first that fits."""
    out = F.lit(otherwise)
    for pattern, family in reversed(families):
        out = F.when(F.lower(name).rlike(pattern), family).otherwise(out)
    return out


def raw_feature(name: Column, categorical: Sequence[str]) -> Column:
    """The column a transformed feature stems from: ``num__x`` is x, ``cat__x_value`` the longest categorical column x."""
    body = F.regexp_replace(name, "^(?:num|cat)__", "")
    out = body
    for c in sorted(categorical, key=len):
        out = F.when(name.startswith("cat__") & ((body == c) | body.startswith(f"{c}_")), c).otherwise(out)
    return out


def importance_rollups(importances: DataFrame, categorical: Sequence[str]) -> DataFrame:
    """(level, name, importance): absolute importances summed by raw feature and by family."""
    raw = importances.select(raw_feature(F.col("feature"), categorical).alias("raw"), F.abs("importance").alias("v"))
    by_raw = raw.groupBy(F.lit("feature").alias("level"), F.col("raw").alias("name")).agg(F.round(F.sum("v"), 6).alias("importance"))
    return by_raw.unionByName(raw.groupBy(F.lit("family").alias("level"), feature_family(F.col("raw")).alias("name")).agg(F.round(F.sum("v"), 6).alias("importance")))


def drivers(df: DataFrame, row_id: str, features: Sequence[str], importances: Mapping[str, float], top: int) -> DataFrame:
    """(row_id, drivers): the features that stand out most in each row, as ``Name=value; …``: importance times how many
    deviations the value lies above the median, a quarter for other values that are not 0. Statistics are of all rows."""
    long = df.select(row_id, *[F.col(c).cast("double").alias(c) for c in features]).unpivot([row_id], list(features), "feature", "v").where("v is not null")
    stats = quantiles(value_table(long, "feature", "v"), "feature", "v", {"median": 0.5, "p90": 0.9}).join(long.groupBy("feature").agg(F.stddev_pop("v").alias("std")), "feature")
    weight = F.create_map(*[x for k, v in importances.items() for x in (F.lit(k), F.lit(float(v)))])
    s = long.join(F.broadcast(stats), "feature")  # a row per feature
    scale = F.when(F.col("std") > 0, F.col("std")).otherwise(F.greatest(F.abs(F.col("p90") - F.col("median")), F.lit(1.0)))
    above = F.greatest(F.lit(0.0), (F.col("v") - F.col("median")) / scale)
    s = s.withColumn("score", F.round(F.greatest(F.coalesce(weight[F.col("feature")], F.lit(0.0)), F.lit(0.0)) * F.when((F.col("v") != 0) & (above == 0), 0.25).otherwise(above), 6)).where("score > 0")
    best = top_per_group(s, [row_id], [F.desc("score"), "feature", "v"], top, "_r")
    line = F.concat(friendly(F.col("feature")), F.lit("="), F.format_string("%.2f", F.col("v")))
    return best.groupBy(row_id).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_r", line.alias("x")))), lambda x: x["x"]), "; ").alias("drivers"))


def monthly_stats(df: DataFrame, keys: Sequence[str], counters: Mapping[str, Column], distinct: Mapping[str, str] = {}, means: Sequence[str] = (), maxima: Sequence[str] = ()) -> DataFrame:
    """Per keys: rows, conditional counts, distinct values, means and maxima in one grouped pass."""
    extra = [F.count_distinct(c).alias(n) for n, c in distinct.items()] + [F.round(F.avg(c), 6).alias(f"mean_{c}") for c in means] + [F.max(c).alias(f"max_{c}") for c in maxima]
    return conditional_counts(df, keys, {"n": F.lit(True)} | dict(counters), extra)


def feature_variants(columns: Sequence[str], location: Sequence[str]) -> dict[str, list[str]]:
    """The column lists of the variants: all, without the location columns, and these alone."""
    own = [c for c in columns if c in location]
    return {"full": list(columns), "no_location": [c for c in columns if c not in location], "location_only": own}


