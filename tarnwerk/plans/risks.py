"""Risk panels and model checks over the raw views; names begin with operator handles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarnwerk.operators import risk as K
from tarnwerk.operators.windows import month_panel
from tarnwerk.plans._register import Register
from tarnwerk.plans.records import _CL, _INCS, _TASKS, clustered, incidents, tasks
from tarnwerk.plans.search import _LAB, scored

R = Register()
_EVM = f"(SELECT * FROM {_INCS} WHERE location_id IS NOT NULL AND month IS NOT NULL)"
_CAL = f"(SELECT e.location_id, c.month FROM (SELECT DISTINCT location_id FROM {_EVM}) e, (SELECT unnest(generate_series((SELECT min(month) FROM {_EVM}), (SELECT max(month) FROM {_EVM}), INTERVAL 1 MONTH))::date AS month) c)"
_MEASURES = {"incident_count": "true", "active_count": "active AND NOT archived", "first_category_count": "incident_category_id = 1"}


def located(t):
    return incidents(t).where("location_id is not null and month is not null")


_J7 = f"(SELECT p.location_id, p.month, " + ", ".join(f"coalesce(x.{n}, 0) AS {n}" for n in _MEASURES) + f" FROM {_CAL} p LEFT JOIN (SELECT location_id, month, " + ", ".join(f"count(*) FILTER ({c}) AS {n}" for n, c in _MEASURES.items()) + f" FROM {_EVM} GROUP BY ALL) x USING (location_id, month))"


@R.add(f"SELECT location_id, strftime(month, '%Y-%m') AS month, {', '.join(_MEASURES)} FROM {_J7}")
def j7_monthly_counts(t):
    """The dense panel with all measures from one conditional aggregate."""
    e = located(t)
    out = K.with_monthly_counts(month_panel(e, ["location_id"], "month"), e, ["location_id"], "month", {n: F.expr(c) for n, c in _MEASURES.items()})
    return out.select("location_id", F.date_format("month", "yyyy-MM").alias("month"), *_MEASURES)


_META = "(SELECT location_id, arg_min(site, (event_date, event_id)) AS site, arg_min(department, (event_date, event_id)) AS department FROM (SELECT DISTINCT ON (event_id) location_id, event_id, event_date, coalesce(site, '') AS site, coalesce(department, '') AS department FROM unified_event WHERE event_id IS NOT NULL) WHERE location_id IS NOT NULL AND event_date IS NOT NULL GROUP BY 1)"


def metadata(t):
    e = t("unified_event").where("event_id is not null").dropDuplicates(["event_id"]).where("event_date is not null").withColumns({"site": F.coalesce("site", F.lit("")), "department": F.coalesce("department", F.lit(""))})
    return K.first_metadata(e, "location_id", ["event_date", "event_id"], ["site", "department"])


@R.add(f"SELECT location_id, strftime(month, '%Y-%m') AS month, m.site, m.department FROM {_CAL} LEFT JOIN {_META} m USING (location_id)")
def j8_panel_metadata(t):
    """The panel with the metadata of each place's first event."""
    from tarnwerk.operators.joins import lookup_join

    p = month_panel(located(t), ["location_id"], "month")
    return lookup_join(p, metadata(t), "location_id").select("location_id", F.date_format("month", "yyyy-MM").alias("month"), "site", "department")


@R.add(f"SELECT c.incident_id, c.cluster_id, i.location_id, strftime(i.month, '%Y-%m') AS month, coalesce(i.incident_category_id::varchar, c.category) AS category FROM {_CL} c JOIN {_INCS} i USING (incident_id) WHERE i.month IS NOT NULL")
def j9_clustered_context(t):
    """Cards with the context of their incident, which is authoritative; cards of unknown incidents or months drop out."""
    i = incidents(t).where("month is not null")
    return clustered(t).drop("month").join(i, "incident_id").select("incident_id", "cluster_id", "location_id", F.date_format("month", "yyyy-MM").alias("month"), F.coalesce(F.col("incident_category_id").cast("string"), "category").alias("category"))


_W = "OVER (PARTITION BY location_id ORDER BY month ROWS BETWEEN {0} AND {1})"
_PANEL_SQL = (
    f"(SELECT *, " + ", ".join(
        f"coalesce(sum(incident_count) {_W.format(f'{k - 1} PRECEDING', 'CURRENT ROW')}, 0)::bigint AS incident_count_last_{k}m, coalesce(sum(incident_count) {_W.format(f'{2 * k - 1} PRECEDING', f'{k} PRECEDING')}, 0)::bigint AS incident_count_prev_{k}m" for k in (3, 6))
    + f", coalesce(sum(incident_count) {_W.format('1 FOLLOWING', '3 FOLLOWING')}, 0)::bigint AS future, month <= (SELECT max(month) FROM {_EVM}) - INTERVAL 3 MONTH AS labelled FROM {_J7})"
)


def panel(t):
    return K.risk_panel(located(t), "location_id", "month", {n: F.expr(c) for n, c in _MEASURES.items()}, (3, 6), "incident_count", 3, metadata(t))


@R.add(f"SELECT p.location_id, strftime(month, '%Y-%m') AS month, incident_count, incident_count_last_3m, incident_count_prev_6m, future, (future > 0)::int AS target, labelled, m.site FROM {_PANEL_SQL} p LEFT JOIN {_META} m USING (location_id)")
def cp28_risk_panel(t):
    """The assembled dataset: counts, trailing windows, target, metadata."""
    return panel(t).select("location_id", F.date_format("month", "yyyy-MM").alias("month"), "incident_count", "incident_count_last_3m", "incident_count_prev_6m", "future", "target", "labelled", "site")


@R.add("SELECT location_id, strftime(month, '%Y-%m') AS month, " + ", ".join(f"incident_count_last_{k}m AS count_{k}m, greatest(incident_count_last_{k}m - incident_count_prev_{k}m, 0) AS increase_{k}m, incident_count_last_{k}m + greatest(incident_count_last_{k}m - incident_count_prev_{k}m, 0) AS trend_{k}m" for k in (3, 6)) + f" FROM {_PANEL_SQL}")
def ml12_rule_scores(t):
    """Baselines without a model: last counts, positive increases and their sums."""
    s = K.rule_scores(panel(t), "incident_count", (3, 6))
    return s.select("location_id", F.date_format("month", "yyyy-MM").alias("month"), *[f"{n}_{k}m" for k in (3, 6) for n in ("count", "increase", "trend")])


_FEATS = ("l_quantity", "l_discount", "l_tax", "l_extendedprice")
_AUC = "(SELECT greatest(w / (p * n), 1 - w / (p * n)) FROM (SELECT sum(pos * (below + neg / 2.0)) AS w, sum(pos) AS p, sum(neg) AS n FROM (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM (SELECT {0} AS v, sum((l_returnflag = 'R')::int) AS pos, sum((l_returnflag <> 'R')::int) AS neg FROM lineitem GROUP BY 1))))"


@R.add(" UNION ALL ".join(f"SELECT '{c}' AS feature, round(corr({c}, (l_returnflag = 'R')::int), 5) AS correlation, round({_AUC.format(c)}, 6) AS auc, round(avg(({c} = (l_returnflag = 'R')::int)::int), 6) AS equal_share FROM lineitem" for c in _FEATS))
def ml13_leakage(t):
    """Correlation, single-feature AUC and equality of every feature with the label."""
    return K.feature_metrics(t("lineitem").withColumn("y", (F.col("l_returnflag") == "R").cast("int")), "y", _FEATS)


_F2 = "SELECT th, round(5.0 * tp / (4 * (SELECT sum(y) FROM x) + tp + fp), 6) AS f2, tp + fp AS sel FROM (SELECT i / 100.0 AS th, sum(y) FILTER (s >= i / 100.0) AS tp, sum(1 - y) FILTER (s >= i / 100.0) AS fp FROM x, range(1, 100) r(i) GROUP BY 1) WHERE tp IS NOT NULL"


@R.add(f"WITH x AS {_LAB}, f AS ({_F2}) SELECT 'f2' AS strategy, round(arg_max(th, (f2, -sel, -th)), 6)::double AS threshold, max(f2)::double AS value FROM f UNION ALL SELECT 'top_share', round(quantile_cont(s, 0.9), 6), 0.1 FROM x")
def ml10_thresholds(t):
    """The threshold of best F2 and the one that selects the best tenth."""
    return K.choose_threshold(scored(t), "y", "s")


@R.add("WITH m AS (SELECT month, row_number() OVER (ORDER BY month) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month FROM orders)), e AS (SELECT fold, month, CASE WHEN i < n - (6 - fold) * (n // 6) THEN 'train' WHEN i < n - (6 - fold) * (n // 6) + n // 6 THEN 'test' END AS part FROM m, range(1, 6) r(fold)) SELECT fold::int AS fold, part, count(*) AS n, min(month) AS first_month, max(month) AS last_month FROM e JOIN (SELECT strftime(o_orderdate, '%Y-%m') AS month FROM orders) USING (month) WHERE part IS NOT NULL GROUP BY ALL")
def ml10_expanding_folds(t):
    """Folds by month, each tested on the block after its training months."""
    o = t("orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    f = K.expanding_folds(o, "month", 5)
    return o.join(F.broadcast(f), "month").groupBy("fold", "part").agg(F.count(F.lit(1)).alias("n"), F.min("month").alias("first_month"), F.max("month").alias("last_month"))  # a row per fold and month


_IMP = (("num__incident_count_last_3m", 0.5), ("num__incident_count_prev_3m", -0.2), ("num__overdue_task_count", 0.3), ("num__unique_theme_count", 0.1), ("cat__site_name_A", 0.25), ("cat__site_name_B", -0.15), ("cat__site_C", 0.05))
_IMP_SQL = "(VALUES " + ", ".join(f"('{f}', {v})" for f, v in _IMP) + ") v(feature, importance)"
_RAW = "CASE WHEN starts_with(feature, 'cat__site_name') THEN 'site_name' WHEN starts_with(feature, 'cat__site') THEN 'site' ELSE regexp_replace(feature, '^(?:num|cat)__', '') END"
_FAM = "CASE " + " ".join("WHEN regexp_matches(raw, '{0}') THEN '{1}'".format(*f) for f in K.FAMILIES) + " ELSE 'other' END"


@R.add(f"WITH r AS (SELECT {_RAW} AS raw, abs(importance) AS v FROM {_IMP_SQL}) SELECT 'feature' AS level, raw AS name, round(sum(v), 6)::double AS importance FROM r GROUP BY ALL UNION ALL SELECT 'family', {_FAM}, round(sum(v), 6)::double FROM r GROUP BY ALL")
def ag31_importance_rollups(t):
    """Importances of transformed features summed by raw feature and by family."""
    spark = t("region").sparkSession
    return K.importance_rollups(spark.createDataFrame(list(_IMP), "feature string, importance double"), ["site", "site_name"])


_DRV = {"l_quantity": 0.5, "l_discount": 0.3, "l_tax": 0.2}
_DRV_SQL = " UNION ALL ".join(f"SELECT id, '{c}' AS feature, {c}::double AS v, {w} * CASE WHEN {c} <> 0 AND greatest(0, ({c} - (SELECT median({c}) FROM lineitem)) / (SELECT stddev_pop({c}) FROM lineitem)) = 0 THEN 0.25 ELSE greatest(0, ({c} - (SELECT median({c}) FROM lineitem)) / (SELECT stddev_pop({c}) FROM lineitem)) END AS s FROM x" for c, w in _DRV.items())


@R.add(f"WITH x AS (SELECT *, l_orderkey || '-' || l_linenumber AS id FROM lineitem), d AS (SELECT id, feature, v, round(s, 6) AS s FROM ({_DRV_SQL})) SELECT id, string_agg(CASE feature WHEN 'l_quantity' THEN 'L Quantity' WHEN 'l_discount' THEN 'L Discount' ELSE 'L Tax' END || '=' || printf('%.2f', v), '; ' ORDER BY r) AS drivers FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY s DESC, feature, v) AS r FROM d WHERE s > 0) WHERE r <= 2 GROUP BY 1")
def ml14_row_drivers(t):
    """The two features that stand out most in each line."""
    li = t("lineitem").withColumn("id", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    return K.drivers(li, "id", list(_DRV), _DRV, 2)


@R.add(f"SELECT location_id, strftime(assigned_date, '%Y-%m') AS month, count(*) AS n, count(*) FILTER (completion_date IS NOT NULL) AS completed, count(*) FILTER (archived) AS archived_count, count(DISTINCT task_category_id) AS categories, round(avg(days), 6) AS mean_days, max(days) AS max_days FROM (SELECT *, floor(epoch(completion_date - assigned_date) / 86400)::bigint AS days FROM {_TASKS}) GROUP BY ALL")
def ag3_task_months(t):
    """Task features of a place and month: counts, distinct categories, mean and longest days to completion."""
    from tarnwerk.functions.text import day_difference

    k = tasks(t).withColumns({"month": F.date_format("assigned_date", "yyyy-MM"), "days": day_difference(F.col("completion_date"), F.col("assigned_date"))})
    return K.monthly_stats(k, ["location_id", "month"], {"completed": F.col("completion_date").isNotNull(), "archived_count": F.col("archived")}, {"categories": "task_category_id"}, ["days"], ["days"])


QUERIES, SQL = R.queries, R.sql
