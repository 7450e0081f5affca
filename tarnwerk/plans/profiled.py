"""Profiles of themes, places and periods over the unified events and their clusters; names begin with operator handles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarnwerk.operators import aggregates as A
from tarnwerk.operators import profiles as P
from tarnwerk.operators import retrieval
from tarnwerk.operators.windows import top_per_group
from tarnwerk.plans._register import Register
from tarnwerk.plans.records import _CL, _EV, _events, clustered

R = Register()

#: Conditional counters of events, as SQL both engines read.
COUNTERS = {
    "injury_count": "any_injury", "severe_count": "severe_actual", "fatal_count": "fatality", "losttime_count": "losttime", "restricted_count": "restrictedtime", "inpatient_count": "inpatient",
    "emergency_count": "emergencyroom", "near_miss_count": "source_type = 'near_miss'", "hazard_count": "source_type = 'hazard_identification'", "incident_count": "source_type = 'incident'",
    "audit_count": "source_type = 'audit'", "task_count": "source_type = 'task'", "open_count": "is_open_task", "overdue_count": "is_overdue_task", "text_count": "has_text", "english_count": "is_english_text",
}
#: Weights of the review score.
WEIGHTS = {"severe_count": 10.0, "injury_count": 4.0, "near_miss_count": 3.0, "hazard_count": 1.0, "overdue_count": 2.0, "open_count": 0.5}
_COUNT_SQL = ", ".join(f"count(*) FILTER (coalesce({c}, false)) AS {n}" for n, c in COUNTERS.items())
_SCORE_SQL = " + ".join(f"{n} * {w}" for n, w in WEIGHTS.items())


def _counters():
    return {n: F.expr(c) for n, c in COUNTERS.items()}


_FACTS = f"(SELECT *, round({_SCORE_SQL}, 4) AS review_score FROM (SELECT location_id, strftime(event_date, '%Y-%m') AS period, count(*) AS event_count, {_COUNT_SQL}, min(event_date) AS first_date, max(event_date) AS last_date FROM {_EV} WHERE event_date IS NOT NULL GROUP BY ALL))"


@R.add(f"SELECT * FROM {_FACTS}")
def ag14_facts(t):
    """Sixteen counters, the dates and a priority score of each location and month."""
    e = _events(t).where("event_date is not null").withColumn("period", F.date_format("event_date", "yyyy-MM"))
    g = A.conditional_counts(e, ["location_id", "period"], {"event_count": F.lit(True)} | _counters(), [F.min("event_date").alias("first_date"), F.max("event_date").alias("last_date")])
    return g.withColumn("review_score", F.round(sum((F.col(n) * w for n, w in WEIGHTS.items()), F.lit(0.0)), 4))


_SIGNAL = "(SELECT location_id, count(*) AS event_count, count(*) FILTER (coalesce(any_injury, false)) AS injuries, count(*) FILTER (source_type = 'audit') AS audits, count(*) FILTER (source_type = 'task') AS tasks, count(*) FILTER (coalesce(is_overdue_task, false)) AS overdue, count(DISTINCT category) AS categories, count(DISTINCT strftime(event_date, '%Y-%m')) AS months, arg_min(site, (event_date, event_id, site)) FILTER (trim(site) <> '' AND event_date IS NOT NULL) AS site, arg_min(location_path, (event_date, event_id, location_path)) FILTER (trim(location_path) <> '' AND event_date IS NOT NULL) AS location_path FROM " + _EV + " WHERE location_id IS NOT NULL GROUP BY 1)"


@R.add(f"SELECT *, round(injuries * 5.0 + overdue * 2.0 + categories * 1.0 + audits * 0.5, 4) AS signal_score FROM {_SIGNAL}")
def ag17_signal_profile(t):
    """Of each place its first named site and path, counters, families, distinct categories and months, and a score."""
    e = _events(t).withColumn("month", F.date_format("event_date", "yyyy-MM"))
    e = e.withColumns({c: F.when(F.col("event_date").isNotNull(), F.col(c)) for c in ("site", "location_path")})
    counters = {"injuries": F.col("any_injury"), "audits": F.col("source_type") == "audit", "tasks": F.col("source_type") == "task", "overdue": F.col("is_overdue_task")}
    return P.signal_profile(e, "location_id", ["site", "location_path"], ["event_date", "event_id"], counters, {"categories": "category", "months": "month"}, {"injuries": 5, "overdue": 2, "categories": 1, "audits": 0.5})


_PIVOT_KINDS = ("near_miss", "hazard_identification", "incident", "audit", "task")


@R.add("SELECT location_id, count(*) AS events, " + ", ".join(f"count(*) FILTER (source_type = '{k}') AS {k}" for k in _PIVOT_KINDS) + f" FROM {_EV} WHERE location_id IS NOT NULL GROUP BY 1")
def j23_profile_pivots(t):
    """Base, family and kind pivots of a place in one grouped pass instead of three joins."""
    return A.conditional_counts(_events(t).where("location_id is not null"), ["location_id"], {"events": F.lit(True)} | {k: F.col("source_type") == k for k in _PIVOT_KINDS})


_PROFILE_KEYS = ("source_type", "category", "status")


@R.add("SELECT source_type, category, status, count(*) AS n, count(*) FILTER (description IS NULL OR trim(description) = '') AS without_text, grouping(source_type)::int + grouping(category)::int + grouping(status)::int AS depth FROM unified_event GROUP BY GROUPING SETS ((source_type, category, status), (source_type, category), (source_type), ())")
def ag16_accounting(t):
    """Record accounting by three nested keys, with totals of every level."""
    e = t("unified_event")
    g = e.rollup(*_PROFILE_KEYS).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("description").isNull() | (F.trim("description") == "")).alias("without_text"), sum((F.grouping(c).cast("int") for c in _PROFILE_KEYS), F.lit(0)).alias("depth"))
    return g.select(*_PROFILE_KEYS, "n", "without_text", "depth")


@R.add("SELECT table_name, column_name, value, n FROM (SELECT 'unified_event' AS table_name, 'source_type' AS column_name, source_type AS value, count(*) AS n FROM unified_event GROUP BY ALL UNION ALL SELECT 'unified_event', 'audit_type', audit_type, count(*) FROM unified_event GROUP BY ALL UNION ALL SELECT 'documents', 'lang', lang, count(*) FROM documents GROUP BY ALL)")
def ag37_scope_counts(t):
    """Counts per value of several columns in one long table."""
    long = None
    for name, column in (("unified_event", "source_type"), ("unified_event", "audit_type"), ("documents", "lang")):
        one = t(name).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), F.lit(column).alias("column_name"), "value", "n")
        long = one if long is None else long.unionByName(one)
    return long


# --- themes -----------------------------------------------------------------------------------------------------------
_TH = f"(SELECT e.*, strftime(e.event_date, '%Y-%m') AS period, c.theme_id, c.strength, c.assignment FROM {_EV} e JOIN (SELECT incident_id, max(theme_id) AS theme_id, max(CASE WHEN isnan(membership_strength) THEN NULL ELSE membership_strength END) AS strength, CASE WHEN max(CASE WHEN isnan(membership_strength) THEN NULL ELSE membership_strength END) >= 0.6 THEN 'strong' ELSE 'weak' END AS assignment FROM clustered_records WHERE incident_id IS NOT NULL GROUP BY 1) c ON e.event_id = 'incident_' || c.incident_id)"


def themed(t):
    """Events of incidents with their theme, its confidence and how sure the assignment is."""
    s = F.max(F.when(~F.isnan("membership_strength"), F.col("membership_strength")))
    c = t("clustered_records").where("incident_id is not null").groupBy("incident_id").agg(F.max("theme_id").alias("theme_id"), s.alias("strength"))
    c = c.select(F.concat(F.lit("incident_"), F.col("incident_id").cast("string")).alias("event_id"), "theme_id", "strength", F.when(F.col("strength") >= 0.6, "strong").otherwise("weak").alias("assignment"))
    return _events(t).withColumn("period", F.date_format("event_date", "yyyy-MM")).join(c, "event_id")


_TP_KEYS = ["location_id", "site", "period", "source_type", "theme_id"]
_TP_COUNTERS = {"injury_count": "any_injury", "severe_count": "severe_actual", "losttime_count": "losttime", "near_miss_count": "source_type = 'near_miss'", "hazard_count": "source_type = 'hazard_identification'", "strong_count": "assignment = 'strong'", "weak_count": "assignment = 'weak'", "text_count": "has_text"}
_TP_WEIGHTS = {"severe_count": 10.0, "injury_count": 4.0, "near_miss_count": 3.0, "hazard_count": 1.0}


def _mix_sql(src, keys, column, top, name):
    k = ", ".join(keys)
    return f"(SELECT {k}, string_agg({column} || '=' || n, '; ' ORDER BY r) AS {name} FROM (SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY n DESC, {column}) AS r FROM (SELECT {k}, {column}, count(*) AS n FROM {src} WHERE {column} IS NOT NULL GROUP BY ALL)) WHERE r <= {top} GROUP BY ALL)"


def _null_on(keys, a, b):
    return " AND ".join(f"{a}.{k} IS NOT DISTINCT FROM {b}.{k}" for k in keys)


_TP = (
    f"(SELECT p.*, m.category_mix, i.ids FROM (SELECT *, round({' + '.join(f'{n} * {w}' for n, w in _TP_WEIGHTS.items())}, 4) AS review_score FROM (SELECT {', '.join(_TP_KEYS)}, count(*) AS event_count, "
    + ", ".join(f"count(*) FILTER (coalesce({c}, false)) AS {n}" for n, c in _TP_COUNTERS.items())
    + f", min(event_date) AS first_date, max(event_date) AS last_date, round(avg(strength), 6) AS mean_confidence FROM {_TH} GROUP BY ALL)) p LEFT JOIN {_mix_sql(_TH, _TP_KEYS, 'category', 10, 'category_mix')} m ON {_null_on(_TP_KEYS, 'p', 'm')}"
    + f" LEFT JOIN (SELECT {', '.join(_TP_KEYS)}, string_agg(event_id, ';' ORDER BY r) AS ids FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(_TP_KEYS)} ORDER BY coalesce(strength, -1) DESC, event_id) AS r FROM {_TH}) WHERE r <= 10 GROUP BY ALL) i ON {_null_on(_TP_KEYS, 'p', 'i')})"
)


def theme_profile(t):
    e = themed(t).withColumn("_s", F.coalesce("strength", F.lit(-1.0)))
    return P.profile(e, _TP_KEYS, {n: F.expr(c) for n, c in _TP_COUNTERS.items()}, "event_date", "strength", _TP_WEIGHTS, {"category_mix": ("category", 10)}, "event_id", [F.desc("_s")])


@R.add(f"SELECT * FROM {_TP}")
def ag18_theme_profile(t):
    """Location, theme and period: counts by kind, dates, confidence, category mix, best ids and score."""
    return theme_profile(t)


_SUMS = ["event_count", "review_score", "injury_count", "severe_count", "near_miss_count", "hazard_count"]
_SUM_SQL = ", ".join(f"round(sum({c}), 4)::double AS {c}" if c == "review_score" else f"sum({c})::bigint AS {c}" for c in _SUMS)


@R.add(f"SELECT source_type, theme_id, period, count(DISTINCT location_id) AS locations_active, {_SUM_SQL} FROM {_TP} GROUP BY ALL")
def ag20_theme_trends(t):
    return P.rollup(theme_profile(t), ["source_type", "theme_id", "period"], "location_id", _SUMS, "locations_active").withColumn("review_score", F.round("review_score", 4))


_RK = ["location_id", "site", "source_type", "theme_id"]


@R.add(f"WITH tp AS (SELECT * FROM {_TP}) SELECT r.*, i.ids FROM (SELECT {', '.join(_RK)}, count(DISTINCT period) AS periods_active, {_SUM_SQL} FROM tp GROUP BY ALL) r LEFT JOIN (SELECT {', '.join(_RK)}, array_to_string(string_split(string_agg(ids, ';' ORDER BY period NULLS FIRST), ';')[1:20], ';') AS ids FROM tp GROUP BY ALL) i ON {_null_on(_RK, 'r', 'i')}")
def ag21_location_theme_rollup(t):
    p = theme_profile(t)
    rolled = P.rollup(p, _RK, "period", _SUMS, "periods_active").withColumn("review_score", F.round("review_score", 4))
    return P.with_ids(rolled, p, _RK, ["period"])


@R.add(f"WITH tp AS (SELECT * FROM {_TP}), l AS (SELECT site, period, source_type, string_agg(x, ', ' ORDER BY r) AS top FROM (SELECT *, 'T' || coalesce(theme_id::varchar, '?') || ' (' || event_count || ')' AS x, row_number() OVER (PARTITION BY site, period, source_type ORDER BY event_count DESC, theme_id NULLS FIRST, location_id NULLS FIRST) AS r FROM tp) WHERE r <= 5 GROUP BY ALL) SELECT a.*, b.per_family FROM (SELECT site, period, count(DISTINCT source_type) AS families, sum(event_count)::bigint AS event_count FROM tp GROUP BY ALL HAVING count(DISTINCT source_type) >= 2) a LEFT JOIN (SELECT site, period, string_agg(source_type || ': ' || top, ' | ' ORDER BY source_type) AS per_family FROM l WHERE source_type IS NOT NULL GROUP BY ALL) b ON {_null_on(['site', 'period'], 'a', 'b')}")
def ag22_multi_family(t):
    """Site-months with at least two families, and the five strongest themes of each family."""
    p = theme_profile(t)
    line = F.concat(F.lit("T"), F.coalesce(F.col("theme_id").cast("string"), F.lit("?")), F.lit(" ("), F.col("event_count").cast("string"), F.lit(")"))
    return P.several_families(p, ["site", "period"], "source_type", "event_count", [F.desc("event_count"), "theme_id", "location_id"], line)


@R.add(f"SELECT theme_id, count(*) AS event_count, count(*) FILTER (assignment = 'strong') AS strong_count, count(*) FILTER (assignment = 'weak') AS weak_count, round(avg(strength), 6) AS mean_confidence, count(DISTINCT site) AS sites, min(event_date) AS first_date, max(event_date) AS last_date, any_value(m.category_mix) AS category_mix FROM {_TH} t LEFT JOIN {_mix_sql(_TH, ['theme_id'], 'category', 5, 'category_mix')} m USING (theme_id) WHERE theme_id IS NOT NULL GROUP BY 1")
def ag23_theme_catalog(t):
    e = themed(t).where("theme_id is not null")
    g = e.groupBy("theme_id").agg(F.count(F.lit(1)).alias("event_count"), F.count_if(F.col("assignment") == "strong").alias("strong_count"), F.count_if(F.col("assignment") == "weak").alias("weak_count"), F.round(F.avg("strength"), 6).alias("mean_confidence"), F.count_distinct("site").alias("sites"), F.min("event_date").alias("first_date"), F.max("event_date").alias("last_date"))
    return P.same_keys(g, A.mix(e, ["theme_id"], "category", 5, "category_mix"), ["theme_id"])


@R.add(f"SELECT g.theme_id, g.n, s.sites, d.departments, k.source_mix FROM (SELECT theme_id, count(*) AS n FROM {_TH} WHERE theme_id IS NOT NULL GROUP BY 1) g LEFT JOIN {_mix_sql(_TH, ['theme_id'], 'site', 5, 'sites')} s USING (theme_id) LEFT JOIN {_mix_sql(_TH, ['theme_id'], 'department', 5, 'departments')} d USING (theme_id) LEFT JOIN {_mix_sql(_TH, ['theme_id'], 'source_type', 8, 'source_mix')} k USING (theme_id)")
def ag34_theme_profile(t):
    """Top sites, departments and sources of each theme."""
    e = themed(t).where("theme_id is not null")
    g = e.groupBy("theme_id").agg(F.count(F.lit(1)).alias("n"))
    for column, top, name in (("site", 5, "sites"), ("department", 5, "departments"), ("source_type", 8, "source_mix")):
        g = P.same_keys(g, A.mix(e, ["theme_id"], column, top, name), ["theme_id"])
    return g


@R.add(f"SELECT e.event_id, c.theme_id, k.theme_size, k.theme_mode_site FROM {_EV} e JOIN (SELECT incident_id, max(theme_id) AS theme_id FROM clustered_records WHERE incident_id IS NOT NULL GROUP BY 1) c ON e.event_id = 'incident_' || c.incident_id LEFT JOIN (SELECT theme_id, sum(n)::bigint AS theme_size, arg_min(site, (-n, site)) FILTER (site IS NOT NULL) AS theme_mode_site FROM (SELECT theme_id, site, count(*) AS n FROM {_TH} WHERE theme_id IS NOT NULL GROUP BY ALL) GROUP BY 1) k USING (theme_id)")
def j11_catalog_names(t):
    """Events with the size and main site of their theme, from a catalogue of one row per theme."""
    from tarnwerk.operators.joins import lookup_join

    e = themed(t)
    catalog = e.where("theme_id is not null").groupBy("theme_id").agg(F.count(F.lit(1)).alias("theme_size"), A.mode("site").alias("theme_mode_site"))
    return lookup_join(e.select("event_id", "theme_id"), catalog, "theme_id").select("event_id", "theme_id", "theme_size", "theme_mode_site")


@R.add(f"SELECT cluster_id, category, n, cluster_size, round(n / cluster_size, 6) AS share FROM (SELECT cluster_id, category, count(*) AS n FROM {_CL} WHERE cluster_id >= 0 GROUP BY ALL) JOIN (SELECT cluster_id, count(*) AS cluster_size FROM {_CL} WHERE cluster_id >= 0 GROUP BY 1) USING (cluster_id)")
def j22_crosstab_share(t):
    """Category counts of each cluster with the cluster's size and their share of it."""
    c = clustered(t).where("cluster_id >= 0")
    sizes = c.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("cluster_size"))
    return c.groupBy("cluster_id", "category").agg(F.count(F.lit(1)).alias("n")).join(sizes, "cluster_id").withColumn("share", F.round(F.col("n") / F.col("cluster_size"), 6))


@R.add(f"SELECT round(avg((theme_id >= 0 AND cluster_id >= 0)::int), 6) AS valid_share, avg((theme_id >= 0 AND cluster_id >= 0)::int) > 0.2 AS has_themes, count(*) FILTER (theme_id >= 0 AND NOT coalesce(is_outlier, false)) AS trainable FROM clustered_records")
def cp12_existing_themes(t):
    """Whether a table comes with themes already: more than a fifth of its pairs are valid."""
    c = t("clustered_records")
    valid = F.coalesce((F.col("theme_id") >= 0) & (F.col("cluster_id") >= 0), F.lit(False))
    known = F.when(F.col("theme_id").isNull() & F.col("cluster_id").isNull(), None).when((F.col("theme_id") >= 0) & (F.col("cluster_id") >= 0), 1.0).when(F.col("theme_id").isNull() | F.col("cluster_id").isNull(), F.when((F.col("theme_id") < 0) | (F.col("cluster_id") < 0), 0.0)).otherwise(0.0)
    del valid
    return c.agg(F.round(F.avg(known), 6).alias("valid_share"), (F.avg(known) > 0.2).alias("has_themes"), F.count_if((F.col("theme_id") >= 0) & ~F.coalesce("is_outlier", F.lit(False))).alias("trainable"))


_WT = "(SELECT theme_id, term, sum(weight) / any_value(n) AS w FROM v2 JOIN (SELECT incident_id, theme_id FROM th) USING (incident_id) JOIN (SELECT theme_id, count(*) AS n FROM th GROUP BY 1) USING (theme_id) GROUP BY ALL)"
_CARDS = """
WITH th AS (SELECT incident_id, max(theme_id) AS theme_id, min(ml_text_early) AS text, max(incident_category_name) AS role FROM clustered_records WHERE incident_id IS NOT NULL AND theme_id IS NOT NULL GROUP BY 1),
cc AS (SELECT incident_id, term, count(*) AS tf FROM (SELECT incident_id, unnest(a || list_transform(range(1, len(a)), lambda i: a[i] || ' ' || a[i + 1])) AS term FROM (SELECT incident_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_\\-/]{2,}') AS a FROM th)) GROUP BY ALL),
nn AS (SELECT count(*) AS n FROM th), dd AS (SELECT term, count(*) AS df FROM cc GROUP BY 1 HAVING count(*) >= 2 AND count(*) <= 0.95 * (SELECT n FROM nn)),
v1 AS (SELECT incident_id, term, (1 + ln(tf)) * (ln((1.0 + (SELECT n FROM nn)) / (1 + df)) + 1) AS w FROM cc JOIN dd USING (term)),
v2 AS (SELECT incident_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY incident_id)) AS weight FROM v1),
ct AS """ + _WT + """, cn AS (SELECT theme_id, sqrt(sum(w * w)) AS norm FROM ct GROUP BY 1)
"""


def theme_cards(t):
    return t("clustered_records").where("incident_id is not null and theme_id is not null").groupBy("incident_id").agg(F.max("theme_id").alias("theme_id"), F.min("ml_text_early").alias("text"), F.max("incident_category_name").alias("role"))


def theme_vectors(t):
    """(cards, weights of their terms, mean weights of each theme)."""
    from tarnwerk.operators.lineage import cut

    cards = theme_cards(t)
    counts = retrieval.term_counts(cards, "incident_id", "text")
    weights = cut(retrieval.tf_idf(counts, "incident_id", cards.count()))
    sizes = cards.groupBy("theme_id").agg(F.count(F.lit(1)).alias("n"))
    mean = weights.join(cards.select("incident_id", "theme_id"), "incident_id").groupBy("theme_id", "term").agg(F.sum("weight").alias("w")).join(F.broadcast(sizes), "theme_id")  # a row per theme
    return cards, weights, mean.select("theme_id", "term", (F.col("w") / F.col("n")).alias("w"))


_CO = "(SELECT a.theme_id AS a, b.theme_id AS b, count(*) AS periods FROM (SELECT DISTINCT site, period, theme_id FROM " + _TH + " WHERE theme_id IS NOT NULL AND site IS NOT NULL AND period IS NOT NULL) a JOIN (SELECT DISTINCT site, period, theme_id FROM " + _TH + " WHERE theme_id IS NOT NULL AND site IS NOT NULL AND period IS NOT NULL) b ON a.site = b.site AND a.period = b.period AND a.theme_id < b.theme_id GROUP BY ALL)"


@R.add(_CARDS + f", s AS (SELECT x.theme_id AS a, y.theme_id AS b, round(sum(x.w * y.w) / any_value(p.norm) / any_value(q.norm), 4) AS similarity FROM ct x JOIN ct y ON x.term = y.term AND x.theme_id < y.theme_id JOIN cn p ON p.theme_id = x.theme_id JOIN cn q ON q.theme_id = y.theme_id GROUP BY ALL), j AS (SELECT a, b, coalesce(similarity, 0) AS similarity, coalesce(periods, 0) AS periods FROM s FULL JOIN {_CO} USING (a, b)) SELECT a, b, similarity, periods, link_score, CASE WHEN link_score >= 0.7 AND periods >= 2 THEN 'strong' WHEN link_score >= 0.5 THEN 'possible' ELSE 'none' END AS link FROM (SELECT *, round(0.65 * similarity + 0.35 * least(periods / 10.0, 1.0), 4) AS link_score FROM j)")
def tx14_theme_links(t):
    """Links between themes: likeness of their texts and the site-months in which both occur."""
    _, _, mean = theme_vectors(t)
    norm = mean.groupBy("theme_id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    x, y = mean.select(F.col("theme_id").alias("a"), "term", F.col("w").alias("x")), mean.select(F.col("theme_id").alias("b"), "term", F.col("w").alias("y"))
    dots = x.join(y, "term").where("a < b").groupBy("a", "b").agg(F.sum(F.col("x") * F.col("y")).alias("dot"))
    similar = dots.join(F.broadcast(norm.select(F.col("theme_id").alias("a"), F.col("norm").alias("p"))), "a").join(F.broadcast(norm.select(F.col("theme_id").alias("b"), F.col("norm").alias("q"))), "b")  # a row per theme
    once = themed(t).where("theme_id is not null and site is not null and period is not null").select("site", "period", "theme_id").distinct()
    together = once.withColumnRenamed("theme_id", "a").join(once.withColumnRenamed("theme_id", "b"), ["site", "period"]).where("a < b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("periods"))
    return P.theme_links(similar.select("a", "b", F.round(F.col("dot") / F.col("p") / F.col("q"), 4).alias("similarity")), together)


_NEAR = ", near AS (SELECT t.incident_id, t.theme_id, t.role, round(coalesce(sum(v.weight * c.w) / any_value(n.norm), 0), 5) AS score FROM th t LEFT JOIN v2 v USING (incident_id) LEFT JOIN ct c ON c.theme_id = t.theme_id AND c.term = v.term LEFT JOIN cn n ON n.theme_id = t.theme_id GROUP BY ALL)"


def card_scores(t):
    """Cards with their likeness to the centre of their theme."""
    cards, weights, mean = theme_vectors(t)
    norm = mean.groupBy("theme_id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    hit = weights.join(cards.select("incident_id", "theme_id"), "incident_id").join(mean, ["theme_id", "term"]).groupBy("incident_id").agg(F.sum(F.col("weight") * F.col("w")).alias("dot"))
    out = cards.join(hit, "incident_id", "left").join(F.broadcast(norm), "theme_id", "left")  # a row per theme
    return out.select("incident_id", "theme_id", "role", F.round(F.coalesce(F.col("dot") / F.col("norm"), F.lit(0.0)), 5).alias("score"))


@R.add(_CARDS + _NEAR + ", best AS (SELECT *, row_number() OVER (PARTITION BY theme_id, role ORDER BY score DESC, incident_id) AS in_role FROM near) SELECT theme_id, incident_id, role, rank_no::int AS rank_no FROM (SELECT *, row_number() OVER (PARTITION BY theme_id ORDER BY (in_role = 1) DESC, score DESC, incident_id) AS rank_no FROM best WHERE in_role <= 5) WHERE rank_no <= 5")
def tx16_representatives(t):
    """Typical cards of each theme: the nearest of every role first, then the nearest of all."""
    return P.representatives(card_scores(t), "theme_id", "role", "incident_id", "score", 5)


@R.add(_CARDS + _NEAR + ", tt AS (SELECT theme_id, string_agg(term, ', ' ORDER BY r) AS terms FROM (SELECT *, row_number() OVER (PARTITION BY theme_id ORDER BY round(w, 6) DESC, term) AS r FROM ct) WHERE r <= 8 GROUP BY 1), ee AS (SELECT theme_id, string_agg(incident_id::varchar, ';' ORDER BY r) AS examples FROM (SELECT *, row_number() OVER (PARTITION BY theme_id ORDER BY score DESC, incident_id) AS r FROM near) WHERE r <= 3 GROUP BY 1) SELECT theme_id, n AS size, terms, examples FROM (SELECT theme_id, count(*) AS n FROM th GROUP BY 1) LEFT JOIN tt USING (theme_id) LEFT JOIN ee USING (theme_id)")
def cp14_theme_descriptions(t):
    """Of each theme its size, strongest terms and nearest examples."""
    cards, _, mean = theme_vectors(t)
    top = top_per_group(mean.withColumn("w", F.round("w", 6)), ["theme_id"], [F.desc("w"), "term"], 8, "_r")
    terms = top.groupBy("theme_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_r", "term"))), lambda x: x["term"]), ", ").alias("terms"))
    examples = P.best_ids(card_scores(t), ["theme_id"], "incident_id", [F.desc("score")], 3, "examples")
    size = cards.groupBy("theme_id").agg(F.count(F.lit(1)).alias("size"))
    return size.join(terms, "theme_id", "left").join(examples, "theme_id", "left")


QUERIES, SQL = R.queries, R.sql
