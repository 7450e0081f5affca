"""Projection, cleaning, joins, aggregation and windows over the event records; names begin with operator handles."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tarnwerk.functions import text as T
from tarnwerk.functions.scalars import id_number, norm_id, safe_ratio, three_valued, truthy
from tarnwerk.operators import aggregates as A
from tarnwerk.operators import hierarchy, sampling
from tarnwerk.operators import windows as W
from tarnwerk.operators.joins import first_delivery, lookup_join
from tarnwerk.plans._register import Register

R = Register()
INC = "(SELECT incident_id, arg_min(i, loaded_at) AS r FROM incident_view i WHERE incident_id IS NOT NULL GROUP BY incident_id)"
MONTH = "strftime({0}, '%Y-%m')"


def incidents(t):
    """Each incident once: ids as numbers, the report month from its arrival, flags."""
    one = first_delivery(t("incident_view"), "incident_id", ["incident_category_id", "incident_status_id", "location_id", "active", "archived"])
    return one.select("incident_id", "incident_category_id", "incident_status_id", id_number(F.col("location_id")).alias("location_id"), "active", "archived", F.trunc(F.to_date("loaded_at"), "MM").alias("month"))


def injuries(t):
    one = first_delivery(t("incidentinjury_view"), "injury_id", ["incident_id", "lost_time", "restricted_time", "fatality", "emergency_room", "inpatient", "body_area"])
    return one.withColumn("incident_id", id_number(F.col("incident_id")))


def tasks(t):
    one = first_delivery(t("task_view"), "task_id", ["location_id", "task_status_id", "task_category_id", "source_type_id", "assigned_date", "completion_date", "revised_due_date", "marked_complete_date", "archived"])
    return one.withColumns({"location_id": id_number(F.col("location_id")), "task_status_id": id_number(F.col("task_status_id"))})


def _events(t):
    """unified_event, each event once."""
    return t("unified_event").where("event_id is not null").dropDuplicates(["event_id"])


_EV = "(SELECT DISTINCT ON (event_id) * FROM unified_event WHERE event_id IS NOT NULL)"
_NUM = "try_cast(regexp_replace(trim({0}), '\\.0*$', '') AS BIGINT)"
_TRUE = "coalesce(lower(trim({0})) IN ('true','1','yes','y','t','x'), false)"
_INJ = f"(SELECT injury_id, {_NUM.format('r.incident_id')} AS incident_id, r.lost_time AS lost_time, r.restricted_time AS restricted_time, r.fatality AS fatality, r.emergency_room AS emergency_room, r.inpatient AS inpatient, r.body_area AS body_area FROM (SELECT injury_id, arg_min(i, loaded_at) AS r FROM incidentinjury_view i WHERE injury_id IS NOT NULL GROUP BY injury_id))"
_INCS = f"(SELECT incident_id, r.incident_category_id AS incident_category_id, r.incident_status_id AS incident_status_id, {_NUM.format('r.location_id')} AS location_id, r.active AS active, r.archived AS archived, date_trunc('month', r.loaded_at)::date AS month FROM {INC})"
_TASKS = f"(SELECT task_id, {_NUM.format('r.location_id')} AS location_id, {_NUM.format('r.task_status_id')} AS task_status_id, r.task_category_id AS task_category_id, r.assigned_date AS assigned_date, r.completion_date AS completion_date, r.revised_due_date AS revised_due_date, r.marked_complete_date AS marked_complete_date, r.archived AS archived FROM (SELECT task_id, arg_min(t, loaded_at) AS r FROM task_view t WHERE task_id IS NOT NULL GROUP BY task_id))"
_LI = "(SELECT list_item_id, list_type_code, min(item) AS item FROM listitem_view WHERE list_item_id IS NOT NULL GROUP BY ALL)"


# --- projection and cleaning -----------------------------------------------------------------------------------------
@R.add("SELECT event_id, coalesce(source_type, '') AS source_type, coalesce(is_open_task, false) AS is_open_task, coalesce(any_injury, false) AS any_injury, is_english_text, coalesce(injury_record_count, 0)::int AS injury_record_count, coalesce(text_length, 0)::int AS text_length FROM unified_event")
def pr3_schema_defaults(t):
    """The enforced event schema with typed defaults: texts '', flags false, counts 0; three-valued flags stay null."""
    return T.with_defaults(t("unified_event"), T.EVENT_SCHEMA).select("event_id", "source_type", "is_open_task", "any_injury", "is_english_text", "injury_record_count", "text_length")


@R.add(f"SELECT task_id, coalesce(revised_due_date, completion_date, marked_complete_date, assigned_date) AS effective FROM {_TASKS}")
def pr4_first_date(t):
    return tasks(t).select("task_id", F.coalesce("revised_due_date", "completion_date", "marked_complete_date", "assigned_date").alias("effective"))


_CLEAN = "trim(regexp_replace(regexp_replace(regexp_replace(coalesce({0}, ''), '<[^>]{{1,200}}>', ' ', 'g'), '&nbsp;', ' ', 'g'), '\\s+', ' ', 'g'))"
_CLEANED = f"CASE WHEN lower({_CLEAN}) IN ('nan','none','null','nat') THEN '' ELSE {_CLEAN} END"


@R.add(f"SELECT DISTINCT audit_id, coalesce(nullif({_CLEANED.format('description')}, ''), nullif({_CLEANED.format('title')}, ''), '') AS text FROM audit_view")
def pr5_first_text(t):
    return t("audit_view").select("audit_id", T.first_text("description", "title").alias("text")).distinct()


@R.add(f"SELECT DISTINCT audit_id, concat_ws(' | ', nullif(concat('title: ', nullif({_CLEANED.format('title')}, '')), 'title: '), nullif(concat('description: ', nullif({_CLEANED.format('description')}, '')), 'description: ')) AS block FROM audit_view")
def pr6_text_block(t):
    return t("audit_view").select("audit_id", T.text_block("title", "description").alias("block")).distinct()


@R.add(f"SELECT event_id, x[1:400] AS retrieval_text, length(x[1:400])::int AS n_chars, greatest(1, length(x[1:400]) // 6)::int AS pseudo_words FROM (SELECT event_id, coalesce(nullif({_CLEANED.format('description')}, ''), nullif({_CLEANED.format('title')}, ''), '') AS x FROM {_EV})")
def pr11_retrieval_text(t):
    x = F.substring(T.first_text("description", "title"), 1, 400)
    return _events(t).select("event_id", x.alias("retrieval_text"), F.length(x).alias("n_chars"), F.greatest(F.lit(1), F.expr("length(retrieval_text) div 6").cast("int")).alias("pseudo_words"))


@R.add(f"SELECT DISTINCT incident_id, {_CLEANED.format('description')} AS text FROM incident_view")
def st1_clean_text(t):
    return t("incident_view").select("incident_id", T.clean(F.col("description")).alias("text")).distinct()


@R.add("SELECT doc_id, CASE WHEN length(x) > 80 THEN rtrim(x[1:77]) || '...' ELSE x END AS compact FROM (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS x FROM documents)")
def st2_compact_text(t):
    return t("documents").select("doc_id", T.compact(F.col("text"), 80).alias("compact"))


@R.add("SELECT doc_id, length(text)::int AS n_chars, CASE WHEN trim(text) = '' THEN 0 ELSE len(string_split_regex(trim(text, ' \n\t\r'), '\\s+')) END::int AS n_words FROM documents")
def st3_word_count(t):
    x = F.regexp_replace("text", r"^\s+|\s+$", "")
    return t("documents").select("doc_id", F.length("text").alias("n_chars"), F.when(x == "", 0).otherwise(F.size(F.split(x, r"\s+"))).alias("n_words"))


@R.add("SELECT doc_id, trim(regexp_replace(regexp_replace(lower(text), '[^a-z0-9\\-/ ]', ' ', 'g'), ' +', ' ', 'g')) AS terms_text FROM documents")
def st5_normalise_terms(t):
    return t("documents").select("doc_id", F.trim(F.regexp_replace(F.regexp_replace(F.lower("text"), r"[^a-z0-9\-/ ]", " "), " +", " ")).alias("terms_text"))


@R.add("SELECT event_id, array_to_string(list_sort(list_distinct(regexp_extract_all(coalesce(description, '') || ' ' || strftime(event_date, '%Y-%m-%d'), '[0-9]{4}-[0-9]{2}-[0-9]{2}'))), ';') AS dates FROM " + _EV)
def st13_iso_dates(t):
    x = F.concat(F.coalesce("description", F.lit("")), F.lit(" "), F.date_format("event_date", "yyyy-MM-dd"))
    return _events(t).select("event_id", F.array_join(F.array_sort(F.array_distinct(F.regexp_extract_all(x, F.lit(r"(\d{4}-\d{2}-\d{2})"), F.lit(1)))), ";").alias("dates"))


@R.add("SELECT DISTINCT site, trim(regexp_replace(lower(site), '[^a-z0-9]+', '_', 'g'), '_')[1:48] AS token FROM unified_event WHERE site IS NOT NULL")
def st14_feature_token(t):
    return t("unified_event").where("site is not null").select("site", T.feature_token(F.col("site")).alias("token")).distinct()


@R.add("SELECT doc_id, CASE WHEN regexp_matches(text, '[\\x{0400}-\\x{04FF}]') THEN 'cyrillic' WHEN regexp_matches(text, '[\\x{00C0}-\\x{017F}]') THEN 'latin_accented' ELSE 'latin' END AS script FROM documents")
def st18_script(t):
    return t("documents").select("doc_id", T.script(F.col("text")).alias("script"))


@R.add("SELECT doc_id, md5(text) AS content_hash FROM documents WHERE text IS NOT NULL")
def st22_content_hash(t):
    return t("documents").where("text is not null").select("doc_id", F.md5("text").alias("content_hash"))


@R.add(f"SELECT injury_id, {_TRUE.format('lost_time')} AS two_valued, CASE WHEN lower(trim(lost_time)) IN ('true','1','yes','y','t') THEN true WHEN lower(trim(lost_time)) IN ('false','0','no','n','f') THEN false END AS three_valued FROM {_INJ}")
def cp4_truthy(t):
    return injuries(t).select("injury_id", truthy(F.col("lost_time")).alias("two_valued"), three_valued(F.col("lost_time")).alias("three_valued"))


@R.add("SELECT DISTINCT location_id AS raw, nullif(CASE WHEN lower(trim(location_id)) = 'nan' THEN '' ELSE regexp_replace(trim(location_id), '^([+-]?[0-9]+)\\.0*$', '\\1') END, '') AS id FROM task_view")
def cp5_norm_id(t):
    return t("task_view").select(F.col("location_id").alias("raw"), norm_id(F.col("location_id")).alias("id")).distinct()


# --- hierarchy --------------------------------------------------------------------------------------------------------
_TREE = """
WITH RECURSIVE n AS (SELECT location_id AS node, min(parent_location_id) AS parent, coalesce(trim(min(location_name)), '') AS name FROM location_view WHERE location_id IS NOT NULL GROUP BY 1),
up AS (
  SELECT node, node AS at, parent AS next_id, [node] AS ids, [name] AS names, 0 AS hops FROM n
  UNION ALL SELECT u.node, n.node, n.parent, list_prepend(n.node, u.ids), list_prepend(n.name, u.names), u.hops + 1 FROM up u JOIN n ON u.next_id = n.node WHERE u.hops < 50 AND NOT list_contains(u.ids, n.node)
), w AS (SELECT node, max(hops) AS depth, arg_max(ids, hops) AS ids, arg_max(names, hops) AS names FROM up GROUP BY node),
p AS (SELECT node, depth, ids, list_filter(names, lambda x: NOT regexp_matches(x, '^[0-9]+(\\.0)?$') AND x <> '') AS names FROM w),
paths AS (SELECT node, depth::int AS depth, ids[1] AS root_id, array_to_string(ids, '/') AS id_path, array_to_string(list_filter(names, lambda x, i: i = 1 OR x <> names[i - 1]), ' > ') AS name_path FROM p)
"""


def paths(t):
    return hierarchy.ancestor_paths(t("location_view"), "location_id", "parent_location_id", "location_name")


@R.add(_TREE + "SELECT * FROM paths")
def gr1_ancestor_paths(t):
    return paths(t)


@R.add(_TREE + "SELECT node, s[1] AS level_1, s[2] AS level_2, s[3] AS level_3, concat_ws(' / ', s[1], s[2]) AS site, coalesce(s[5], 'Unknown') AS department FROM (SELECT node, string_split(name_path, ' > ') AS s FROM paths)")
def gr3_site_department(t):
    return hierarchy.levels(paths(t)).select("node", "level_1", "level_2", "level_3", "site", "department")


# --- joins ------------------------------------------------------------------------------------------------------------
@R.add(f"SELECT i.incident_id, coalesce(a.item, b.item) AS category FROM {_INCS} i LEFT JOIN {_LI} a ON i.incident_category_id = a.list_item_id AND a.list_type_code = 'incidentcategory' LEFT JOIN (SELECT list_item_id, min(item) AS item FROM {_LI} GROUP BY 1) b ON i.incident_category_id = b.list_item_id")
def j1_decode_with_fallback(t):
    """Codes decoded by (type, id), else by id under any type."""
    li = t("listitem_view").where("list_item_id is not null").groupBy("list_item_id", "list_type_code").agg(F.min("item").alias("item"))
    typed = li.where("list_type_code = 'incidentcategory'").select(F.col("list_item_id").alias("incident_category_id"), F.col("item").alias("typed"))
    any_type = li.groupBy(F.col("list_item_id").alias("incident_category_id")).agg(F.min("item").alias("other"))
    return lookup_join(lookup_join(incidents(t), typed, "incident_category_id"), any_type, "incident_category_id").select("incident_id", F.coalesce("typed", "other").alias("category"))


@R.add(f"SELECT k.task_id, coalesce(b.item, k.task_status_id::varchar) AS status FROM {_TASKS} k LEFT JOIN (SELECT list_item_id, min(item) AS item FROM {_LI} GROUP BY 1) b ON k.task_status_id = b.list_item_id")
def j2_decode_by_id(t):
    li = t("listitem_view").where("list_item_id is not null").groupBy(F.col("list_item_id").alias("task_status_id")).agg(F.min("item").alias("item"))
    return lookup_join(tasks(t), li, "task_status_id").select("task_id", F.coalesce("item", F.col("task_status_id").cast("string")).alias("status"))


@R.add(_TREE + f"SELECT k.task_id, k.location_id, coalesce(p.name_path, 'Unknown') AS location_path FROM {_TASKS} k LEFT JOIN paths p ON k.location_id = p.node")
def j3_location(t):
    dim = paths(t).select(F.col("node").alias("location_id"), "name_path")
    return lookup_join(tasks(t), dim, "location_id").select("task_id", "location_id", F.coalesce("name_path", F.lit("Unknown")).alias("location_path"))


_AGG_INJ = f"(SELECT incident_id, count(injury_id) AS injury_count, bool_or({_TRUE.format('lost_time')}) AS lost_any, bool_or({_TRUE.format('fatality')}) AS fatal_any, bool_or({_TRUE.format('fatality')} OR {_TRUE.format('lost_time')} OR {_TRUE.format('restricted_time')} OR {_TRUE.format('inpatient')}) AS severe FROM {_INJ} WHERE incident_id IS NOT NULL GROUP BY 1)"


def injury_agg(t):
    flags = {c: truthy(F.col(c)) for c in ("lost_time", "restricted_time", "fatality", "inpatient")}
    x = injuries(t).where("incident_id is not null").withColumns({f"_{k}": v for k, v in flags.items()})
    return x.groupBy("incident_id").agg(F.count("injury_id").alias("injury_count"), F.bool_or("_lost_time").alias("lost_any"), F.bool_or("_fatality").alias("fatal_any"), F.bool_or(F.col("_fatality") | F.col("_lost_time") | F.col("_restricted_time") | F.col("_inpatient")).alias("severe"))


@R.add(f"SELECT * FROM {_AGG_INJ}")
def ag1_injuries(t):
    return injury_agg(t)


@R.add(f"SELECT i.incident_id, coalesce(a.injury_count, 0) AS injury_count, coalesce(a.severe, false) AS severe FROM {_INCS} i LEFT JOIN {_AGG_INJ} a USING (incident_id)")
def j4_incident_injuries(t):
    return incidents(t).join(injury_agg(t), "incident_id", "left").select("incident_id", F.coalesce("injury_count", F.lit(0)).alias("injury_count"), F.coalesce("severe", F.lit(False)).alias("severe"))


_ID_M = f"(SELECT location_id, strftime(month, '%Y-%m') AS month, count(*) AS incidents, count(*) FILTER (active AND NOT archived) AS active_incidents FROM {_INCS} GROUP BY ALL)"
_TK_M = f"(SELECT location_id, strftime(assigned_date, '%Y-%m') AS month, count(*) AS tasks, count(*) FILTER (completion_date IS NOT NULL) AS completed FROM {_TASKS} GROUP BY ALL)"
_AU_M = "(SELECT scheduled_location_id AS location_id, strftime(actual_start, '%Y-%m') AS month, count(*) AS audits FROM (SELECT DISTINCT ON (audit_id) * FROM audit_view WHERE audit_id IS NOT NULL) GROUP BY ALL)"


def monthly(t):
    i = incidents(t).withColumn("month", F.date_format("month", "yyyy-MM"))
    i = A.conditional_counts(i, ["location_id", "month"], {"incidents": F.lit(True), "active_incidents": F.col("active") & ~F.col("archived")})
    k = A.conditional_counts(tasks(t).withColumn("month", F.date_format("assigned_date", "yyyy-MM")), ["location_id", "month"], {"tasks": F.lit(True), "completed": F.col("completion_date").isNotNull()})
    a = t("audit_view").where("audit_id is not null").dropDuplicates(["audit_id"]).groupBy(F.col("scheduled_location_id").alias("location_id"), F.date_format("actual_start", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("audits"))
    return i, k, a


@R.add(f"SELECT location_id, month, coalesce(sum(incidents), 0)::bigint AS incidents, coalesce(sum(active_incidents), 0)::bigint AS active_incidents, coalesce(sum(tasks), 0)::bigint AS tasks, coalesce(sum(completed), 0)::bigint AS completed, coalesce(sum(audits), 0)::bigint AS audits FROM (SELECT * FROM {_ID_M} UNION ALL BY NAME SELECT * FROM {_TK_M} UNION ALL BY NAME SELECT * FROM {_AU_M}) GROUP BY ALL")
def j5_monthly_features(t):
    """Full outer of three monthly aggregates, null keys meeting null keys: one union and one grouped sum."""
    i, k, a = monthly(t)
    u = i.unionByName(k, allowMissingColumns=True).unionByName(a, allowMissingColumns=True)
    return u.groupBy("location_id", "month").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("incidents", "active_incidents", "tasks", "completed", "audits")])


@R.add(f"SELECT month, sum(tasks)::bigint AS tasks, round(coalesce(sum(completed) / nullif(sum(tasks), 0), 0), 6) AS completed_ratio FROM {_TK_M} GROUP BY 1")
def ag5_ratio(t):
    _, k, _ = monthly(t)
    return k.groupBy("month").agg(F.sum("tasks").alias("tasks"), F.round(safe_ratio(F.sum("completed"), F.sum("tasks")), 6).alias("completed_ratio"))


@R.add("SELECT e.event_id, coalesce(c.cluster_id, -2)::int AS cluster_id FROM " + _EV + " e LEFT JOIN (SELECT incident_id, max(cluster_id) AS cluster_id FROM clustered_records WHERE incident_id IS NOT NULL GROUP BY 1) c ON e.source_id = c.incident_id AND starts_with(e.event_id, 'incident_')")
def j10_assignments(t):
    c = t("clustered_records").where("incident_id is not null").groupBy(F.concat(F.lit("incident_"), F.col("incident_id").cast("string")).alias("event_id")).agg(F.max("cluster_id").alias("c"))
    return _events(t).join(c, "event_id", "left").select("event_id", F.coalesce("c", F.lit(-2)).alias("cluster_id"))


@R.add(f"SELECT count(*) AS n, count(DISTINCT location_id) AS places FROM {_TASKS} k WHERE EXISTS (SELECT 1 FROM location_view l WHERE l.location_id = k.location_id AND l.archived)")
def j20_semi(t):
    gone = t("location_view").where("archived").select("location_id").distinct()
    return tasks(t).join(gone, "location_id", "left_semi").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("location_id").alias("places"))


@R.add(f"SELECT k.task_id FROM {_TASKS} k WHERE NOT EXISTS (SELECT 1 FROM location_view l WHERE l.location_id = k.location_id)")
def j21_anti(t):
    return tasks(t).join(t("location_view").select("location_id").distinct(), "location_id", "left_anti").select("task_id")


_CO = "(SELECT DISTINCT site, strftime(event_date, '%Y-%m') AS month, source_subtype FROM unified_event WHERE site IS NOT NULL AND event_date IS NOT NULL AND source_subtype IS NOT NULL)"


@R.add(f"SELECT a.source_subtype AS a, b.source_subtype AS b, count(*) AS periods FROM {_CO} a JOIN {_CO} b ON a.site = b.site AND a.month = b.month AND a.source_subtype < b.source_subtype GROUP BY ALL")
def j13_cooccurrence(t):
    """Pairs of subtypes and in how many site-months both occur: subtypes per site-month are few, records are reduced
    to them first."""
    x = t("unified_event").where("site is not null and event_date is not null and source_subtype is not null").select("site", F.date_format("event_date", "yyyy-MM").alias("month"), "source_subtype").distinct()
    return x.withColumnRenamed("source_subtype", "a").join(x.withColumnRenamed("source_subtype", "b"), ["site", "month"]).where("a < b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("periods"))


# --- aggregation ------------------------------------------------------------------------------------------------------
@R.add("SELECT coalesce(nullif(trim(detected_language), ''), 'Unknown') AS value, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 4) AS percent FROM unified_event GROUP BY 1")
def ag6_value_counts(t):
    return A.value_counts(t("unified_event"), "detected_language")


@R.add("SELECT strftime(event_date, '%Y-%m') AS month, category, count(*) AS n FROM unified_event GROUP BY ALL")
def ag7_month_category(t):
    return t("unified_event").groupBy(F.date_format("event_date", "yyyy-MM").alias("month"), "category").agg(F.count(F.lit(1)).alias("n"))


_METRICS = {"all": "true", "with_injury": "any_injury", "severe": "severe_actual", "lost_time": "losttime", "open_task": "is_open_task", "overdue_task": "is_overdue_task", "with_text": "has_text"}


@R.add(" UNION ALL ".join(f"SELECT '{k}' AS metric, count(*) FILTER ({c}) AS n FROM unified_event" for k, c in _METRICS.items()))
def ag8_metrics(t):
    return A.metric_table(t("unified_event"), {k: F.expr(c) for k, c in _METRICS.items()})


@R.add("SELECT ord, n, round(coalesce(n * 100.0 / nullif(lead(n) OVER (ORDER BY ord), 0), 0), 4) AS percent_of_next FROM (SELECT 1 AS ord, count(*) FILTER (severe_actual) AS n FROM unified_event UNION ALL SELECT 2, count(*) FILTER (any_injury) FROM unified_event UNION ALL SELECT 3, count(*) FROM unified_event)")
def ag9_coverage(t):
    m = t("unified_event").agg(F.count(F.when(F.col("severe_actual"), 1)).alias("1"), F.count(F.when(F.col("any_injury"), 1)).alias("2"), F.count(F.lit(1)).alias("3"))
    long = m.unpivot([], ["1", "2", "3"], "o", "n").select(F.col("o").cast("int").alias("ord"), "n")
    nxt = F.lead("n").over(Window.partitionBy().orderBy("ord"))  # three rows
    return long.select("ord", "n", F.round(F.coalesce(F.try_divide(F.col("n") * 100.0, nxt), F.lit(0.0)), 4).alias("percent_of_next"))


_MISS = ["title", "description", "equipment", "vehicle", "investigation_start_date", "deleted_at"]


@R.add(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count, round(count(*) FILTER ({c} IS NULL) / count(*), 6) AS null_rate FROM incident_view" for c in _MISS))
def ag10_missingness(t):
    return A.missingness(t("incident_view"), _MISS)


_STAT = "SELECT '{0}' AS feature, count(*) FILTER ({0} IS NULL) AS missing, count(DISTINCT {0}) AS distinct_values, round(avg({0}), 4) AS mean, round(stddev_pop({0}), 4) AS std, round(quantile_cont({0}, 0.5), 4) AS median, round(quantile_cont({0}, 0.75), 4) AS p75, round(quantile_cont({0}, 0.9), 4) AS p90, max({0})::double AS max, round(avg((coalesce({0}, 0) <> 0)::int), 6) AS nonzero_share FROM lineitem"


@R.add(" UNION ALL ".join(_STAT.format(c) for c in ("l_quantity", "l_extendedprice", "l_discount")))
def ag32_reference_stats(t):
    return A.numeric_stats(t("lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])


@R.add("SELECT source_type, detected_language, count(*) AS n, count(DISTINCT location_id) AS places, min(event_date) AS first_date, max(event_date) AS last_date FROM unified_event GROUP BY GROUPING SETS ((source_type), (detected_language), ())")
def ag13_profile(t):
    e = t("unified_event")
    return e.groupingSets([["source_type"], ["detected_language"], []], "source_type", "detected_language").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("location_id").alias("places"), F.min("event_date").alias("first_date"), F.max("event_date").alias("last_date"))


_FACTS = f"(SELECT location_id, strftime(event_date, '%Y-%m') AS period, count(*) AS records, count(*) FILTER (any_injury) AS injuries, count(*) FILTER (severe_actual) AS severe, count(*) FILTER (is_open_task) AS open_tasks, count(*) FILTER (is_overdue_task) AS overdue, count(*) FILTER (has_text) AS with_text FROM {_EV} WHERE event_date IS NOT NULL GROUP BY ALL)"


def facts(t):
    e = _events(t).where("event_date is not null").withColumn("period", F.date_format("event_date", "yyyy-MM"))
    return A.conditional_counts(e, ["location_id", "period"], {"records": F.lit(True), "injuries": F.col("any_injury"), "severe": F.col("severe_actual"), "open_tasks": F.col("is_open_task"), "overdue": F.col("is_overdue_task"), "with_text": F.col("has_text")})


@R.add(f"SELECT *, injuries * 3 + severe * 5 + overdue AS priority FROM {_FACTS}")
def ag14_location_period_facts(t):
    return facts(t).withColumn("priority", F.col("injuries") * 3 + F.col("severe") * 5 + F.col("overdue"))


@R.add(f"SELECT location_id, count(DISTINCT period) AS periods, min(period) AS first_period, max(period) AS last_period, sum(records)::bigint AS records, sum(severe)::bigint AS severe FROM {_FACTS} GROUP BY 1")
def ag15_location_rollup(t):
    return facts(t).groupBy("location_id").agg(F.count_distinct("period").alias("periods"), F.min("period").alias("first_period"), F.max("period").alias("last_period"), F.sum("records").alias("records"), F.sum("severe").alias("severe"))


@R.add("SELECT site, count(*) FILTER (source_type LIKE 'incident%') AS incident, count(*) FILTER (source_type LIKE 'audit%') AS audit, count(*) FILTER (source_type LIKE 'task%') AS task FROM unified_event GROUP BY 1")
def ag17_site_pivot(t):
    e = t("unified_event")
    return A.conditional_counts(e, ["site"], {k: F.col("source_type").startswith(k) for k in ("incident", "audit", "task")})


_MIXQ = "(SELECT *, row_number() OVER (PARTITION BY {0} ORDER BY n DESC, {1}) AS r FROM (SELECT {0}, {1}, count(*) AS n FROM {2} WHERE {1} IS NOT NULL GROUP BY ALL))"


@R.add("SELECT site, string_agg(category || '=' || n, '; ' ORDER BY r) AS mix FROM " + _MIXQ.format("site", "category", "unified_event") + " WHERE r <= 5 GROUP BY 1")
def ag26_mix(t):
    return A.mix(t("unified_event"), ["site"], "category", 5)


@R.add("SELECT site, period, string_agg(category || ' (' || n || ')', ' || ' ORDER BY r) AS top FROM (SELECT *, row_number() OVER (PARTITION BY site, period ORDER BY n DESC, category) AS r FROM (SELECT site, strftime(event_date, '%Y') AS period, category, count(*) AS n FROM unified_event WHERE category IS NOT NULL AND event_date IS NOT NULL GROUP BY ALL)) WHERE r <= 10 GROUP BY ALL")
def ag19_top_of_period(t):
    e = t("unified_event").where("category is not null and event_date is not null").groupBy("site", F.date_format("event_date", "yyyy").alias("period"), "category").agg(F.count(F.lit(1)).alias("n"))
    top = W.top_per_group(e, ["site", "period"], [F.desc("n"), "category"], 10)
    return top.groupBy("site", "period").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank_no", F.concat("category", F.lit(" ("), F.col("n").cast("string"), F.lit(")")).alias("x")))), lambda s: s["x"]), " || ").alias("top"))


_CL = "(SELECT incident_id, max(cluster_id) AS cluster_id, max(site_name_filled) AS site, max(incident_month) AS month, max(incident_category_name) AS category, max(CASE WHEN isnan(membership_strength) THEN NULL ELSE membership_strength END) AS strength FROM clustered_records WHERE incident_id IS NOT NULL GROUP BY 1)"


def clustered(t):
    return t("clustered_records").where("incident_id is not null").groupBy("incident_id").agg(F.max("cluster_id").alias("cluster_id"), F.max("site_name_filled").alias("site"), F.max("incident_month").alias("month"), F.max("incident_category_name").alias("category"), F.max(F.when(~F.isnan("membership_strength"), F.col("membership_strength"))).alias("strength"))


@R.add(f"SELECT cluster_id, count(*) AS size, count(*) FILTER (category = 'Near Miss') AS near_misses, round(avg(strength) + 1e-9, 3) AS mean_strength, min(month) AS first_month, max(month) AS last_month FROM {_CL} WHERE cluster_id >= 0 GROUP BY 1")
def ag24_cluster_summary(t):
    return clustered(t).where("cluster_id >= 0").groupBy("cluster_id").agg(F.count(F.lit(1)).alias("size"), F.count_if(F.col("category") == "Near Miss").alias("near_misses"), F.round(F.avg("strength") + 1e-9, 3).alias("mean_strength"), F.min("month").alias("first_month"), F.max("month").alias("last_month"))


@R.add("SELECT cluster_id, arg_min(site, (-n, site)) AS mode_site FROM (SELECT cluster_id, site, count(*) AS n FROM " + _CL + " WHERE cluster_id >= 0 AND site IS NOT NULL GROUP BY ALL) GROUP BY 1")
def ag24_mode_site(t):
    return clustered(t).where("cluster_id >= 0 and site is not null").groupBy("cluster_id").agg(A.mode("site").alias("mode_site"))


@R.add(f"SELECT site, cluster_id, count(*) AS n, count(*) FILTER (category = 'Near Miss') AS near_miss, count(*) FILTER (category = 'Hazard Identification') AS hazard FROM {_CL} WHERE cluster_id IS NOT NULL GROUP BY ALL")
def ag25_site_crosstab(t):
    return A.conditional_counts(clustered(t).where("cluster_id is not null"), ["site", "cluster_id"], {"n": F.lit(True), "near_miss": F.col("category") == "Near Miss", "hazard": F.col("category") == "Hazard Identification"})


@R.add(f"SELECT cluster_id, count(*) AS n FROM {_CL} WHERE cluster_id >= 0 GROUP BY 1 HAVING count(*) >= 5 ORDER BY n DESC, cluster_id LIMIT 10")
def ag29_top_ids(t):
    return clustered(t).where("cluster_id >= 0").groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n")).where("n >= 5").orderBy(F.desc("n"), "cluster_id").limit(10)


@R.add(f"SELECT month, round(avg((cluster_id = -1)::int), 6) AS outlier_rate FROM {_CL} WHERE cluster_id IS NOT NULL GROUP BY 1")
def ag38_outlier_rate(t):
    return clustered(t).where("cluster_id is not null").groupBy("month").agg(F.round(F.avg((F.col("cluster_id") == -1).cast("double")), 6).alias("outlier_rate"))


@R.add(f"SELECT count(*) AS clusters, max(n) AS largest, round(median(n), 2) AS median_size, round(max(n) / sum(n), 6) AS largest_share FROM (SELECT cluster_id, count(*) AS n FROM {_CL} WHERE cluster_id >= 0 GROUP BY 1)")
def ag36_cluster_quality(t):
    n = clustered(t).where("cluster_id >= 0").groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))
    return n.agg(F.count(F.lit(1)).alias("clusters"), F.max("n").alias("largest"), F.round(F.median("n"), 2).alias("median_size"), F.round(F.max("n") / F.sum("n"), 6).alias("largest_share"))


@R.add(f"SELECT site, month, round(sum(strength) / nullif(count(strength), 0), 6) AS mean_strength, count(strength) AS n FROM {_CL} GROUP BY ALL")
def ag28_membership(t):
    return clustered(t).groupBy("site", "month").agg(F.round(F.try_divide(F.sum("strength"), F.count("strength")), 6).alias("mean_strength"), F.count("strength").alias("n"))


# --- windows ----------------------------------------------------------------------------------------------------------
_PANEL = f"""
WITH f AS (SELECT location_id, month, count(*) AS n FROM {_INCS} WHERE location_id IS NOT NULL AND month IS NOT NULL GROUP BY ALL),
cal AS (SELECT unnest(generate_series((SELECT min(month) FROM f), (SELECT max(month) FROM f), INTERVAL 1 MONTH))::date AS month),
panel AS (SELECT e.location_id, cal.month, coalesce(f.n, 0) AS n FROM (SELECT DISTINCT location_id FROM f) e CROSS JOIN cal LEFT JOIN f USING (location_id, month))
"""


def panel(t):
    f = incidents(t).where("location_id is not null and month is not null").groupBy("location_id", "month").agg(F.count(F.lit(1)).alias("n"))
    return W.month_panel(f, ["location_id"], "month").join(f, ["location_id", "month"], "left").na.fill(0, ["n"])


@R.add(_PANEL + "SELECT location_id, strftime(month, '%Y-%m') AS month, n FROM panel")
def j6_month_panel(t):
    return panel(t).select("location_id", F.date_format("month", "yyyy-MM").alias("month"), "n")


@R.add(_PANEL + """SELECT location_id, strftime(month, '%Y-%m') AS month, a::bigint AS n_last_3m, p::bigint AS n_prev_3m, round(coalesce((a - p) / nullif(p, 0), 0), 6) AS n_growth_3m FROM (
SELECT location_id, month, sum(n) OVER (PARTITION BY location_id ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS a, coalesce(sum(n) OVER (PARTITION BY location_id ORDER BY month ROWS BETWEEN 5 PRECEDING AND 3 PRECEDING), 0) AS p FROM panel)""")
def wn1_trailing(t):
    return W.trailing_features(panel(t), ["location_id"], "month", ["n"], [3]).select("location_id", F.date_format("month", "yyyy-MM").alias("month"), "n_last_3m", "n_prev_3m", "n_growth_3m")


@R.add(_PANEL + "SELECT location_id, strftime(month, '%Y-%m') AS month, coalesce(sum(n) OVER (PARTITION BY location_id ORDER BY month ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING), 0)::bigint AS future_3m FROM panel")
def wn4_future(t):
    return W.future_sum(panel(t), ["location_id"], "month", "n", 3, "future_3m").select("location_id", F.date_format("month", "yyyy-MM").alias("month"), "future_3m")


_STOCK = f"(SELECT location_id, month, sum(o)::bigint AS opened, sum(c)::bigint AS closed FROM (SELECT location_id, strftime(assigned_date, '%Y-%m') AS month, 1 AS o, 0 AS c FROM {_TASKS} UNION ALL SELECT location_id, strftime(completion_date, '%Y-%m'), 0, 1 FROM {_TASKS}) WHERE location_id IS NOT NULL AND month IS NOT NULL GROUP BY ALL)"


@R.add(f"SELECT location_id, month, greatest(sum(opened) OVER w - sum(closed) OVER w, 0)::bigint AS open_tasks FROM {_STOCK} WINDOW w AS (PARTITION BY location_id ORDER BY month)")
def wn5_open_stock(t):
    k = tasks(t)
    moves = k.select("location_id", F.explode(F.array(F.struct(F.date_format("assigned_date", "yyyy-MM").alias("month"), F.lit(1).alias("o"), F.lit(0).alias("c")), F.struct(F.date_format("completion_date", "yyyy-MM").alias("month"), F.lit(0).alias("o"), F.lit(1).alias("c")))).alias("m")).select("location_id", "m.*")
    s = moves.where("location_id is not null and month is not null").groupBy("location_id", "month").agg(F.sum("o").alias("opened"), F.sum("c").alias("closed"))
    return W.open_stock(s, ["location_id"], "month", "opened", "closed", "open_tasks").select("location_id", "month", "open_tasks")


@R.add(f"SELECT a.location_id, strftime(a.month, '%Y-%m') AS month, count(DISTINCT b.incident_category_id) AS kinds_3m FROM (SELECT DISTINCT location_id, month FROM {_INCS} WHERE location_id IS NOT NULL AND incident_category_id IS NOT NULL AND month IS NOT NULL) a JOIN {_INCS} b ON a.location_id = b.location_id AND b.month <= a.month AND b.month > a.month - INTERVAL 3 MONTH AND b.incident_category_id IS NOT NULL GROUP BY ALL")
def wn7_rolling_distinct(t):
    out = W.rolling_distinct(incidents(t).where("location_id is not null"), ["location_id"], "month", "incident_category_id", 3, "kinds_3m")
    return out.select("location_id", F.date_format("month", "yyyy-MM").alias("month"), "kinds_3m")


_CM = f"(SELECT cluster_id, month, count(*) AS n FROM {_CL} WHERE cluster_id >= 0 AND month IS NOT NULL GROUP BY ALL)"


@R.add(f"SELECT cluster_id, month, n, sum(n) OVER (PARTITION BY cluster_id ORDER BY month ROWS 2 PRECEDING)::bigint AS n_3 FROM {_CM}")
def wn8_rolling_rows(t):
    m = clustered(t).where("cluster_id >= 0 and month is not null").groupBy("cluster_id", "month").agg(F.count(F.lit(1)).alias("n"))
    return m.withColumn("n_3", F.sum("n").over(Window.partitionBy("cluster_id").orderBy("month").rowsBetween(-2, 0)))


@R.add(f"SELECT cluster_id, periods, round(a, 4) AS recent_mean, round(b, 4) AS earlier_mean, CASE WHEN periods < 4 THEN 'short_history' WHEN abs(a - b) >= 2 AND a - b > 0.25 * b THEN 'increasing' WHEN abs(a - b) >= 2 AND a - b < -0.25 * b THEN 'decreasing' ELSE 'stable' END AS trend FROM (SELECT cluster_id, count(*) AS periods, avg(n) FILTER (r <= 3) AS a, avg(n) FILTER (r > 3) AS b FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY month DESC) AS r FROM {_CM}) GROUP BY 1)")
def wn9_trend_flag(t):
    m = clustered(t).where("cluster_id >= 0 and month is not null").groupBy("cluster_id", "month").agg(F.count(F.lit(1)).alias("n"))
    return W.trend_flag(m, ["cluster_id"], "month", "n")


_Q = "(SELECT o_custkey, sum(CASE WHEN year(o_orderdate) % 2 = 0 THEN 1 ELSE 0 END)::bigint AS now, sum(CASE WHEN year(o_orderdate) % 2 = 1 THEN 1 ELSE 0 END)::bigint AS before FROM orders GROUP BY 1)"


@R.add(f"SELECT o_custkey, now, before, CASE WHEN before = 0 AND now > 0 THEN 'new' WHEN abs(now - before) >= 1 AND now - before > 0.25 * before THEN 'up' WHEN abs(now - before) >= 1 AND now - before < -0.25 * before THEN 'down' ELSE 'flat' END AS trend FROM {_Q}")
def wn10_trend_label(t):
    even = F.year("o_orderdate") % 2 == 0
    g = t("orders").groupBy("o_custkey").agg(F.sum(even.cast("int")).alias("now"), F.sum((~even).cast("int")).alias("before"))
    return g.withColumn("trend", W.trend_label(F.col("now"), F.col("before")))


_SC = "(SELECT o_custkey, round(sum(o_totalprice), 2) AS score FROM orders GROUP BY 1)"


@R.add(f"SELECT o_custkey, score, r AS rank_no, round((n - r + 1) / n, 6) AS percentile, CASE WHEN r / n <= 0.05 THEN 'top' WHEN r / n <= 0.10 THEN 'high' WHEN r / n <= 0.25 THEN 'watch' ELSE 'other' END AS tier FROM (SELECT *, row_number() OVER (ORDER BY score DESC, o_custkey) AS r, count(*) OVER () AS n FROM {_SC})")
def wn14_tiers(t):
    s = t("orders").groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("score"))
    return W.ranked(s, "score", ["o_custkey"])


@R.add(f"SELECT tier, count(*) AS n, min(score) AS least, max(score) AS most FROM (SELECT score, CASE WHEN r / n <= 0.05 THEN 'top' WHEN r / n <= 0.10 THEN 'high' WHEN r / n <= 0.25 THEN 'watch' ELSE 'other' END AS tier FROM (SELECT *, row_number() OVER (ORDER BY score DESC, o_custkey) AS r, count(*) OVER () AS n FROM {_SC})) GROUP BY 1")
def ag30_tier_summary(t):
    s = t("orders").groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("score"))
    return W.ranked(s, "score", ["o_custkey"]).groupBy("tier").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"), F.max("score").alias("most"))


@R.add("SELECT cluster_id, incident_id, rank_no::int AS rank_no FROM (SELECT cluster_id, incident_id, row_number() OVER (PARTITION BY cluster_id ORDER BY coalesce(strength, -1) DESC, incident_id) AS rank_no FROM " + _CL + " WHERE cluster_id >= 0) WHERE rank_no <= 5")
def wn15_representatives(t):
    c = clustered(t).where("cluster_id >= 0").withColumn("s", F.coalesce("strength", F.lit(-1.0)))
    return W.top_per_group(c, ["cluster_id"], [F.desc("s"), "incident_id"], 5).select("cluster_id", "incident_id", "rank_no")


@R.add("SELECT DISTINCT month(o_orderdate)::int AS m, round(sin(2 * pi() * month(o_orderdate) / 12), 6) + 0.0 AS month_sin, round(cos(2 * pi() * month(o_orderdate) / 12), 6) + 0.0 AS month_cos FROM orders")
def wn20_cyclical(t):
    a = 2 * F.pi() * F.month("o_orderdate") / 12
    return t("orders").select(F.month("o_orderdate").alias("m"), (F.round(F.sin(a), 6) + 0.0).alias("month_sin"), (F.round(F.cos(a), 6) + 0.0).alias("month_cos")).distinct()


# --- order, sets, dates, samples --------------------------------------------------------------------------------------
@R.add("SELECT location_id, n FROM (SELECT location_id, count(*) AS n FROM unified_event WHERE location_id IS NOT NULL GROUP BY 1) ORDER BY n DESC, location_id LIMIT 50")
def tk2_top_locations(t):
    return t("unified_event").where("location_id is not null").groupBy("location_id").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "location_id").limit(50)


@R.add(f"SELECT round(avg(hit), 6) AS capture FROM (SELECT (score > 0 AND r <= ceil(n * 0.1))::int AS hit FROM (SELECT *, row_number() OVER (ORDER BY score DESC, o_custkey) AS r, count(*) OVER () AS n FROM {_SC}))")
def tk6_top_fraction(t):
    s = W.ranked(t("orders").groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("score")), "score", ["o_custkey"], total="n")
    return s.agg(F.round(F.avg(((F.col("score") > 0) & (F.col("rank_no") <= F.ceil(F.col("n") * 0.1))).cast("double")), 6).alias("capture"))


@R.add("SELECT row_id, doc_id FROM (SELECT (row_number() OVER (ORDER BY n_chars DESC, doc_id) - 1)::bigint AS row_id, doc_id FROM documents)")
def tk8_row_ids(t):
    return W.ranked(t("documents").select("doc_id", "n_chars"), "n_chars", ["doc_id"]).select((F.col("rank_no") - 1).alias("row_id"), "doc_id")


@R.add("SELECT 'incident' AS src, incident_id AS id, title, NULL AS comments FROM incident_view UNION ALL SELECT 'audit', audit_id, title, comments FROM audit_view")
def so1_union(t):
    a = t("incident_view").select(F.lit("incident").alias("src"), F.col("incident_id").alias("id"), "title")
    return a.unionByName(t("audit_view").select(F.lit("audit").alias("src"), F.col("audit_id").alias("id"), "title", "comments"), allowMissingColumns=True)


@R.add("SELECT subject_code, len(list_intersect(keywords, ['crane', 'ladder', 'cable', 'drum']))::int AS shared, array_to_string(keywords[1:2], ', ') AS first_two FROM subject_areas")
def so4_intersection(t):
    return t("subject_areas").select("subject_code", F.size(F.array_intersect("keywords", F.array(*map(F.lit, ("crane", "ladder", "cable", "drum"))))).alias("shared"), F.array_join(F.slice("keywords", 1, 2), ", ").alias("first_two"))


@R.add("SELECT period, count(*) AS n FROM (SELECT unnest([strftime(event_date, '%Y'), strftime(event_date, '%Y') || 'Q' || quarter(event_date), strftime(event_date, '%Y-%m'), isoyear(event_date) || '-W' || lpad(week(event_date)::varchar, 2, '0')]) AS period FROM unified_event WHERE event_date IS NOT NULL) GROUP BY 1")
def dt3_periods(t):
    return t("unified_event").where("event_date is not null").select(F.explode(F.array(*[T.period(F.col("event_date"), f) for f in "YQMW"])).alias("period")).groupBy("period").agg(F.count(F.lit(1)).alias("n"))


@R.add(f"SELECT task_id, floor(epoch(completion_date - assigned_date) / 86400)::bigint AS days FROM {_TASKS} WHERE completion_date IS NOT NULL AND assigned_date IS NOT NULL")
def dt4_day_difference(t):
    return tasks(t).where("completion_date is not null and assigned_date is not null").select("task_id", T.day_difference(F.col("completion_date"), F.col("assigned_date")).alias("days"))


_KEY = "(('0x' || md5({0}::varchar || ':7')[1:15])::bigint)"


@R.add(f"SELECT doc_id FROM documents ORDER BY {_KEY.format('doc_id')}, doc_id LIMIT 100")
def sm1_uniform(t):
    return sampling.uniform(t("documents").select("doc_id"), "doc_id", 100)


@R.add(f"SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY {_KEY.format('doc_id')}, doc_id) AS r, count(*) OVER (PARTITION BY source) AS n FROM documents) WHERE r <= greatest(ceil(n * 0.1), 1)")
def sm2_stratified(t):
    return sampling.stratified(t("documents").select("source", "doc_id"), "source", "doc_id", 0.1).select("source", "doc_id")


@R.add(f"SELECT doc_id FROM documents WHERE n_chars > 0 ORDER BY -ln(({_KEY.format('doc_id')} + 1) / {float(2**60 + 1)}) / n_chars, doc_id LIMIT 100")
def sm3_weighted(t):
    return sampling.weighted(t("documents").select("doc_id", "n_chars"), "n_chars", "doc_id", 100).select("doc_id")


@R.add("SELECT part, count(*) AS n FROM (SELECT CASE WHEN u < 0.8 THEN 'train' WHEN u < 0.9 THEN 'val' ELSE 'test' END AS part FROM (SELECT " + _KEY.format("doc_id") + f" / {float(2**60)} AS u FROM documents)) GROUP BY 1")
def sm11_ratio_split(t):
    return sampling.split(t("documents").select("doc_id"), "doc_id", [("train", 0.8), ("val", 0.1), ("test", 0.1)]).groupBy("part").agg(F.count(F.lit(1)).alias("n"))


@R.add("SELECT part, count(*) AS n FROM (SELECT CASE WHEN epoch_us(o_orderdate) > (SELECT quantile_cont(epoch_us(o_orderdate), 0.8) FROM orders) THEN 'test' ELSE 'train' END AS part FROM orders) GROUP BY 1")
def sm9_newest_fraction(t):
    return sampling.newest(t("orders").select("o_orderkey", "o_orderdate"), "o_orderdate", 0.2).groupBy("part").agg(F.count(F.lit(1)).alias("n"))


@R.add(f"SELECT CASE WHEN month >= (SELECT min(month) FROM (SELECT DISTINCT month FROM {_CL} ORDER BY month DESC LIMIT 6)) THEN 'test' ELSE 'train' END AS part, count(*) AS n FROM {_CL} GROUP BY 1")
def sm10_last_months(t):
    return sampling.last_periods(clustered(t), "month", 6).groupBy("part").agg(F.count(F.lit(1)).alias("n"))


QUERIES, SQL = R.queries, R.sql
