"""The unified event table from the raw views, its cleaning and its derived frames: composed operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwerk.functions import text as T
from tarnwerk.functions.scalars import id_number, truthy, word_count
from tarnwerk.operators import hierarchy
from tarnwerk.operators.joins import first_delivery, lookup_join
from tarnwerk.plans._register import Register
from tarnwerk.plans.records import _CLEANED, _TREE

R = Register()


def decoded(df: DataFrame, codes: DataFrame, column: str, out: str) -> DataFrame:
    """Adds the label of a code column; an unknown code keeps its number as text."""
    dim = codes.select(F.col("list_item_id").alias(column), F.col("item").alias("_label"))
    return lookup_join(df, dim, column).withColumn(out, F.coalesce("_label", F.col(column).cast("string"), F.lit(""))).drop("_label")


def first_match(rules: list[tuple[str, Column]], otherwise: str) -> Column:
    """The name of the first rule that holds, in order; null conditions do not hold."""
    out = F.lit(otherwise)
    for name, cond in reversed(rules):
        out = F.when(cond, name).otherwise(out)
    return out


def any_pattern(c: Column, patterns: list[str]) -> Column:
    """Whether any of the patterns is found, in any letter case: one union expression, one pass."""
    return F.coalesce(c.rlike("(?i)(?:" + ")|(?:".join(patterns) + ")"), F.lit(False))


def reject(df: DataFrame, text: str, key: str, least_words: int = 3) -> DataFrame:
    """Adds reject_reason: missing_text, text_too_short, duplicate_record_id (all but the first by loaded order of the
    text), or null for rows that are kept."""
    from pyspark.sql import Window

    x = T.clean(F.col(text))
    n = F.row_number().over(Window.partitionBy(key).orderBy(F.col(text).asc_nulls_last()))
    return df.withColumns({"_n": n}).withColumn("reject_reason", F.when(x == "", "missing_text").when(word_count(x) < least_words, "text_too_short").when(F.col("_n") > 1, "duplicate_record_id")).drop("_n")


def build_events(t) -> DataFrame:
    """incident, audit and task rows as one event table in the fixed schema: decode, locate, clean, union by name."""
    codes = t("listitem_view").where("list_item_id is not null").groupBy("list_item_id").agg(F.min("item").alias("item"))
    places = hierarchy.levels(hierarchy.ancestor_paths(t("location_view"), "location_id", "parent_location_id", "location_name")).select(F.col("node").alias("location_id"), "site", "department", F.col("name_path").alias("location_path"))
    inj = first_delivery(t("incidentinjury_view"), "injury_id", ["incident_id", "lost_time", "fatality", "inpatient"]).where(id_number(F.col("incident_id")).isNotNull())
    inj = inj.groupBy(id_number(F.col("incident_id")).alias("source_id")).agg(F.count(F.lit(1)).cast("int").alias("injury_record_count"), F.bool_or(truthy(F.col("lost_time"))).alias("losttime"), F.bool_or(truthy(F.col("fatality"))).alias("fatality"), F.bool_or(truthy(F.col("inpatient"))).alias("inpatient"))
    i = first_delivery(t("incident_view"), "incident_id", ["incident_category_id", "incident_status_id", "location_id", "title", "description"])
    i = i.select(F.lit("incident").alias("source_type"), F.col("incident_id").alias("source_id"), F.col("incident_category_id").alias("raw_category_id"), F.col("incident_status_id").alias("raw_status_id"), id_number(F.col("location_id")).alias("location_id"), "title", "description")
    i = i.join(inj, "source_id", "left").withColumn("any_injury", F.col("injury_record_count") > 0)
    a = first_delivery(t("audit_view"), "audit_id", ["audit_category_id", "audit_status_id", "audit_type_id", "scheduled_location_id", "title", "description", "actual_start", "scheduled_start"])
    a = a.select(F.lit("audit").alias("source_type"), F.col("audit_id").alias("source_id"), F.col("audit_category_id").alias("raw_category_id"), F.col("audit_status_id").alias("raw_status_id"), F.col("audit_type_id").alias("raw_type_id"), F.col("scheduled_location_id").alias("location_id"), "title", "description", F.coalesce("actual_start", "scheduled_start").alias("event_date"))
    k = first_delivery(t("task_view"), "task_id", ["task_category_id", "task_status_id", "location_id", "task", "description", "assigned_date", "completion_date"])
    k = k.select(F.lit("task").alias("source_type"), F.col("task_id").alias("source_id"), F.col("task_category_id").alias("raw_category_id"), id_number(F.col("task_status_id")).alias("raw_status_id"), id_number(F.col("location_id")).alias("location_id"), F.col("task").alias("title"), "description", F.col("assigned_date").alias("event_date"), "completion_date")
    k = k.withColumn("is_open_task", F.col("completion_date").isNull())
    e = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), (i, a, k))
    e = decoded(decoded(e, codes, "raw_category_id", "category"), codes, "raw_status_id", "status")
    e = lookup_join(e, places, "location_id")
    clean = T.first_text("description", "title")
    e = e.withColumns({"event_id": F.concat_ws("_", "source_type", F.col("source_id").cast("string")), "clean_text": clean})
    e = e.withColumns({"has_text": F.col("clean_text") != "", "text_length": F.length("clean_text"), "site": F.coalesce("site", F.lit("Unknown")), "department": F.coalesce("department", F.lit("Unknown"))})
    return T.with_defaults(e)


@R.add("SELECT 'incident' AS source_type, count(DISTINCT incident_id) AS n FROM incident_view UNION ALL SELECT 'audit', count(DISTINCT audit_id) FROM audit_view UNION ALL SELECT 'task', count(DISTINCT task_id) FROM task_view")
def cp1_unified_counts(t):
    return build_events(t).groupBy("source_type").agg(F.count(F.lit(1)).alias("n"))


_ID = "try_cast(regexp_replace(trim({0}), '\\.0*$', '') AS BIGINT)"
_YES = "coalesce(lower(trim({0})) IN ('true','1','yes','y','t','x'), false)"
_ONE = "(SELECT {0}, arg_min(x, loaded_at) AS r FROM {1} x WHERE {0} IS NOT NULL GROUP BY 1)"
_UNIFIED = (
    _TREE
    + f""", code AS (SELECT list_item_id, min(item) AS item FROM listitem_view WHERE list_item_id IS NOT NULL GROUP BY 1),
place AS (SELECT node, name_path AS location_path, concat_ws(' / ', s[1], s[2]) AS site, coalesce(s[5], 'Unknown') AS department FROM (SELECT node, name_path, string_split(name_path, ' > ') AS s FROM paths)),
inj AS (SELECT {_ID.format("r.incident_id")} AS source_id, count(*)::int AS n, bool_or({_YES.format("r.lost_time")}) AS lost, bool_or({_YES.format("r.fatality")}) AS fatal, bool_or({_YES.format("r.inpatient")}) AS inp FROM {_ONE.format("injury_id", "incidentinjury_view")} GROUP BY 1 HAVING {_ID.format("r.incident_id")} IS NOT NULL),
ev AS (
  SELECT 'incident' AS source_type, incident_id AS source_id, r.incident_category_id AS raw_category_id, r.incident_status_id AS raw_status_id, NULL::bigint AS raw_type_id, {_ID.format("r.location_id")} AS location_id, r.title AS title, r.description AS description, NULL::timestamp AS event_date, NULL::timestamp AS completion_date, false AS is_open_task FROM {_ONE.format("incident_id", "incident_view")}
  UNION ALL SELECT 'audit', audit_id, r.audit_category_id, r.audit_status_id, r.audit_type_id, r.scheduled_location_id, r.title, r.description, coalesce(r.actual_start, r.scheduled_start), NULL, false FROM {_ONE.format("audit_id", "audit_view")}
  UNION ALL SELECT 'task', task_id, r.task_category_id, {_ID.format("r.task_status_id")}, NULL, {_ID.format("r.location_id")}, r.task, r.description, r.assigned_date, r.completion_date, r.completion_date IS NULL FROM {_ONE.format("task_id", "task_view")}
), txt AS (SELECT ev.*, source_type || '_' || ev.source_id AS event_id, coalesce(nullif({_CLEANED.format("description")}, ''), nullif({_CLEANED.format("title")}, ''), '') AS clean_text FROM ev)
SELECT event_id, e.source_type, '' AS source_subtype, coalesce(p.site, 'Unknown') AS site, coalesce(p.department, 'Unknown') AS department, coalesce(p.location_path, '') AS location_path, coalesce(title, '') AS title, coalesce(description, '') AS description, clean_text,
  coalesce(st.item, raw_status_id::varchar, '') AS status, coalesce(ct.item, raw_category_id::varchar, '') AS category, '' AS audit_type, '' AS task_source_module, '' AS detected_language, '' AS language_detection_status,
  e.source_id, location_id, raw_status_id, raw_category_id, raw_type_id, NULL::bigint AS raw_source_type_id, event_date, NULL::timestamp AS due_date, completion_date, is_open_task, false AS is_overdue_task, coalesce(i.n, 0) > 0 AS any_injury, false AS severe_actual,
  coalesce(i.fatal, false) AS fatality, coalesce(i.lost, false) AS losttime, false AS restrictedtime, coalesce(i.inp, false) AS inpatient, false AS emergencyroom, clean_text <> '' AS has_text, NULL::boolean AS is_english_text, coalesce(i.n, 0) AS injury_record_count, length(clean_text)::int AS text_length, NULL::double AS detected_language_score
FROM txt e LEFT JOIN inj i ON e.source_type = 'incident' AND i.source_id = e.source_id LEFT JOIN code ct ON ct.list_item_id = raw_category_id LEFT JOIN code st ON st.list_item_id = raw_status_id LEFT JOIN place p ON p.node = location_id"""
)


@R.add(_UNIFIED)
def cp1_unified_events(t):
    """The whole unified event table."""
    return build_events(t)


@R.add("SELECT reason, count(*) AS n FROM (SELECT CASE WHEN x = '' OR lower(x) IN ('nan','none','null','nat') THEN 'missing_text' WHEN len(string_split(x, ' ')) < 3 THEN 'text_too_short' WHEN r > 1 THEN 'duplicate_record_id' ELSE 'kept' END AS reason FROM (SELECT trim(regexp_replace(regexp_replace(regexp_replace(coalesce(description, ''), '<[^>]{1,200}>', ' ', 'g'), '&nbsp;', ' ', 'g'), '\\s+', ' ', 'g')) AS x, row_number() OVER (PARTITION BY incident_id ORDER BY description) AS r FROM incident_view)) GROUP BY 1")
def fl7_reject_reasons(t):
    return reject(t("incident_view").select("incident_id", "description"), "description", "incident_id").groupBy(F.coalesce("reject_reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@R.add("SELECT doc_id, regexp_matches(lower(text), '(crane|hoist|sling)|(ladder|scaffold)') AS hit FROM documents")
def fl9_any_pattern(t):
    return t("documents").select("doc_id", any_pattern(F.col("text"), ["crane|hoist|sling", "ladder|scaffold"]).alias("hit"))


@R.add("SELECT kind, count(*) AS n FROM (SELECT CASE WHEN lower(source_type) LIKE '%task%' THEN 'task' WHEN lower(source_type) LIKE '%audit%' THEN 'audit' WHEN any_injury THEN 'injury' WHEN lower(source_type) LIKE '%near%' THEN 'near_miss' ELSE 'other' END AS kind FROM unified_event) GROUP BY 1")
def fl12_first_match(t):
    s = F.lower("source_type")
    rules = [("task", s.contains("task")), ("audit", s.contains("audit")), ("injury", F.col("any_injury")), ("near_miss", s.contains("near"))]
    return t("unified_event").select(first_match(rules, "other").alias("kind")).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@R.add("SELECT event_id, text_length FROM unified_event WHERE event_date >= TIMESTAMP '2023-01-01' AND event_date < TIMESTAMP '2024-01-01' AND text_length >= 40")
def fl3_range_and_quality(t):
    """A date range, its end day included, and a least text length: both reach the scan."""
    e = t("unified_event").where((F.col("event_date") >= F.lit("2023-01-01").cast("timestamp_ntz")) & (F.col("event_date") < F.lit("2024-01-01").cast("timestamp_ntz")) & (F.col("text_length") >= 40))
    return e.select("event_id", "text_length")


@R.add("SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, count(*) AS records, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def ss1_windowed_counts(t):
    """The streaming aggregate over the batch table."""
    from tarnwerk.streaming.facts import windowed_counts

    out = windowed_counts(t("events"), "ts", ["user_id"], "1 day", measures={"total": F.col("value")})
    return out.select("user_id", F.date_format("window_start", "yyyy-MM-dd").alias("day"), "records", F.round("total", 4).alias("total"))


@R.add("SELECT user_id, session, count(*) AS events FROM (SELECT user_id, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING)::bigint AS session FROM (SELECT user_id, ts, (lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL 12 HOUR)::int AS fresh FROM events)) GROUP BY ALL")
def ss2_sessions(t):
    from pyspark.sql import Window

    from tarnwerk.streaming.facts import sessions

    s = sessions(t("events"), "ts", "user_id", "12 hours")
    return s.select("user_id", F.row_number().over(Window.partitionBy("user_id").orderBy("session_start")).cast("bigint").alias("session"), "events")


QUERIES, SQL = R.queries, R.sql
