"""Queries of the general data problems over the source tables: references, timestamps, rolling totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwerk.functions.scalars import id_number, norm_id, truthy
from tarnwerk.operators import references, rolling, timestamps
from tarnwerk.operators.joins import first_delivery, lookup_join
from tarnwerk.operators.lineage import cut
from tarnwerk.plans import timestamps_sql as Q
from tarnwerk.sources.tables import table

FIRST_DAY, LAST_DAY = "2021-01-01", "2025-06-30"


def orphans(spark: SparkSession, d: str) -> DataFrame:
    injuries = references.children("incidentinjury_view", table(spark, d, "incidentinjury_view"), "injury_id", {"incident_id": "incident_view"})
    tasks = references.children("task_view", table(spark, d, "task_view"), "task_id", {"location_id": "location_view", "task_status_id": "listitem_view"})
    parents = [
        references.Parent("incident_view", table(spark, d, "incident_view"), "incident_id", "deleted_at"),
        references.Parent("location_view", table(spark, d, "location_view"), "location_id", "deleted_at"),
        references.Parent("listitem_view", table(spark, d, "listitem_view"), "list_item_id", "deleted_at"),
    ]
    return references.find_orphans(injuries.unionByName(tasks), parents)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return orphans(spark, d).select("table_name", "record_id", "field_name", "orphan_kind", "load_month")


def p2_counts(spark: SparkSession, d: str) -> DataFrame:
    return references.count_orphans(orphans(spark, d))


def places(spark: SparkSession, d: str) -> DataFrame:
    """(place, time_zone, locale_code): of each location its first row."""
    one = first_delivery(table(spark, d, "location_view"), "location_id", ["time_zone", "locale_code"])
    return one.select(norm_id(F.col("location_id")).alias("place"), F.lower(F.trim("time_zone")).alias("time_zone"), F.trim("locale_code").alias("locale_code"))


def dated_values(spark: SparkSession, d: str) -> DataFrame:
    """One row per date text of incidents and tasks with the zone and locale of its place."""
    inc = first_delivery(table(spark, d, "incident_view"), "incident_id", ["incident_date", "report_date", "location_id"])
    inc = inc.select(
        F.lit("incident_view").alias("table_name"), F.col("incident_id").alias("record_id"), norm_id(F.col("location_id")).alias("place"),
        F.explode(F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(c).alias("text")) for c in ("incident_date", "report_date")])).alias("v"),
    )
    task = first_delivery(table(spark, d, "task_view"), "task_id", ["due_date", "location_id"])
    task = task.select(F.lit("task_view").alias("table_name"), F.col("task_id").alias("record_id"), norm_id(F.col("location_id")).alias("place"), F.struct(F.lit("due_date").alias("field_name"), F.col("due_date").alias("text")).alias("v"))
    rows = inc.unionByName(task).select("table_name", "record_id", "place", "v.*").where(F.trim("text") != "")
    return lookup_join(rows, places(spark, d), "place")


def intervals(spark: SparkSession, d: str, fields: dict[str, tuple[str, ...]]) -> DataFrame:
    """The offset intervals of the zones of all places and of all zones named in the date columns of tables."""
    texts = None
    for name, columns in fields.items():
        one = table(spark, d, name).select(F.explode(F.array(*columns)).alias("text"))
        texts = one if texts is None else texts.unionByName(one)
    return timestamps.offset_intervals(spark, timestamps.zones_used(texts, "text", places(spark, d), "time_zone"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    spans = intervals(spark, d, {"incident_view": ("incident_date", "report_date"), "task_view": ("due_date",)})
    out = timestamps.normalise(dated_values(spark, d), "text", "time_zone", "locale_code", spans)
    return out.select("table_name", "record_id", "field_name", F.when(F.col("status") == "ok", timestamps.utc_text(F.col("utc_s"), F.col("us"))).otherwise(F.col("status")).alias("utc_text"))


def p4_status(spark: SparkSession, d: str) -> DataFrame:
    """Values per field and outcome."""
    return p4_found(spark, d).groupBy("table_name", "field_name", F.when(F.col("utc_text").endswith("Z"), "ok").otherwise(F.col("utc_text")).alias("status")).agg(F.count(F.lit(1)).alias("n"))


def incident_days(spark: SparkSession, d: str) -> DataFrame:
    """(place, day, arrived, incidents, lost_time): one row per incident that has a calendar day at a known location.

    The day is that of the location's own clock: a written zone is converted, all else is taken as written, as are
    skipped and ambiguous times.
    """
    inc = first_delivery(table(spark, d, "incident_view"), "incident_id", ["incident_date", "location_id"])
    inc = inc.select("incident_id", F.col("incident_date").alias("text"), norm_id(F.col("location_id")).alias("place"), F.col("loaded_at").alias("arrived")).where(F.trim("text") != "")
    known = lookup_join(inc, places(spark, d), "place", "inner")
    spans = intervals(spark, d, {"incident_view": ("incident_date",)})
    out = timestamps.normalise(known, "text", "time_zone", "locale_code", spans).where(F.col("status") != "invalid")
    look = F.broadcast(spans.select(F.col("zone_key").alias("time_zone"), F.col("year").alias("_y"), F.col("spans").alias("_s")))
    out = out.withColumn("_y", timestamps.span_year(F.col("utc_s"))).join(look, ["time_zone", "_y"], "left")
    off = F.get(F.filter("_s", lambda x: (x["lo"] <= F.col("utc_s")) & (F.col("utc_s") < x["hi"])), F.lit(0))["off"]
    clock = F.when(F.col("written_zone"), F.coalesce(F.col("utc_s") + off, F.col("local_s"))).otherwise(F.col("local_s"))
    out = out.select("incident_id", "place", "arrived", F.date_from_unix_date(F.floor(clock / 86400).cast("int")).alias("day"))
    inj = first_delivery(table(spark, d, "incidentinjury_view"), "injury_id", ["incident_id", "lost_time"])
    lost = inj.where(truthy(F.col("lost_time"))).groupBy(id_number(F.col("incident_id")).alias("incident_id")).agg(F.count(F.lit(1)).alias("lost_time"))
    out = out.join(lost, "incident_id", "left")
    return out.select(F.col("place").cast("bigint").alias("location_id"), "day", "arrived", F.lit(1).cast("bigint").alias("incidents"), F.coalesce("lost_time", F.lit(0)).alias("lost_time"))


MEASURES, WINDOWS = ("incidents", "lost_time"), (7, 30)


#: An incident that is delivered later than so many days after its day is a correction of the state.
LAG_DAYS = 14


def rolling_versions(spark: SparkSession, d: str, lag_days: int = LAG_DAYS) -> DataFrame:
    """The daily state as versions: 0 kept day by day from incidents that arrive within ``lag_days``, 1 the days that
    later ones correct."""
    rows = incident_days(spark, d)
    late = F.col("arrived").isNull() | (F.datediff("arrived", "day") > lag_days)
    daily = cut(rows.groupBy("location_id", "day", late.alias("late")).agg(*[F.sum(m).alias(m) for m in MEASURES]))
    first = rolling.maintain(daily.where(~F.col("late")).drop("late"), "location_id", "day", MEASURES, WINDOWS, FIRST_DAY, LAST_DAY)
    fixed = rolling.correct(first, daily.where("late"), "location_id", "day", MEASURES, WINDOWS, FIRST_DAY, LAST_DAY, version=1)
    return first.unionByName(fixed)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    out = rolling.latest(rolling_versions(spark, d), "location_id", "day")
    return out.select("location_id", F.col("day").cast("string").alias("day_text"), "incidents_7d", "incidents_30d", "lost_time_7d", "lost_time_30d")


def p7_averages(spark: SparkSession, d: str) -> DataFrame:
    """Totals and daily averages of every location and day, quiet days included."""
    every = table(spark, d, "location_view").where(F.col("location_id").isNotNull()).select("location_id").distinct()
    state = rolling.latest(rolling_versions(spark, d), "location_id", "day").drop("version")
    return rolling.with_averages(rolling.with_quiet_days(state, every, "location_id", "day", MEASURES, WINDOWS, FIRST_DAY, LAST_DAY), MEASURES, WINDOWS)


def p7_versions(spark: SparkSession, d: str) -> DataFrame:
    """All versions of the state, with the days they hold."""
    return rolling_versions(spark, d)


def p7_events(spark: SparkSession, d: str) -> DataFrame:
    """The same operator over the event stream table: trailing 7 and 30 days of each user."""
    rows = table(spark, d, "events").select("user_id", F.to_date("ts").alias("day"), F.lit(1).cast("bigint").alias("events"))
    daily = rolling.daily_amounts(rows, "user_id", "day", ["events"])
    return rolling.rolling_state(daily, "user_id", "day", ["events"], WINDOWS, "2000-01-01", "2100-01-01")


QUERIES = {"p2_found": p2_found, "p2_counts": p2_counts, "p4_found": p4_found, "p4_status": p4_status, "p7_found": p7_found, "p7_averages": p7_averages, "p7_versions": p7_versions, "p7_events": p7_events}

_NID = "nullif(case when lower(regexp_replace(trim({0}), '^([+-]?[0-9]+)\\.0*$', '\\1')) = 'nan' then '' else regexp_replace(trim({0}), '^([+-]?[0-9]+)\\.0*$', '\\1') end, '')"
_ORPHANS = f"""
WITH child AS (
  SELECT 'incidentinjury_view' AS table_name, record_id, 'incident_id' AS field_name, 'incident_view' AS parent, {_NID.format("r.incident_id")} AS key, r.loaded_at AS arrived
    FROM (SELECT injury_id AS record_id, arg_min(i, loaded_at) AS r FROM incidentinjury_view i WHERE injury_id IS NOT NULL GROUP BY injury_id)
  UNION ALL SELECT 'task_view', record_id, 'location_id', 'location_view', {_NID.format("r.location_id")}, r.loaded_at
    FROM (SELECT task_id AS record_id, arg_min(t, loaded_at) AS r FROM task_view t WHERE task_id IS NOT NULL GROUP BY task_id)
  UNION ALL SELECT 'task_view', record_id, 'task_status_id', 'listitem_view', {_NID.format("r.task_status_id")}, r.loaded_at
    FROM (SELECT task_id AS record_id, arg_min(t, loaded_at) AS r FROM task_view t WHERE task_id IS NOT NULL GROUP BY task_id)
), parent AS (
  SELECT parent, key, min(first_in) AS first_in, CASE WHEN count(*) = count(gone) THEN max(gone) END AS gone FROM (
    SELECT 'incident_view' AS parent, incident_id::varchar AS key, loaded_at AS first_in, deleted_at AS gone FROM incident_view
    UNION ALL SELECT 'location_view', location_id::varchar, loaded_at, deleted_at FROM location_view
    UNION ALL SELECT 'listitem_view', list_item_id::varchar, loaded_at, deleted_at FROM listitem_view)
  WHERE key IS NOT NULL GROUP BY ALL
), orphan AS (
  SELECT table_name, record_id, field_name, CASE WHEN p.key IS NULL THEN 'missing' WHEN first_in > arrived THEN 'late' WHEN gone <= arrived THEN 'deleted' END AS orphan_kind, strftime(arrived, '%Y-%m') AS load_month
    FROM child c LEFT JOIN parent p ON c.parent = p.parent AND c.key = p.key WHERE c.key IS NOT NULL
)
"""
_COLS = [f"{n}_{k}d" for n in ("incidents", "lost_time") for k in (7, 30)]
SQL = {
    "p4_found": Q.P4 + "SELECT * FROM p4",
    "p4_status": Q.P4 + "SELECT table_name, field_name, CASE WHEN utc_text LIKE '%Z' THEN 'ok' ELSE utc_text END AS status, count(*) AS n FROM p4 GROUP BY ALL",
    "p7_found": Q.P7 + Q.totals("inc", "tot") + f" SELECT location_id, strftime(day, '%Y-%m-%d') AS day_text, {', '.join(_COLS)} FROM tot",
    "p7_averages": Q.P7 + Q.totals("inc", "tot") + f", cal AS (SELECT location_id, unnest(generate_series(DATE '2021-01-01', DATE '2025-06-30', INTERVAL 1 DAY))::date AS day FROM (SELECT DISTINCT location_id FROM location_view WHERE location_id IS NOT NULL)) SELECT location_id, day, " + ", ".join(f"coalesce({c}, 0) AS {c}, coalesce({c}, 0) / {c.split('_')[-1][:-1]}.0::double AS {c}_avg" for c in _COLS) + " FROM cal LEFT JOIN tot USING (location_id, day)",
    "p7_versions": Q.P7 + "late AS (SELECT * FROM inc WHERE arrived IS NULL OR arrived::date - day > 14), soon AS (SELECT * FROM inc WHERE NOT (arrived IS NULL OR arrived::date - day > 14)), " + Q.totals("soon", "v0") + ", " + Q.totals("late", "v1") + f" SELECT location_id, day, {', '.join(_COLS)}, 0 AS version FROM v0 UNION ALL SELECT v1.location_id, v1.day, " + ", ".join(f"v1.{c} + coalesce(v0.{c}, 0)" for c in _COLS) + ", 1 FROM v1 LEFT JOIN v0 USING (location_id, day)",
    "p2_found": _ORPHANS + "SELECT * FROM orphan WHERE orphan_kind IS NOT NULL",
    "p2_counts": _ORPHANS + "SELECT table_name, field_name, orphan_kind, load_month, count(*) AS orphans FROM orphan WHERE orphan_kind IS NOT NULL GROUP BY ALL",
    "p7_events": """
WITH daily AS (SELECT user_id, ts::date AS day, count(*) AS n FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL GROUP BY ALL),
days AS (SELECT DISTINCT user_id, day + k::int AS day FROM daily, range(30) r(k))
SELECT d.user_id, d.day, coalesce(sum(n) FILTER (a.day > d.day - 7), 0)::bigint AS events_7d, sum(n)::bigint AS events_30d
FROM days d JOIN daily a ON a.user_id = d.user_id AND a.day <= d.day AND a.day > d.day - 30 GROUP BY ALL""",
}
