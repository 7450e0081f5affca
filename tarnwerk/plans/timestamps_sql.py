"""The SQL of problems 4 and 7: dates of mixed form read by regular expressions and the database's own time zones.

It shares no code with the operators: offsets come from the engine's tz library, and a local time is tried with the
offsets in force a day before and a day after it.
"""

from __future__ import annotations

from tarnwerk.operators.timestamps import MONTHS

_NAMED = "CASE " + " ".join(f"WHEN lower({{0}}) IN ({', '.join(repr(n) for n in names)}) THEN {k}" for k, names in enumerate(MONTHS, 1)) + " END"
_NID = "nullif(CASE WHEN lower(regexp_replace(trim({0}), '^([+-]?[0-9]+)\\.0*$', '\\1')) = 'nan' THEN '' ELSE regexp_replace(trim({0}), '^([+-]?[0-9]+)\\.0*$', '\\1') END, '')"
_Y = "^(\\d{4})([-/.])(\\d{1,2})([-/.])(\\d{1,2})(?:(?:\\s*,\\s*|[Tt\\s]+)(.*)|(Z|[+-]\\d.*)|)$"
_C = "^(\\d{4})(\\d{2})(\\d{2})(?:[Tt ]?(\\d{2})(\\d{2})(?:(\\d{2})(?:[.,](\\d{1,9}))?)?\\s*(.*))?$"
_N = "^(\\d{1,2})([-/.])(\\d{1,2})([-/.])(\\d{4}|\\d{2})(?:(?:\\s*,\\s*|[Tt\\s]+)(.*)|)$"
_D = "^(?:\\p{L}{2,10}\\.?,\\s*)?(\\d{1,2})(?:\\.|st|nd|rd|th|º|er)?[\\s-]+(?:de\\s+)?([\\p{L}]{3,12})\\.?,?[\\s-]+(?:de\\s+)?(\\d{4}|\\d{2})(?:(?:\\s*,\\s*|[Tt\\s]+)(.*)|)$"
_M = "^(?:\\p{L}{2,10}\\.?,\\s*)?([\\p{L}]{3,12})\\.?\\s+(\\d{1,2})(?:st|nd|rd|th)?,?\\s+(\\d{4}|\\d{2})(?:(?:\\s*,\\s*|[Tt\\s]+)(.*)|)$"
_T1 = "^(?:(?:um|at|à|a las|às)\\s+)?(\\d{1,2})[:h.](\\d{2})(?:[:.](\\d{2})(?:[.,](\\d{1,9}))?)?\\s*(.*)$"
_T2 = "^(?:(?:um|at|à|a las|às)\\s+)?(\\d{1,2})\\s?([AaPp]\\.?[Mm].*)$"
_HALF = "^([AaPp])\\.?[Mm]\\.?(?:[^A-Za-z/].*)?$"
_OFF = "^(?:UTC|GMT)?([+-])(\\d{1,2})(?::?(\\d{2}))?(?::?(\\d{2}))?(?:\\s*[\\[(].*[\\])])?$"
_ZONE = "^[\\[(]?([A-Za-z]+(?:/[A-Za-z0-9_+-]+)+)[\\])]?$"
_INT = "try_cast(nullif({0}, '') AS BIGINT)"


def _x(pattern: str, k: int, of: str = "t") -> str:
    return f"regexp_extract({of}, '{pattern}', {k})"


def _off(zone: str, at: str) -> str:
    return f"(epoch(timezone({zone}, to_timestamp({at}))) - ({at}))"


#: Rows of ``val`` (table_name, record_id, field_name, text, place) to ``fin`` with status, local_s, utc_s, us, written, tz.
READ = f"""
loc AS (SELECT location_id::varchar AS place, lower(trim(r.time_zone)) AS tz, trim(r.locale_code) AS locale FROM (SELECT location_id, arg_min(l, loaded_at) AS r FROM location_view l WHERE location_id IS NOT NULL GROUP BY 1)),
tzs AS (SELECT lower(name) AS zone_key, min(name) AS zone FROM pg_timezone_names() WHERE contains(name, '/') OR name IN ('UTC', 'GMT') GROUP BY 1),
a AS (SELECT v.*, loc.place IS NOT NULL AS placed, loc.tz, loc.locale, trim(regexp_replace(text, '[\\s\\x{{A0}}]+', ' ', 'g')) AS t, CASE WHEN loc.tz IS NOT NULL OR loc.locale IS NOT NULL THEN coalesce(loc.locale, '') = 'en-US' END AS mf FROM val v LEFT JOIN loc USING (place) WHERE trim(text) <> ''),
f AS (SELECT *, CASE WHEN regexp_matches(t, '^(?:\\d{{9,10}}|\\d{{12,13}})$') THEN 'e' WHEN regexp_matches(t, '{_Y}') AND {_x(_Y, 2)} = {_x(_Y, 4)} THEN 'y' WHEN regexp_matches(t, '{_C}') THEN 'c' WHEN regexp_matches(t, '{_N}') AND {_x(_N, 2)} = {_x(_N, 4)} THEN 'n' WHEN regexp_matches(t, '{_D}') THEN 'd' WHEN regexp_matches(t, '{_M}') THEN 'm' END AS f FROM a),
p AS (SELECT *,
  CASE f WHEN 'y' THEN {_x(_Y, 1)} WHEN 'c' THEN {_x(_C, 1)} WHEN 'n' THEN {_x(_N, 5)} WHEN 'd' THEN {_x(_D, 3)} WHEN 'm' THEN {_x(_M, 3)} END AS ys,
  CASE f WHEN 'y' THEN {_INT.format(_x(_Y, 3))} WHEN 'c' THEN {_INT.format(_x(_C, 2))} WHEN 'n' THEN {_INT.format(_x(_N, 1))} WHEN 'd' THEN {_NAMED.format(_x(_D, 2))} WHEN 'm' THEN {_NAMED.format(_x(_M, 1))} END AS one,
  CASE f WHEN 'y' THEN {_INT.format(_x(_Y, 5))} WHEN 'c' THEN {_INT.format(_x(_C, 3))} WHEN 'n' THEN {_INT.format(_x(_N, 3))} WHEN 'd' THEN {_INT.format(_x(_D, 1))} WHEN 'm' THEN {_INT.format(_x(_M, 2))} END AS two,
  trim(CASE f WHEN 'y' THEN {_x(_Y, 6)} || {_x(_Y, 7)} WHEN 'c' THEN CASE WHEN {_x(_C, 4)} = '' THEN '' ELSE {_x(_C, 4)} || ':' || {_x(_C, 5)} || CASE WHEN {_x(_C, 6)} <> '' THEN ':' || {_x(_C, 6)} || CASE WHEN {_x(_C, 7)} <> '' THEN '.' || {_x(_C, 7)} ELSE '' END ELSE '' END || ' ' || {_x(_C, 8)} END WHEN 'n' THEN {_x(_N, 6)} WHEN 'd' THEN {_x(_D, 4)} WHEN 'm' THEN {_x(_M, 4)} ELSE '' END) AS rest FROM f),
q AS (SELECT *, CASE WHEN length(ys) = 2 THEN {_INT.format("ys")} + 2000 ELSE {_INT.format("ys")} END AS yy, f = 'n' AND coalesce(NOT mf, one > 12) AS swap,
  CASE WHEN regexp_matches(rest, '{_T1}') THEN 1 WHEN regexp_matches(rest, '{_T2}') THEN 2 ELSE 0 END AS ck FROM p),
r AS (SELECT *, try_cast(printf('%04d-%02d-%02d', yy, CASE WHEN swap THEN two ELSE one END, CASE WHEN swap THEN one ELSE two END) AS DATE) AS dd,
  CASE ck WHEN 1 THEN {_INT.format(_x(_T1, 1, "rest"))} WHEN 2 THEN {_INT.format(_x(_T2, 1, "rest"))} END AS hh, CASE ck WHEN 1 THEN {_INT.format(_x(_T1, 2, "rest"))} ELSE 0 END AS mi, CASE ck WHEN 1 THEN coalesce({_INT.format(_x(_T1, 3, "rest"))}, 0) ELSE 0 END AS ss,
  CASE ck WHEN 1 THEN {_x(_T1, 4, "rest")} ELSE '' END AS frac, CASE ck WHEN 1 THEN {_x(_T1, 5, "rest")} WHEN 2 THEN {_x(_T2, 2, "rest")} ELSE rest END AS tail FROM q),
s AS (SELECT *, CASE WHEN ck > 0 AND regexp_matches(tail, '{_HALF}') THEN lower({_x(_HALF, 1, "tail")}) ELSE '' END AS half FROM r),
u AS (SELECT *, trim(CASE WHEN half <> '' THEN regexp_replace(tail, '^[AaPp]\\.?[Mm]\\.?\\s*', '') WHEN ck > 0 THEN regexp_replace(tail, '^(?:Uhr|hs?\\b)\\s*', '') ELSE tail END) AS z,
  CASE WHEN ck = 0 THEN 0 WHEN half = '' THEN hh WHEN hh BETWEEN 1 AND 12 THEN hh % 12 + CASE WHEN half = 'p' THEN 12 ELSE 0 END END AS h FROM s),
w AS (SELECT *, CASE WHEN regexp_matches(z, '{_OFF}') THEN CASE WHEN coalesce({_INT.format(_x(_OFF, 2, "z"))}, 0) <= 18 AND coalesce({_INT.format(_x(_OFF, 3, "z"))}, 0) <= 59 THEN (coalesce({_INT.format(_x(_OFF, 2, "z"))}, 0) * 3600 + coalesce({_INT.format(_x(_OFF, 3, "z"))}, 0) * 60 + coalesce({_INT.format(_x(_OFF, 4, "z"))}, 0)) * CASE WHEN {_x(_OFF, 1, "z")} = '-' THEN -1 ELSE 1 END END WHEN f = 'e' OR regexp_matches(z, '^(?i)(?:Z|UTC|Zulu)(?:\\s*\\[.*\\])?$') THEN 0 END AS off, CASE WHEN regexp_matches(z, '{_ZONE}') THEN lower({_x(_ZONE, 1, "z")}) END AS wz FROM u),
l AS (SELECT *, CASE WHEN f = 'e' THEN CASE WHEN length(t) >= 12 THEN t::bigint // 1000 ELSE t::bigint END WHEN h BETWEEN 0 AND 23 AND mi BETWEEN 0 AND 59 AND ss BETWEEN 0 AND 59 AND (off IS NOT NULL OR wz IS NOT NULL OR regexp_matches(z, '^[A-Za-z]{{0,5}}$')) THEN (dd - DATE '1970-01-01') * 86400 + h * 3600 + mi * 60 + ss END AS local_s,
  CASE WHEN f = 'e' AND length(t) >= 12 THEN (t::bigint % 1000) * 1000 WHEN frac = '' THEN 0 ELSE rpad(frac[1:6], 6, '0')::bigint END AS us, coalesce(wz, tz) AS zk FROM w),
k AS (SELECT l.*, tzs.zone, pz.zone AS pzone FROM l LEFT JOIN tzs ON tzs.zone_key = l.zk LEFT JOIN tzs pz ON pz.zone_key = l.tz),
o AS (SELECT *, CASE WHEN off IS NULL THEN {_off("zone", "local_s - 86400")} END AS o1, CASE WHEN off IS NULL THEN {_off("zone", "local_s + 86400")} END AS o2 FROM k),
c AS (SELECT *, coalesce({_off("zone", "local_s - o1")} = o1, false) AS ok1, coalesce({_off("zone", "local_s - o2")} = o2 AND o2 <> o1, false) AS ok2 FROM o),
fin AS (SELECT *, off IS NOT NULL OR wz IS NOT NULL AS written, CASE WHEN local_s IS NULL THEN 'invalid' WHEN off IS NOT NULL THEN 'ok' WHEN zk IS NULL THEN 'zoneless' WHEN zone IS NULL THEN CASE WHEN wz IS NOT NULL THEN 'invalid' ELSE 'zoneless' END WHEN ok1 AND ok2 THEN 'ambiguous' WHEN ok1 OR ok2 THEN 'ok' ELSE 'skipped' END AS status, (local_s - coalesce(off, CASE WHEN ok1 THEN o1 WHEN ok2 THEN o2 END))::bigint AS utc_s FROM c)
"""
_INC = "(SELECT incident_id, arg_min(i, loaded_at) AS r FROM incident_view i WHERE incident_id IS NOT NULL GROUP BY 1)"
_TASK = "(SELECT task_id, arg_min(t, loaded_at) AS r FROM task_view t WHERE task_id IS NOT NULL GROUP BY 1)"
P4 = f"""
WITH val AS (SELECT 'incident_view' AS table_name, incident_id AS record_id, 'incident_date' AS field_name, r.incident_date AS text, {_NID.format("r.location_id")} AS place FROM {_INC}
  UNION ALL SELECT 'incident_view', incident_id, 'report_date', r.report_date, {_NID.format("r.location_id")} FROM {_INC}
  UNION ALL SELECT 'task_view', task_id, 'due_date', r.due_date, {_NID.format("r.location_id")} FROM {_TASK}),
{READ}, p4 AS (SELECT table_name, record_id, field_name, CASE WHEN status = 'ok' THEN strftime(make_timestamp(utc_s * 1000000 + us), '%Y-%m-%dT%H:%M:%S.%f') || 'Z' ELSE status END AS utc_text FROM fin)
"""
_LOST = "(SELECT try_cast(regexp_replace(trim(r.incident_id), '\\.0*$', '') AS BIGINT) AS incident_id, count(*) AS lost FROM (SELECT injury_id, arg_min(j, loaded_at) AS r FROM incidentinjury_view j WHERE injury_id IS NOT NULL GROUP BY 1) WHERE coalesce(lower(trim(r.lost_time)) IN ('true','1','yes','y','t','x'), false) GROUP BY 1)"
#: ``inc``: one row per incident with its place, day on the place's clock, arrival and lost-time injuries.
P7 = f"""
WITH val AS (SELECT incident_id AS record_id, r.incident_date AS text, {_NID.format("r.location_id")} AS place, r.loaded_at AS arrived FROM {_INC}),
{READ}, inc AS (SELECT place::bigint AS location_id, (DATE '1970-01-01' + floor((CASE WHEN written THEN coalesce(utc_s + {_off("pzone", "utc_s")}, local_s) ELSE local_s END) / 86400)::int)::date AS day, arrived, coalesce(lost, 0) AS lost FROM fin LEFT JOIN {_LOST} x ON x.incident_id = record_id WHERE placed AND status <> 'invalid'),
"""


def totals(source: str, name: str) -> str:
    """A table of trailing totals of the incidents in ``source`` for the days that hold any in 30 days."""
    win = ", ".join(f"coalesce(sum({m}) FILTER (b.day > a.day - {k}), 0)::bigint AS {n}_{k}d" for m, n in (("b.n", "incidents"), ("b.lost", "lost_time")) for k in (7, 30))
    daily = f"(SELECT location_id, day, count(*) AS n, sum(lost) AS lost FROM {source} GROUP BY ALL)"
    return f"{name} AS (SELECT a.location_id, a.day, {win} FROM (SELECT DISTINCT location_id, (day + k::int)::date AS day FROM {daily}, range(30) g(k)) a JOIN {daily} b ON b.location_id = a.location_id AND b.day <= a.day AND b.day > a.day - 30 WHERE a.day BETWEEN DATE '2021-01-01' AND DATE '2025-06-30' GROUP BY ALL)"
