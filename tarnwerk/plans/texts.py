"""Projection and text operators with their parameters as arguments; names begin with operator handles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarnwerk.functions import terms as W
from tarnwerk.functions import text as T
from tarnwerk.functions.scalars import word_count
from tarnwerk.operators import projection
from tarnwerk.plans._register import Register
from tarnwerk.plans.records import _CL, _CLEANED, _EV, _events, clustered

R = Register()
_STOPS = "(" + ", ".join(f"'{w}'" for w in W.STOP_WORDS) + ")"
_STOP_LIST = "[" + ", ".join(f"'{w}'" for w in W.STOP_WORDS) + "]"
_FOLD = f"translate(lower({{0}}), '{W.MARKED}', '{W.PLAIN}')"
_WORDS = f"list_filter(regexp_extract_all({_FOLD}, '[\\p{{{{L}}}}][\\p{{{{L}}}}-]*\\p{{{{L}}}}'), lambda w: length(w) >= 3 AND NOT list_contains({_STOP_LIST}, w) AND NOT (length(replace(w, w[1], '')) = 0))"


@R.add(f"SELECT event_id, concat('title: ', {_CLEANED.format('title')}, ' | description: ', {_CLEANED.format('description')}) AS block FROM {_EV}")
def pr7_full_block(t):
    """The labelled block that keeps its empty parts."""
    return _events(t).select("event_id", projection.full_block("title", "description").alias("block"))


@R.add("WITH x AS (SELECT incident_id, min(ml_text_early) AS early, min(incident_category_name) AS category, min(site_name_filled) AS site FROM clustered_records WHERE incident_id IS NOT NULL GROUP BY 1), m AS (SELECT max(len(regexp_extract_all(coalesce(early, ''), '\\S+'))) >= 3 AS good FROM x) SELECT incident_id, CASE WHEN good THEN coalesce(early, '') ELSE concat_ws(' ', category, site) END AS text FROM x, m")
def pr9_early_text(t):
    """The early text if any row of the table has enough words in it, else the context columns."""
    c = t("clustered_records").where("incident_id is not null").groupBy("incident_id").agg(F.min("ml_text_early").alias("early"), F.min("incident_category_name").alias("category"), F.min("site_name_filled").alias("site"))
    return projection.early_text(c, "early", ["category", "site"], "text").select("incident_id", "text")


@R.add(f"SELECT event_id, coalesce(nullif({_CLEANED.format('description')}, ''), concat_ws(' ', nullif({_CLEANED.format('title')}, ''), nullif({_CLEANED.format('category')}, ''), nullif({_CLEANED.format('site')}, ''))) AS text FROM {_EV}")
def pr10_fallback_text(t):
    return _events(t).select("event_id", projection.fallback_text("description", ["title", "category", "site"]).alias("text"))


@R.add("SELECT location_id AS scheduled_location_id, location_name AS scheduled_location_name FROM location_view")
def pr16_prefixed(t):
    return projection.prefixed(t("location_view").select("location_id", "location_name"), "scheduled_")


@R.add("SELECT coalesce(nullif(trim(site), ''), 'Unknown') AS site, coalesce(nullif(trim(department), ''), 'Unknown') AS department, count(*) AS n FROM unified_event GROUP BY ALL")
def pr17_group_keys(t):
    return projection.with_unknown(t("unified_event"), ["site", "department"]).groupBy("site", "department").agg(F.count(F.lit(1)).alias("n"))


@R.add(f"SELECT e.event_id, coalesce(c.category, e.category) AS category, coalesce(c.site, e.site) AS site FROM {_EV} e LEFT JOIN {_CL} c ON e.source_id = c.incident_id AND starts_with(e.event_id, 'incident_')")
def pr18_resolved(t):
    """Columns that both sides of a join have: the left one, else the right one."""
    c = clustered(t).select(F.concat(F.lit("incident_"), F.col("incident_id").cast("string")).alias("event_id"), "category", "site")
    return projection.resolved(_events(t).select("event_id", "category", "site"), c, "event_id", ["category", "site"])


@R.add("SELECT event_id, coalesce(title, '') AS title, 0.0::double AS audit_count_last_3m, 'Unknown' AS region FROM " + _EV)
def pr19_model_columns(t):
    """Columns a model wants and the data lack: 0 for numbers, Unknown for texts."""
    e = _events(t).select("event_id", F.coalesce("title", F.lit("")).alias("title"))
    return projection.with_missing(e, {"title": "string", "audit_count_last_3m": "double", "region": "string"})


@R.add("SELECT event_id, CASE WHEN location_id IS NOT NULL THEN location_id::varchar WHEN trim(coalesce(location_path, '')) <> '' THEN 'path:' || trim(location_path) END AS location_key FROM " + _EV)
def pr21_location_key(t):
    return _events(t).select("event_id", projection.location_key("location_id", "location_path").alias("location_key"))


@R.add(f"SELECT event_id, x AS text, CASE WHEN x = '' THEN 0 ELSE len(string_split(x, ' ')) END::int AS n_words, event_date::date AS day, coalesce(any_injury, false) AS injury FROM (SELECT *, coalesce(nullif({_CLEANED.format('description')}, ''), nullif({_CLEANED.format('title')}, ''), '') AS x FROM {_EV})")
def pr23_working_columns(t):
    e = _events(t).withColumn("text", T.first_text("description", "title"))
    return e.select("event_id", "text", word_count(F.col("text")).cast("int").alias("n_words"), F.to_date("event_date").alias("day"), F.coalesce("any_injury", F.lit(False)).alias("injury"))


_SHAPED = ("incident_view", "task_view", "audit_view", "location_view", "listitem_view")


@R.add(" UNION ALL ".join(f"SELECT '{n}' AS table_name, (SELECT count(*) FROM {n}) AS n_rows, (SELECT count(*) FROM (DESCRIBE {n}))::int AS n_columns" for n in _SHAPED))
def pr24_shapes(t):
    """Rows and columns per source; only row counts are read."""
    return projection.shapes({n: t(n) for n in _SHAPED})


@R.add(f"SELECT event_id, to_json([{{'role': 'system', 'content': 'Classify the record.'}}, {{'role': 'user', 'content': x}}, {{'role': 'assistant', 'content': coalesce(category, '')}}]) AS messages, source_type FROM (SELECT *, coalesce(nullif({_CLEANED.format('description')}, ''), nullif({_CLEANED.format('title')}, ''), '') AS x FROM {_EV}) WHERE x <> ''")
def pr25_chat_records(t):
    """Records as three messages with what they stem from."""
    e = _events(t).withColumn("x", T.first_text("description", "title")).where("x <> ''")
    return e.select("event_id", F.to_json(projection.messages("Classify the record.", F.col("x"), F.coalesce("category", F.lit("")))).alias("messages"), "source_type")


@R.add("SELECT incident_id, coalesce(active, false) AND NOT coalesce(archived, false) AS is_active FROM incident_view")
def fl1_active(t):
    return t("incident_view").select("incident_id", projection.is_active("active", "archived").alias("is_active"))


@R.add(f"SELECT event_id FROM (SELECT event_id, {_CLEANED.format('description')} AS x FROM {_EV}) WHERE length(x) >= 25 AND len(string_split(x, ' ')) >= 5")
def fl5_text_quality(t):
    return projection.good_text(_events(t), T.clean(F.col("description")), 25, 5).select("event_id")


@R.add("SELECT event_id, contains(x, 'forklift') OR contains(x, 'ladder') AS literal_hit, regexp_matches(x, 'slip(ped)?|trip(ped)?') AS pattern_hit FROM (SELECT event_id, lower(concat_ws(' ', title, description, category)) AS x FROM " + _EV + ")")
def fl10_any_column(t):
    """Words and patterns looked for in several columns at once."""
    x = projection.searchable("title", "description", "category")
    return _events(t).select("event_id", projection.contains_any(x, ["forklift", "ladder"]).alias("literal_hit"), projection.matches_any(x, ["slip(ped)?", "trip(ped)?"]).alias("pattern_hit"))


_IDS = ("event_id", "source_id", "raw_")


@R.add("SELECT column_name, column_name = 'severe_actual' OR " + " OR ".join(f"starts_with(column_name, '{p}')" for p in _IDS) + " AS excluded FROM (DESCRIBE unified_event)")
def fl26_identifier_columns(t):
    """Columns a model must not see: the target, identifiers and raw codes, by the beginning of their names."""
    return projection.column_roles(t("unified_event"), "severe_actual", _IDS)


@R.add("SELECT location_id, location_name, coalesce(regexp_matches(trim(location_name), '^\\d+(?:\\.0+)?$'), false) AS id_like FROM location_view")
def fl27_id_like(t):
    return t("location_view").select("location_id", "location_name", W.id_like(F.col("location_name")).alias("id_like"))


@R.add("SELECT DISTINCT location_id FROM (SELECT location_id FROM unified_event WHERE location_id IS NOT NULL AND site IS NOT NULL AND NOT regexp_matches(site, '^\\d+(?:\\.0+)?$') AND NOT contains(lower(location_path), 'unknown') UNION ALL SELECT location_id FROM location_view WHERE location_id IN (1, 2, 3))")
def fl28_candidate_places(t):
    """Places that pass a chain of filters, with some added by hand, each once."""
    chain = [F.col("location_id").isNotNull(), F.col("site").isNotNull(), ~W.id_like(F.col("site")), ~F.contains(F.lower("location_path"), F.lit("unknown"))]
    return projection.chosen(t("unified_event"), "location_id", chain, t("location_view"), [1, 2, 3])


@R.add(f"SELECT phrase, len({_WORDS.format('phrase')}) >= 2 AS useful FROM (SELECT DISTINCT unnest(keywords) AS phrase FROM subject_areas UNION SELECT DISTINCT category FROM unified_event WHERE category IS NOT NULL)")
def fl30_useful_phrases(t):
    p = t("subject_areas").select(F.explode("keywords").alias("phrase")).union(t("unified_event").where("category is not null").select("category")).distinct()
    return p.select("phrase", W.useful(F.col("phrase")).alias("useful"))


@R.add(f"SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace({_FOLD.format('text')}, 'https?://\\S+|www\\.\\S+|[\\w.-]+@[\\w.-]+', ' ', 'g'), '\\b[0-9]{{1,4}}\\b', ' ', 'g'), '\\s+', ' ', 'g')) AS norm FROM documents")
def st6_full_normalise(t):
    return t("documents").select("doc_id", W.normal(F.col("text")).alias("norm"))


def _stem_sql(w):
    out = w
    for s in reversed(W.SUFFIXES):
        out = f"CASE WHEN ends_with({w}, '{s}') AND length({w}) - {len(s)} >= 4 THEN {w}[1:length({w}) - {len(s)}] ELSE {out} END"
    return f"CASE WHEN length({w}) <= 4 THEN {w} ELSE {out} END"


_LEMMA = "CASE WHEN length({0}) > 5 AND ends_with({0}, 'ies') THEN {0}[1:length({0}) - 3] || 'y' WHEN length({0}) > 5 AND ends_with({0}, 'ing') THEN {0}[1:length({0}) - 3] WHEN length({0}) > 5 AND (ends_with({0}, 'ed') OR ends_with({0}, 'es')) THEN {0}[1:length({0}) - 2] WHEN length({0}) > 4 AND ends_with({0}, 's') AND NOT ends_with({0}, 'ss') AND NOT ends_with({0}, 'us') THEN {0}[1:length({0}) - 1] ELSE {0} END"


@R.add(f"SELECT stem, count(*) AS n FROM (SELECT {_stem_sql('w')} AS stem FROM (SELECT unnest({_WORDS.format('text')}) AS w FROM documents)) GROUP BY 1 HAVING count(*) >= 5")
def st7_stems(t):
    w = t("documents").select(F.explode(W.words(F.col("text"))).alias("w"))
    return w.groupBy(W.stem(F.col("w")).alias("stem")).agg(F.count(F.lit(1)).alias("n")).where("n >= 5")


@R.add(f"SELECT lemma, count(*) AS n FROM (SELECT {_LEMMA.format('w')} AS lemma FROM (SELECT unnest({_WORDS.format('text')}) AS w FROM documents)) GROUP BY 1 HAVING count(*) >= 5")
def st7_lemmas(t):
    w = t("documents").select(F.explode(W.words(F.col("text"))).alias("w"))
    return w.groupBy(W.lemma(F.col("w")).alias("lemma")).agg(F.count(F.lit(1)).alias("n")).where("n >= 5")


@R.add(f"SELECT doc_id, array_to_string({_WORDS.format('text')}, ' ') AS words FROM documents")
def st8_tokens(t):
    """Words of six languages without their stop words."""
    return t("documents").select("doc_id", F.array_join(W.words(F.col("text")), " ").alias("words"))


@R.add(f"SELECT source, term, n FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, term) AS r FROM (SELECT source, term, count(*) AS n FROM (SELECT source, unnest(list_filter({_WORDS.format('text')}, lambda w: length(w) >= 4)) AS term FROM documents WHERE source IS NOT NULL) GROUP BY ALL)) WHERE r <= 8")
def st12_keywords(t):
    """The most frequent words of four letters and more of each source."""
    from tarnwerk.operators.windows import top_per_group

    w = t("documents").where("source is not null").select("source", F.explode(W.words(F.col("text"), least=4)).alias("term"))
    return top_per_group(w.groupBy("source", "term").agg(F.count(F.lit(1)).alias("n")), ["source"], [F.desc("n"), "term"], 8).select("source", "term", "n")


_LABELS = ("reported by", "note", "card", "contact", "signed", "location")


@R.add(f"SELECT event_id, trim(regexp_replace(regexp_replace(coalesce(description, ''), '\\b(?:{'|'.join(_LABELS)})\\s*:', ' ', 'gi'), '\\s+', ' ', 'g')) AS body FROM {_EV}")
def st9_without_labels(t):
    return _events(t).select("event_id", W.without_labels(F.coalesce("description", F.lit("")), _LABELS).alias("body"))


@R.add("SELECT doc_id, array_to_string(list_filter(s, lambda x, i: list_position(list_transform(s, lambda y: lower(y)), lower(x)) = i), ' ')[1:300] AS summary FROM (SELECT doc_id, list_filter(list_transform(string_split_regex(regexp_replace(trim(regexp_replace(text, '\\s+', ' ', 'g')), '([.!?])\\s+', '\\1\t', 'g'), '\t'), lambda x: trim(x)), lambda x: x <> '') AS s FROM documents)")
def st10_distinct_sentences(t):
    return t("documents").select("doc_id", W.distinct_sentences(F.col("text"), 300).alias("summary"))


@R.add("SELECT column_name AS feature, regexp_replace(trim(regexp_replace(column_name, '_', ' ', 'g')), '\\s+', ' ', 'g') AS plain FROM (DESCRIBE unified_event)")
def st15_friendly_names(t):
    """Feature names for people, compared in small letters."""
    e = t("unified_event")
    cols = e.sparkSession.createDataFrame([(c,) for c in e.columns], "feature string")
    return cols.select("feature", F.lower(W.friendly(F.col("feature"))).alias("plain"))


_TAGS = ("ladder", "forklift", "socket", "crane", "guard")
_FIRST = "string_split(regexp_replace(trim(regexp_replace(text, '\\s+', ' ', 'g')), '([.!?])\\s+', '\\1\t', 'g'), '\t')[1][1:180]"
_FOUND = "list_filter([" + ", ".join(f"CASE WHEN instr(lower(text), '{g}') > 0 THEN text[greatest(1, instr(lower(text), '{g}') - 45):instr(lower(text), '{g}') + {len(g) + 44}] END" for g in _TAGS) + "], lambda x: x IS NOT NULL)[1:4]"


@R.add(f"SELECT doc_id, array_to_string(CASE WHEN len(f) > 0 THEN f WHEN {_FIRST} <> '' THEN [{_FIRST}] ELSE [] END, ' || ') AS phrases FROM (SELECT doc_id, text, {_FOUND} AS f FROM documents)")
def st16_evidence_window(t):
    """45 characters around each of several tags, at most four; without any the first sentence."""
    return t("documents").select("doc_id", F.array_join(W.evidences(F.col("text"), _TAGS), " || ").alias("phrases"))


@R.add("SELECT source, tag, count(*) AS docs, array_to_string(list(doc_id ORDER BY length(text), doc_id)[1:5], ',') AS ids FROM documents, (SELECT unnest(['" + "', '".join(_TAGS) + "']) AS tag) WHERE regexp_matches(lower(text), '\\b' || tag || '\\b') GROUP BY ALL")
def tx17_supporting_ids(t):
    """Of each source and phrase the documents that hold it: how many, and the five shortest."""
    return projection.supporting_ids(t("documents"), ["source"], "doc_id", "text", _TAGS, 5).withColumn("ids", F.array_join(F.transform("ids", lambda x: x.cast("string")), ","))


@R.add("SELECT event_id, strftime(date_trunc('month', event_date) + INTERVAL 3 MONTH, '%Y-%m') AS three_on, len(generate_series(date_trunc('month', event_date), TIMESTAMP '2025-06-01', INTERVAL 1 MONTH))::int AS months_to_end FROM " + _EV + " WHERE event_date < TIMESTAMP '2025-06-01'")
def dt5_month_offsets(t):
    e = _events(t).where(F.col("event_date") < F.lit("2025-06-01").cast("timestamp_ntz"))
    m = F.trunc(F.to_date("event_date"), "MM")
    return e.select("event_id", F.date_format(F.add_months(m, 3), "yyyy-MM").alias("three_on"), F.size(T.month_sequence(m, F.lit("2025-06-01").cast("date"))).alias("months_to_end"))


@R.add("SELECT event_id, date_diff('day', event_date::date, DATE '2024-03-31') AS days_before FROM " + _EV + " WHERE event_date IS NOT NULL")
def dt6_reference_day(t):
    """Days from an event to a reference instant, which counts from its midnight in UTC."""
    ref = T.reference_day("2024-03-31T17:45:00Z")
    return _events(t).where("event_date is not null").select("event_id", F.datediff(ref, F.to_date("event_date")).cast("bigint").alias("days_before"))


@R.add("SELECT doc_id, array_to_string(list_filter(a, lambda x, i: list_position(a, x) = i), ' ') AS words_once FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}]+') AS a FROM documents)")
def so6_ordered_distinct(t):
    """A list without repeats, each item where it stands first."""
    return t("documents").select("doc_id", F.array_join(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1))), " ").alias("words_once"))


@R.add("SELECT location_id FROM (SELECT location_id, count(*) AS n FROM unified_event WHERE location_id IS NOT NULL GROUP BY 1 HAVING count(*) >= 20) UNION SELECT location_id FROM location_view WHERE location_id IN (1, 2, 3)")
def so7_with_manual(t):
    busy = t("unified_event").where("location_id is not null").groupBy("location_id").agg(F.count(F.lit(1)).alias("n")).where("n >= 20")
    return projection.with_manual(busy, "location_id", t("location_view"), [1, 2, 3])


QUERIES, SQL = R.queries, R.sql
