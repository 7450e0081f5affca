"""Queries of the llm operators and the SQL of those that SQL can express."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwerk.functions.scalars import source_key
from tarnwerk.llm import clusters, labels, leaks, mixing, pairs, pii, subjects
from tarnwerk.operators.joins import first_delivery, lookup_join
from tarnwerk.operators.lineage import cut
from tarnwerk.sources.ship import ship
from tarnwerk.sources.tables import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return pairs.find_defects(table(spark, d, "chat_records"))


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    """Unusable answers by field and defect."""
    return p1_found(spark, d).groupBy("answer_field", "defect").agg(F.count(F.lit(1)).alias("answers"))


def described(spark: SparkSession, d: str) -> DataFrame:
    """(table_name, record_id, text): the descriptions of incidents, tasks and audits, each record once."""
    out = None
    for name, key in (("incident_view", "incident_id"), ("task_view", "task_id"), ("audit_view", "audit_id")):
        one = first_delivery(table(spark, d, name), key, ["description"]).select(F.lit(name).alias("table_name"), F.col(key).alias("record_id"), F.col("description").alias("text"))
        out = one if out is None else out.unionByName(one)
    return out


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return pii.find_mentions(described(spark, d))


def p3_redacted(spark: SparkSession, d: str) -> DataFrame:
    """The descriptions with every mention replaced by a typed placeholder."""
    return pii.redact(described(spark, d)).drop("text")


def cards(spark: SparkSession, d: str) -> DataFrame:
    """(incident_id, text): each card once."""
    rows = table(spark, d, "clustered_records").where(F.col("incident_id").isNotNull())
    return rows.groupBy("incident_id").agg(F.min("ml_text_early").alias("text"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return clusters.happenings(cards(spark, d), "incident_id", "text").select("incident_id", F.col("first_id").alias("first_incident_id"))


def p5_groups(spark: SparkSession, d: str) -> DataFrame:
    """Every happening with its size and most typical cards."""
    return clusters.describe(clusters.happenings(cards(spark, d), "incident_id", "text"), "incident_id")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks.find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p8_items(spark: SparkSession, d: str) -> DataFrame:
    """Leaked test items with the number of documents that hold them."""
    return p8_found(spark, d).groupBy("item_id").agg(F.count(F.lit(1)).alias("documents"))


def sized_documents(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, key, tokens) of every document."""
    docs = table(spark, d, "documents").withColumn("key", source_key(F.col("source")))
    return mixing.count_tokens(docs, "text", keep=("doc_id", "key"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    shares = mixing.make_plan(sized_documents(spark, d), table(spark, d, "mix_targets"))
    return spark.createDataFrame([(s.source_name,) for s in shares if s.short], "source_name string")


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    """The mixed corpus: each document used, its source and how often."""
    sized = cut(sized_documents(spark, d))
    return mixing.realise(sized, mixing.make_plan(sized, table(spark, d, "mix_targets")), "doc_id")


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target shares and the shares really reached."""
    sized = cut(sized_documents(spark, d))
    shares = mixing.make_plan(sized, table(spark, d, "mix_targets"))
    return mixing.reached(mixing.realise(sized, shares, "doc_id"), shares)


def p9_even(spark: SparkSession, d: str) -> DataFrame:
    """The most even mix of the target sources that their repetition limits allow, and the shares really reached."""
    sized = cut(sized_documents(spark, d))
    shares = mixing.make_even_plan(sized, table(spark, d, "mix_targets"))
    return mixing.reached(mixing.realise(sized, shares, "doc_id"), shares)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return subjects.find_subjects(table(spark, d, "documents"), table(spark, d, "subject_areas"), table(spark, d, "subject_labels"))


def p10_composition(spark: SparkSession, d: str) -> DataFrame:
    """Documents and their share of the corpus by subject."""
    n = table(spark, d, "documents").agg(F.count(F.lit(1)).alias("all"))
    return p10_found(spark, d).groupBy("subject_code").agg(F.count(F.lit(1)).alias("documents")).crossJoin(F.broadcast(n)).select("subject_code", "documents", (F.col("documents") / F.col("all")).alias("share"))


def _places(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "location_view").where(F.col("location_id").isNotNull()).groupBy(F.col("location_id").cast("string").alias("place")).agg(F.min("locale_code").alias("locale"))


def language_rows(spark: SparkSession, d: str) -> DataFrame:
    """(table_name, record_id, text, label, is_english, place, locale) of unified_event and documents."""
    one = F.min(F.struct("description", "detected_language", "is_english_text", "location_id")).alias("r")
    events = table(spark, d, "unified_event").where(F.col("event_id").isNotNull()).groupBy("event_id").agg(one).select(
        F.lit("unified_event").alias("table_name"), F.col("event_id").alias("record_id"), F.col("r.description").alias("text"), F.col("r.detected_language").alias("label"),
        F.col("r.is_english_text").alias("is_english"), F.col("r.location_id").cast("string").alias("place"),
    )
    docs = table(spark, d, "documents").select(F.lit("documents"), F.col("doc_id").cast("string"), "text", "lang", F.lit(None).cast("boolean"), F.col("location_id").cast("string"))
    return lookup_join(events.union(docs).where(F.length("text") > 0), _places(spark, d), "place")


def p6_segments(spark: SparkSession, d: str) -> DataFrame:
    """Every record's runs with language and confidence."""
    return labels.detect(language_rows(spark, d))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return labels.wrong_labels(labels.detect(language_rows(spark, d))).select("table_name", "record_id", "seg_no", "lang_code")


def _shipped(f):
    @functools.wraps(f)
    def run(spark: SparkSession, d: str) -> DataFrame:
        ship(spark)
        return f(spark, d)

    return run


QUERIES = {f.__name__: _shipped(f) for f in (p1_found, p1_report, p3_found, p3_redacted, p5_found, p5_groups, p6_found, p6_segments, p8_found, p8_items, p9_found, p9_mix, p9_shares, p9_even, p10_found, p10_composition)}

#: Words of a text as leaks.normal_words has them: line ends inside words joined, case and inner marks gone.
_WORDS = "list_transform(regexp_extract_all(lower(regexp_replace(regexp_replace({0}, '([\\p{{L}}\\p{{N}}_])[-‐‑­¬]\\s*\\n\\s*([\\p{{L}}\\p{{N}}_])', '\\1\\2', 'g'), '[\\x{{00AD}}\\x{{200B}}-\\x{{200D}}\\x{{2060}}\\x{{FEFF}}]', '', 'g')), '[\\p{{L}}\\p{{N}}]+(?:[''’ʼ\\-‐‑][\\p{{L}}\\p{{N}}]+)*'), lambda w: regexp_replace(w, '[''’ʼ\\-‐‑]', '', 'g'))"
#: A leak is 12 words of the item with one error at most. Equal words on one diagonal form stretches; a stretch of five
#: words, with what follows or goes before it after one word changed, dropped or added, must make up twelve.
_LEAKS = f"""
WITH iw AS (SELECT item_id, {_WORDS.format("item_text")} AS w FROM eval_items WHERE item_id IS NOT NULL), dw AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents WHERE text <> ''),
ig AS (SELECT item_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS g FROM iw WHERE len(w) >= 5),
dg AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS g FROM dw WHERE len(w) >= 5),
near AS (SELECT DISTINCT doc_id, item_id FROM ig JOIN dg USING (g)),
ip AS (SELECT item_id, len(w) AS n, unnest(w) AS x, unnest(range(len(w))) AS i FROM iw), dp AS (SELECT doc_id, len(w) AS m, unnest(w) AS x, unnest(range(len(w))) AS j FROM dw),
eq AS (SELECT doc_id, item_id, n, m, i, i - j AS d FROM near JOIN ip USING (item_id) JOIN dp USING (doc_id, x)),
st AS (SELECT doc_id, item_id, any_value(n) AS n, any_value(m) AS m, d, min(i) AS s, max(i) + 1 AS e FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, item_id, d ORDER BY i) AS g FROM eq) GROUP BY doc_id, item_id, d, g),
er AS (SELECT * FROM (VALUES (1, 1, 1), (1, 0, 1), (0, 1, 0)) v(da, db, extra)),
hit AS (
  SELECT doc_id, item_id FROM st WHERE e - s >= 12
  UNION ALL SELECT a.doc_id, a.item_id FROM st a, er LEFT JOIN st b ON b.doc_id = a.doc_id AND b.item_id = a.item_id AND b.d = a.d + da - db AND b.s <= a.e + da AND a.e + da < b.e
    WHERE a.e - a.s >= 5 AND a.e + da <= a.n AND a.e - a.d + db <= a.m AND a.e - a.s + extra + coalesce(b.e - (a.e + da), 0) >= 12
  UNION ALL SELECT a.doc_id, a.item_id FROM st a, er LEFT JOIN st b ON b.doc_id = a.doc_id AND b.item_id = a.item_id AND b.d = a.d - da + db AND b.s < a.s - da AND a.s - da <= b.e
    WHERE a.e - a.s >= 5 AND a.s - da >= 0 AND a.s - a.d - db >= 0 AND a.e - a.s + extra + coalesce(a.s - da - b.s, 0) >= 12
)
"""
SQL: dict[str, str] = {
    "p8_found": _LEAKS + "SELECT DISTINCT doc_id, item_id FROM hit",
    "p8_items": _LEAKS + "SELECT item_id, count(DISTINCT doc_id) AS documents FROM hit GROUP BY 1",
}
