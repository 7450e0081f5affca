"""Merged searches, phrases, quotas and descriptions; names begin with operator handles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarnwerk.functions import terms as W
from tarnwerk.functions.json_text import extracted
from tarnwerk.operators import aggregates as A
from tarnwerk.operators import metrics, retrieval, sampling
from tarnwerk.operators import risk as K
from tarnwerk.operators.lineage import cut
from tarnwerk.operators.windows import top_per_group
from tarnwerk.plans import calibrated as cal
from tarnwerk.plans._register import Register
from tarnwerk.plans.records import _EV, _INCS, _KEY, _events, incidents
from tarnwerk.plans.search import _BM25, _TFIDF, bm25

R = Register()


@R.add(_TFIDF + cal._BG + cal._NN + cal._LIM + cal._BANDS + "SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY rank_no)::int AS new_rank FROM ban JOIN documents d USING (doc_id) WHERE band <> 'no_match' AND d.n_chars >= 200")
def wn19_reranked(t):
    """Matches ranked anew after bands and text length have thinned them out."""
    m, _ = cal.calibrated(t)
    good = m.where("band <> 'no_match'").join(t("documents").where("n_chars >= 200").select("doc_id"), "doc_id", "left_semi")
    return top_per_group(good.drop("score"), ["query_id"], [F.col("rank_no").asc()], 1_000, "new_rank").select("query_id", "doc_id", "new_rank")


@R.add(_BM25 + ", " + _TFIDF.replace("WITH c AS", "c2 AS").replace("n AS (SELECT count(*) AS n FROM documents)", "n2 AS (SELECT count(*) AS n FROM documents)").replace(" d AS (", " d2 AS (").replace("FROM c GROUP", "FROM c2 GROUP").replace("FROM n)", "FROM n2)").replace("FROM c JOIN d USING", "FROM c2 JOIN d2 USING").strip() + cal._NN + ", m AS (SELECT query_id, doc_id, 2 AS src, score AS own FROM bm UNION ALL SELECT query_id, doc_id, 1, score FROM near), o AS (SELECT *, row_number() OVER (PARTITION BY query_id, doc_id ORDER BY src) AS k FROM m) SELECT query_id, doc_id, src, rank_no::int AS rank_no FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY src, own DESC, doc_id) AS rank_no FROM o WHERE k = 1) WHERE rank_no <= 8")
def tx11_merged(t):
    """Matches of two indexes in one list: the vector index comes first, a document counts once, eight per query."""
    near = cal.vectors(t).nearest(cal.queries(t), 5).select("query_id", "doc_id", F.lit(1).alias("src"), F.col("score").alias("own"))
    words = bm25(t).select("query_id", "doc_id", F.lit(2).alias("src"), F.col("score").alias("own"))
    return retrieval.merge([near, words], ["query_id", "doc_id"], 8).select("query_id", "doc_id", "src", "rank_no")


@R.add(_TFIDF + cal._NN + ", part AS (SELECT q.doc_id AS query_id, v.term, 3.0 * v.weight AS w FROM documents q JOIN v USING (doc_id) WHERE q.doc_id % 100 = 0 UNION ALL SELECT query_id, v.term, 2.5 * v.weight FROM near JOIN v USING (doc_id)), s AS (SELECT query_id, term, round(sum(w), 5) AS score FROM part GROUP BY ALL) SELECT query_id, term, score, r::int AS rank_no FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, term) AS r FROM s) WHERE r <= 10")
def tx6_keyphrases(t):
    """Terms of a query (weight 3) and of its nearest documents (2.5), the ten strongest."""
    v = cal.vectors(t)
    near = cut(v.nearest(cal.queries(t), 5))
    own = cal.queries(t).select("query_id", F.col("query_id").alias("doc_id"), F.lit(3.0).alias("by"))
    both = own.unionByName(near.select("query_id", "doc_id", F.lit(2.5).alias("by")))
    both = both.join(v.weights(both), "doc_id")
    s = both.groupBy("query_id", "term").agg(F.round(F.sum(F.col("by") * F.col("weight")), 5).alias("score"))
    return top_per_group(s, ["query_id"], [F.desc("score"), "term"], 10)


_GR = "WITH a AS (SELECT source, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_\\-/]{2,}') AS a FROM documents WHERE source IS NOT NULL), g AS (SELECT source, unnest(list_transform(range(1, len(a)), lambda i: a[i] || ' ' || a[i + 1]) || list_transform(range(1, len(a) - 1), lambda i: a[i] || ' ' || a[i + 1] || ' ' || a[i + 2]) || list_transform(range(1, len(a) - 2), lambda i: a[i] || ' ' || a[i + 1] || ' ' || a[i + 2] || ' ' || a[i + 3])) AS phrase FROM a) "


def phrases(t, most: int):
    d = t("documents").where("source is not null").select("source", F.regexp_extract_all(F.lower("text"), F.lit(f"({retrieval.TERM})"), F.lit(1)).alias("_w")).where(F.size("_w") > 1)
    grams = F.slice(retrieval.grams(F.col("_w"), 4), F.size("_w") + 1, 1_000_000_000)
    n = d.select("source", F.explode(grams).alias("phrase")).groupBy("source", "phrase").agg(F.count(F.lit(1)).alias("n"))
    return top_per_group(n, ["source"], [F.desc("n"), "phrase"], most)


@R.add(_GR + "SELECT source, phrase, n, r::int AS rank_no FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, phrase) AS r FROM (SELECT source, phrase, count(*) AS n FROM g GROUP BY ALL)) WHERE r <= 25")
def tx2_phrases(t):
    """The most frequent phrases of two to four words of each source."""
    return phrases(t, 25)


@R.add()
def tx4_top_phrases(t):
    """Five phrases per source, chosen from its 25 best so that none repeats another (functions.terms.distinct_phrases)."""
    import pandas as pd

    def choose(key, b: "pd.DataFrame") -> "pd.DataFrame":
        kept = W.distinct_phrases(b.sort_values("rank_no")["phrase"].tolist(), 5)
        return pd.DataFrame({"source": key[0], "place": range(1, len(kept) + 1), "phrase": kept})

    return phrases(t, 25).groupBy("source").applyInPandas(choose, "source string, place int, phrase string")  # 25 rows per source


@R.add("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0 ORDER BY c_acctbal DESC, c_custkey LIMIT 25")
def tk4_positive_top(t):
    """The largest positive scores: each task keeps 25 rows."""
    return t("customer").where("c_acctbal > 0").select("c_custkey", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey").limit(25)


_FAMS = {"near_miss": 30, "hazard_identification": 20, "audit": 25, "task": 25}


@R.add(f"SELECT event_id, source_type FROM (SELECT event_id, source_type, row_number() OVER (PARTITION BY source_type ORDER BY {_KEY.format('event_id')}, event_id) AS r FROM {_EV}) JOIN (VALUES " + ", ".join(f"('{k}', {v * 2})" for k, v in _FAMS.items()) + ") q(source_type, quota) USING (source_type) WHERE r <= quota")
def sm4_quotas(t):
    """A sample of 200 events by quotas of families."""
    return sampling.quota_sample(_events(t).select("event_id", "source_type"), "source_type", sampling.quotas(_FAMS, 200), "event_id").select("event_id", "source_type")


@R.add(f"SELECT event_id, source_type FROM (SELECT event_id, source_type, coalesce(severe_actual, false) AS must, row_number() OVER (PARTITION BY source_type ORDER BY coalesce(severe_actual, false) DESC, {_KEY.format('event_id')}, event_id) AS r FROM {_EV}) WHERE must OR r <= 60")
def sm5_capped(t):
    """At most 60 events of each family, but all severe ones."""
    return sampling.capped(_events(t).select("event_id", "source_type", "severe_actual"), "source_type", F.col("severe_actual"), 60, "event_id").select("event_id", "source_type")


@R.add(f"SELECT part, source_type, count(*) AS n FROM (SELECT source_type, CASE WHEN u < 0.8 THEN 'train' WHEN u < 0.9 THEN 'val' ELSE 'test' END AS part FROM (SELECT source_type, {_KEY.format('event_id')} / {float(2**60)} AS u FROM {_EV})) GROUP BY ALL")
def ag39_split_manifest(t):
    """Rows of each part of a split by source type."""
    return sampling.split(_events(t).select("event_id", "source_type"), "event_id", [("train", 0.8), ("val", 0.1), ("test", 0.1)]).groupBy("part", "source_type").agg(F.count(F.lit(1)).alias("n"))


@R.add(f"SELECT location_id, strftime(month, '%Y-%m') AS month, count(*) AS n, count(*) FILTER (active AND NOT archived) AS active_count, count(*) FILTER (archived) AS archived_count, count(*) FILTER (incident_category_id = 1) AS first_kind, count(*) FILTER (incident_category_id = 2) AS second_kind, count(*) FILTER (incident_status_id IS NULL) AS without_status, count(DISTINCT incident_category_id) AS categories FROM {_INCS} GROUP BY ALL")
def ag2_incident_months(t):
    """Incident features of a place and month."""
    e = incidents(t).withColumn("month", F.date_format("month", "yyyy-MM"))
    kinds = {"active_count": F.col("active") & ~F.col("archived"), "archived_count": F.col("archived"), "first_kind": F.col("incident_category_id") == 1, "second_kind": F.col("incident_category_id") == 2, "without_status": F.col("incident_status_id").isNull()}
    return K.monthly_stats(e, ["location_id", "month"], kinds, {"categories": "incident_category_id"})


_AU = "(SELECT audit_id, arg_min(a, loaded_at) AS r FROM audit_view a WHERE audit_id IS NOT NULL GROUP BY 1)"


@R.add(f"SELECT r.scheduled_location_id AS location_id, strftime(r.actual_start, '%Y-%m') AS month, count(*) AS n, count(*) FILTER (r.active) AS active_count, count(*) FILTER (r.archived) AS archived_count, count(*) FILTER (r.actual_end IS NULL) AS unfinished, count(*) FILTER (r.scheduled_end < r.actual_end) AS late, count(*) FILTER (r.audit_type_id IS NULL) AS without_type, count(*) FILTER (trim(r.comments) <> '') AS commented, count(DISTINCT r.audit_category_id) AS categories FROM {_AU} GROUP BY ALL")
def ag4_audit_months(t):
    """Audit features of a place and month."""
    from tarnwerk.operators.joins import first_delivery

    a = first_delivery(t("audit_view"), "audit_id", ["scheduled_location_id", "actual_start", "actual_end", "scheduled_end", "active", "archived", "audit_type_id", "audit_category_id", "comments"])
    a = a.select("*", F.col("scheduled_location_id").alias("location_id"), F.date_format("actual_start", "yyyy-MM").alias("month"))
    kinds = {"active_count": F.col("active"), "archived_count": F.col("archived"), "unfinished": F.col("actual_end").isNull(), "late": F.col("scheduled_end") < F.col("actual_end"), "without_type": F.col("audit_type_id").isNull(), "commented": F.trim("comments") != ""}
    return K.monthly_stats(a, ["location_id", "month"], kinds, {"categories": "audit_category_id"})


_DESC = ("l_returnflag", "l_linestatus")


@R.add(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count({c}) AS filled, count(DISTINCT {c}) AS distinct_values, (SELECT arg_min({c}::varchar, (-n, {c}::varchar)) FROM (SELECT {c}, count(*) AS n FROM lineitem WHERE {c} IS NOT NULL GROUP BY 1)) AS top, (SELECT max(n) FROM (SELECT count(*) AS n FROM lineitem WHERE {c} IS NOT NULL GROUP BY {c})) AS top_count FROM lineitem" for c in _DESC))
def ag11_describe(t):
    """Every column at once: filled, distinct, most frequent value and its count."""
    return A.describe(t("lineitem"), _DESC)


@R.add("WITH x AS (SELECT label AS c, embedding::double[] AS v FROM embeddings), ce AS (SELECT c, list(m ORDER BY pos) AS m FROM (SELECT c, pos, avg(e) AS m FROM (SELECT c, unnest(v) AS e, unnest(range(len(v))) AS pos FROM x) GROUP BY ALL) GROUP BY 1), gl AS (SELECT list(m ORDER BY pos) AS g FROM (SELECT pos, avg(e) AS m FROM (SELECT unnest(v) AS e, unnest(range(len(v))) AS pos FROM x) GROUP BY 1)), s AS (SELECT c, avg(list_distance(v, m)) AS s, sum(list_distance(v, m) * list_distance(v, m)) AS w, count(*) AS n, any_value(m) AS m FROM x JOIN ce USING (c) GROUP BY 1), db AS (SELECT avg(r) AS r FROM (SELECT max((a.s + b.s) / list_distance(a.m, b.m)) AS r FROM s a JOIN s b ON a.c <> b.c GROUP BY a.c)) SELECT round((SELECT r FROM db), 4) AS davies_bouldin, round((sum(n * list_distance(m, g) * list_distance(m, g)) / (count(*) - 1)) / (sum(w) / (sum(n) - count(*))), 4) AS calinski_harabasz FROM s, gl")
def ml6_separation(t):
    """Davies-Bouldin and Calinski-Harabasz of the labels' clusters."""
    return metrics.separation(t("embeddings"), "label", "embedding")


@R.add(f"SELECT a.location_id, strftime(a.month, '%Y-%m') AS month, string_agg(DISTINCT b.incident_category_id::varchar, ',' ORDER BY b.incident_category_id::varchar) AS kinds FROM (SELECT DISTINCT location_id, month FROM {_INCS} WHERE location_id IS NOT NULL AND month IS NOT NULL AND incident_category_id IS NOT NULL) a JOIN {_INCS} b ON b.location_id = a.location_id AND b.month <= a.month AND b.month > a.month - INTERVAL 3 MONTH WHERE b.incident_category_id IS NOT NULL GROUP BY ALL")
def j24_recent_kinds(t):
    """Which kinds occurred at a place in the last three months, one row per place and month with incidents."""
    from tarnwerk.operators.windows import rolling_items

    out = rolling_items(incidents(t).where("location_id is not null"), ["location_id"], "month", "incident_category_id", 3, "kinds")
    return out.select("location_id", F.date_format("month", "yyyy-MM").alias("month"), "kinds")


@R.add("SELECT list_item_id, list_type_code, coalesce(nullif(trim(item), ''), nullif(trim(short_name), ''), nullif(trim(code), ''), list_item_id::varchar) AS label FROM (SELECT DISTINCT list_item_id, list_type_code, item, short_name, code FROM listitem_view WHERE list_item_id IS NOT NULL)")
def cp3_code_labels(t):
    """Codes with the first of their label columns that says something."""
    li = t("listitem_view").where("list_item_id is not null").select("list_item_id", "list_type_code", "item", "short_name", "code").distinct()
    return li.select("list_item_id", "list_type_code", F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in ("item", "short_name", "code")], F.col("list_item_id").cast("string")).alias("label"))


@R.add()
def js1_extracted_json(t):
    """The JSON in the last assistant message of each chat, whole or repaired, and how it came."""
    last = F.try_element_at(F.filter("messages", lambda m: F.lower(F.trim(m["role"])) == "assistant"), F.lit(-1))["content"]
    return cut(t("chat_records").select("chat_id", last.alias("a")).distinct()).select("chat_id", extracted(F.col("a")).alias("x")).select("chat_id", "x.json", "x.how")


QUERIES, SQL = R.queries, R.sql
