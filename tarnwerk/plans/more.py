"""Further single operators over whole tables, each with its SQL; names begin with operator handles."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F


from tarnwerk.operators import retrieval, sampling
from tarnwerk.operators.aggregates import quantiles, value_table
from tarnwerk.operators.windows import top_per_group
from tarnwerk.plans._register import Register
from tarnwerk.plans.records import _CL, _EV, _events, clustered

R = Register()


@R.add("SELECT doc_id, concat_ws(' | ', nullif(trim(source), ''), nullif(trim(lang), '')) AS combined FROM documents")
def pr8_combine_fields(t):
    return t("documents").select("doc_id", F.concat_ws(" | ", F.nullif(F.trim("source"), F.lit("")), F.nullif(F.trim("lang"), F.lit(""))).alias("combined"))


@R.add("SELECT DISTINCT location_path, CASE WHEN location_path IS NULL OR trim(location_path) = '' THEN 'Unknown' ELSE trim(string_split(location_path, '>')[-1]) END AS leaf FROM unified_event")
def pr20_path_leaf(t):
    p = F.col("location_path")
    return t("unified_event").select("location_path", F.when(p.isNull() | (F.trim(p) == ""), "Unknown").otherwise(F.trim(F.element_at(F.split(p, ">"), -1))).alias("leaf")).distinct()


@R.add(f"SELECT DISTINCT cluster_id, CASE WHEN cluster_id IS NULL OR cluster_id < 0 THEN 'IH_UNASSIGNED' ELSE format('IH_{{:04d}}', cluster_id) END AS theme FROM {_CL}")
def pr22_theme_ids(t):
    c = F.col("cluster_id")
    return clustered(t).select("cluster_id", F.when(c.isNull() | (c < 0), "IH_UNASSIGNED").otherwise(F.format_string("IH_%04d", c)).alias("theme")).distinct()


@R.add("SELECT event_id, array_to_string(list_filter([CASE WHEN any_injury THEN 'injury' END, CASE WHEN severe_actual THEN 'severe' END, CASE WHEN is_open_task THEN 'open_task' END, CASE WHEN has_text THEN 'text' END], lambda x: x IS NOT NULL), ',') AS indexes FROM " + _EV)
def fl18_index_membership(t):
    """Purpose-specific memberships of each event as an array, from one pass."""
    names = {"injury": "any_injury", "severe": "severe_actual", "open_task": "is_open_task", "text": "has_text"}
    return _events(t).select("event_id", F.array_join(F.array_compact(F.array(*[F.when(F.col(c), n) for n, c in names.items()])), ",").alias("indexes"))


@R.add("SELECT source_type, count(*) AS n FROM unified_event WHERE event_date IS NULL OR event_date <= TIMESTAMP '2024-01-01' GROUP BY 1")
def fl4_point_in_time(t):
    return t("unified_event").where(F.col("event_date").isNull() | (F.col("event_date") <= F.lit("2024-01-01").cast("timestamp_ntz"))).groupBy("source_type").agg(F.count(F.lit(1)).alias("n"))


@R.add("SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders) WHERE r = 1")
def wn17_first_row(t):
    """The first order of each customer: a grouped minimum, not a sorted window."""
    return t("orders").groupBy("o_custkey").agg(F.min(F.struct("o_orderdate", "o_orderkey")).alias("x")).select("o_custkey", "x.o_orderkey", "x.o_orderdate")


@R.add("SELECT o_orderkey, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1)::int AS idx FROM orders")
def wn6_row_index(t):
    return t("orders").select("o_orderkey", (F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")) - 1).alias("idx"))


@R.add("SELECT c_nationkey, round((r1 + r2) / 2.0, 2) AS mean_rank FROM (SELECT c_nationkey, rank() OVER (ORDER BY n DESC) AS r1, rank() OVER (ORDER BY bal DESC) AS r2 FROM (SELECT c_nationkey, count(*) AS n, round(sum(c_acctbal), 2) AS bal FROM customer GROUP BY 1))")
def wn13_mean_rank(t):
    """Mean of the ranks by two measures; the groups are one row per nation."""
    g = t("customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("bal"))
    w = Window.partitionBy()
    return g.select("c_nationkey", F.round((F.rank().over(w.orderBy(F.desc("n"))) + F.rank().over(w.orderBy(F.desc("bal")))) / 2.0, 2).alias("mean_rank"))


@R.add("SELECT location_id, period, event_id FROM (SELECT location_id, strftime(event_date, '%Y-%m') AS period, event_id, row_number() OVER (PARTITION BY location_id, strftime(event_date, '%Y-%m') ORDER BY (any_injury)::int DESC, event_date DESC, event_id) AS r FROM " + _EV + " WHERE event_date IS NOT NULL AND location_id IS NOT NULL AND any_injury IS NOT NULL) WHERE r <= 3")
def wn16_best_examples(t):
    e = _events(t).where("event_date is not null and location_id is not null and any_injury is not null").withColumn("period", F.date_format("event_date", "yyyy-MM"))
    return top_per_group(e.select("location_id", "period", "event_id", "any_injury", "event_date"), ["location_id", "period"], [F.desc("any_injury"), F.desc("event_date"), "event_id"], 3).select("location_id", "period", "event_id")


@R.add("SELECT o_orderpriority, o_orderstatus, n, round(n / sum(n) OVER (PARTITION BY o_orderpriority), 6) AS share FROM (SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL)")
def wn18_share(t):
    g = t("orders").groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("o_orderpriority")), 6))


@R.add("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 200")
def tk7_most_recent(t):
    return t("orders").select("o_orderkey", "o_orderdate").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(200)


@R.add("WITH g AS (SELECT c_custkey, c_acctbal, c_acctbal > 9990 AS sel FROM customer), k AS (SELECT count(*) FILTER (sel) AS s, ceil(count(*) * 0.1)::bigint AS f FROM g) SELECT c_custkey FROM (SELECT *, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS r FROM g), k WHERE CASE WHEN s > 0 THEN sel ELSE r <= f END")
def tk5_queue_with_fallback(t):
    """The selected ones; where none is selected the best tenth."""
    from tarnwerk.operators.windows import ranked

    g = ranked(t("customer").select("c_custkey", "c_acctbal"), "c_acctbal", ["c_custkey"])
    k = g.agg(F.count_if(F.col("c_acctbal") > 9990).alias("s"), F.ceil(F.count(F.lit(1)) * 0.1).alias("f"))
    return g.crossJoin(F.broadcast(k)).where(F.when(F.col("s") > 0, F.col("c_acctbal") > 9990).otherwise(F.col("rank_no") <= F.col("f"))).select("c_custkey")  # one row


@R.add("SELECT DISTINCT site, department FROM unified_event EXCEPT SELECT DISTINCT site, department FROM unified_event WHERE any_injury")
def so5_difference(t):
    e = t("unified_event").select("site", "department")
    return e.distinct().exceptAll(t("unified_event").where("any_injury").select("site", "department").distinct())


@R.add("SELECT doc_id, len(regexp_extract_all(text, '[\\p{L}\\p{N}_]+'))::int AS words FROM documents")
def st4_unicode_words(t):
    return t("documents").select("doc_id", F.regexp_count("text", F.lit(r"[\p{L}\p{N}_]+")).alias("words"))


@R.add("SELECT event_id, nullif(regexp_extract(event_id, '^([a-z]+)_([0-9]+)$', 1), '') AS kind, try_cast(nullif(regexp_extract(event_id, '^([a-z]+)_([0-9]+)$', 2), '') AS BIGINT) AS number FROM " + _EV)
def st23_extract_fields(t):
    x = lambda k: F.nullif(F.regexp_extract("event_id", r"^([a-z]+)_([0-9]+)$", k), F.lit(""))
    return _events(t).select("event_id", x(1).alias("kind"), x(2).try_cast("bigint").alias("number"))


@R.add("SELECT event_id, event_date IS NULL AS missing, coalesce(event_date > TIMESTAMP '2025-06-30', false) AS after_reference, coalesce(event_date < TIMESTAMP '2000-01-01', false) AS before_2000, strftime(date_trunc('month', event_date), '%Y-%m-%d') AS month_start, strftime(date_trunc('month', event_date) + INTERVAL 3 MONTH, '%Y-%m') AS three_on FROM " + _EV)
def dt7_date_quality(t):
    d, lit = F.col("event_date"), lambda s: F.lit(s).cast("timestamp_ntz")
    m = F.trunc(F.to_date(d), "MM")
    return _events(t).select("event_id", d.isNull().alias("missing"), F.coalesce(d > lit("2025-06-30"), F.lit(False)).alias("after_reference"), F.coalesce(d < lit("2000-01-01"), F.lit(False)).alias("before_2000"), F.date_format(m, "yyyy-MM-dd").alias("month_start"), F.date_format(F.add_months(m, 3), "yyyy-MM").alias("three_on"))


@R.add("SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.25), 4) AS q25, round(quantile_cont(l_extendedprice, 0.75), 4) AS q75, round(avg(ln(1 + l_quantity)), 5) AS mean_log, round(avg(1 / (1 + exp(-l_discount))), 5) AS mean_sigmoid FROM lineitem GROUP BY 1")
def ma4_numeric(t):
    li = t("lineitem")
    q = quantiles(value_table(li, "l_returnflag", "l_extendedprice"), "l_returnflag", "l_extendedprice", {"q25": 0.25, "q75": 0.75})
    m = li.groupBy("l_returnflag").agg(F.round(F.avg(F.log1p("l_quantity")), 5).alias("mean_log"), F.round(F.avg(1 / (1 + F.exp(-F.col("l_discount")))), 5).alias("mean_sigmoid"))
    return q.join(m, "l_returnflag").select("l_returnflag", F.round("q25", 4).alias("q25"), F.round("q75", 4).alias("q75"), "mean_log", "mean_sigmoid")


@R.add("SELECT subject_code, array_to_string(list_sort(list_distinct(list_transform(string_split_regex(array_to_string(keywords, '; ') || ' ; ' || subject_name, '[;,|]'), lambda x: lower(trim(x))))), '|') AS items FROM subject_areas")
def js3_split_lists(t):
    x = F.split(F.concat(F.array_join("keywords", "; "), F.lit(" ; "), F.col("subject_name")), "[;,|]")
    return t("subject_areas").select("subject_code", F.array_join(F.array_sort(F.array_distinct(F.transform(x, lambda s: F.lower(F.trim(s))))), "|").alias("items"))


@R.add("SELECT event_type, (props::json->>'k')::bigint AS k, count(*) AS n FROM events GROUP BY ALL")
def js2_json_field(t):
    return t("events").select("event_type", F.from_json("props", "k bigint").getField("k").alias("k")).groupBy("event_type", "k").agg(F.count(F.lit(1)).alias("n"))


_KEY = "(('0x' || md5(doc_id::varchar || ':7')[1:15])::bigint)"


@R.add(f"SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY {_KEY}, doc_id) AS r FROM documents) WHERE r <= 20")
def sm7_per_source(t):
    """Twenty documents of each source by hash."""
    d = t("documents").select("source", "doc_id").withColumn("_k", sampling.key_of("doc_id", 7))
    return top_per_group(d, ["source"], ["_k", "doc_id"], 20).select("source", "doc_id")


@R.add("SELECT location_id, (count(*) FILTER (any_injury) * 3 + count(*) FILTER (is_open_task) + count(*) FILTER (is_overdue_task) * 2)::bigint AS signal FROM unified_event WHERE location_id IS NOT NULL GROUP BY 1 ORDER BY signal DESC, location_id LIMIT 50")
def ag12_weighted_signal(t):
    n = lambda c: F.count_if(F.col(c))
    return t("unified_event").where("location_id is not null").groupBy("location_id").agg((n("any_injury") * 3 + n("is_open_task") + n("is_overdue_task") * 2).alias("signal")).orderBy(F.desc("signal"), "location_id").limit(50)


@R.add("WITH p AS (SELECT DISTINCT unnest(regexp_extract_all(lower(location_name), '[\\p{L}]{3,}')) AS term FROM location_view) SELECT term, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_\\-/]{2,}')) AS term FROM documents) WHERE term NOT IN (SELECT term FROM p WHERE term IS NOT NULL) GROUP BY 1 HAVING count(*) >= 10")
def tx18_without_place_terms(t):
    """Frequent terms that are no words of place names: an anti-join against the names' distinct words."""
    p = t("location_view").select(F.explode(F.regexp_extract_all(F.lower("location_name"), F.lit(r"(\p{L}{3,})"), F.lit(1))).alias("term")).distinct()
    n = retrieval.term_counts(t("documents"), "doc_id", "text", up_to=1).groupBy("term").agg(F.sum("tf").alias("n")).where("n >= 10")
    return n.join(p, "term", "left_anti")


QUERIES, SQL = R.queries, R.sql
