"""Text vectors, retrieval, fusion, clustering and metrics; names begin with operator handles.

Searches take every row whose id is divisible by 100 as a query, against all rows.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tarnwerk.functions.scalars import rounded
from tarnwerk.operators import learning, metrics, retrieval
from tarnwerk.operators.windows import top_per_group
from tarnwerk.plans._register import Register

R = Register()
_TC = "(SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(a || list_transform(range(1, len(a)), lambda i: a[i] || ' ' || a[i + 1])) AS term FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_\\-/]{2,}') AS a FROM documents)) GROUP BY ALL)"


def counts(t):
    return retrieval.term_counts(t("documents"), "doc_id", "text")


@R.add(_TC[1:-1])
def tx1_term_counts(t):
    return counts(t)


_TFIDF = f"""
WITH c AS {_TC}, n AS (SELECT count(*) AS n FROM documents), d AS (SELECT term, count(*) AS df FROM c GROUP BY 1 HAVING count(*) >= 2 AND count(*) <= 0.95 * (SELECT n FROM n)),
w AS (SELECT doc_id, term, (1 + ln(tf)) * (ln((1.0 + (SELECT n FROM n)) / (1 + df)) + 1) AS w FROM c JOIN d USING (term)),
v AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM w)
"""


def weights(t):
    docs = t("documents")
    return retrieval.tf_idf(counts(t), "doc_id", docs.count())


@R.add(_TFIDF + "SELECT doc_id, term, round(weight, 6) AS weight FROM v")
def tx1_tf_idf(t):
    return weights(t).select("doc_id", "term", F.round("weight", 6).alias("weight"))


@R.add(_TFIDF + "SELECT source, term, score, r::int AS rank_no FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY score DESC, term) AS r FROM (SELECT source, term, round(sum(weight) / any_value(n), 5) AS score FROM v JOIN documents USING (doc_id) JOIN (SELECT source, count(*) AS n FROM documents GROUP BY 1) USING (source) GROUP BY ALL)) WHERE r <= 10")
def tx3_top_terms(t):
    """Terms of largest mean weight per source."""
    docs = t("documents").where("source is not null").select("doc_id", "source")
    n = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    s = weights(t).join(docs, "doc_id").groupBy("source", "term").agg(F.sum("weight").alias("w")).join(F.broadcast(n), "source")  # one row per source
    return top_per_group(s.select("source", "term", F.round(F.col("w") / F.col("n"), 5).alias("score")), ["source"], [F.desc("score"), "term"], 10)


@R.add("WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]{2,}') AS a FROM documents), b AS (SELECT unnest(list_transform(range(1, len(a)), lambda i: a[i] || ' ' || a[i + 1])) AS term FROM w WHERE len(a) > 1) SELECT term, count(*) AS n FROM b GROUP BY 1 HAVING count(*) >= 2 ORDER BY n DESC, term LIMIT 50")
def tx5_bigrams(t):
    a = F.regexp_extract_all(F.lower("text"), F.lit("([a-z0-9]{2,})"), F.lit(1))
    w = t("documents").select(a.alias("a")).where("size(a) > 1")
    pairs = F.zip_with(F.slice("a", F.lit(1), F.size("a") - 1), F.slice("a", F.lit(2), F.size("a") - 1), lambda x, y: F.concat_ws(" ", x, y))
    return w.select(F.explode(pairs).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")).where("n >= 2").orderBy(F.desc("n"), "term").limit(50)


_BM25 = f"""
WITH c AS {_TC}, l AS (SELECT doc_id, sum(tf) AS len FROM c GROUP BY 1), s AS (SELECT count(*) AS n, avg(len) AS m FROM l),
d AS (SELECT term, count(*) AS df FROM c GROUP BY 1), q AS (SELECT doc_id AS query_id, term, tf AS qtf FROM c WHERE doc_id % 100 = 0),
h AS (SELECT query_id, c.doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * (1 + ln(1 + qtf)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len / m))), 6) AS score FROM q JOIN d USING (term) JOIN c USING (term) JOIN l ON l.doc_id = c.doc_id CROSS JOIN s WHERE df <= 0.98 * n AND query_id <> c.doc_id GROUP BY ALL),
bm AS (SELECT query_id, doc_id, score, rank_no FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)::int AS rank_no FROM h WHERE score > 0) WHERE rank_no <= 10)
"""


def bm25(t, k: int = 10):
    return retrieval.bm25_bags(retrieval.term_bags(t("documents"), "doc_id", "text"), F.col("doc_id") % 100 == 0, "doc_id", k)


@R.add(_BM25 + "SELECT query_id, doc_id, round(score, 3) AS score FROM bm")
def tx8_bm25(t):
    return bm25(t).select("query_id", "doc_id", rounded(F.col("score"), 3).alias("score"))


_KNN = """
WITH q AS (SELECT vec_id AS query_id, embedding AS v FROM embeddings WHERE vec_id % 100 = 0),
kn AS (SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::int AS rank_no FROM (SELECT query_id, vec_id, list_cosine_similarity(embedding::double[], v::double[]) AS score FROM embeddings, q WHERE vec_id <> query_id)),
knn AS (SELECT * FROM kn WHERE rank_no <= 10)
"""


def knn(t, k: int = 10):
    e = t("embeddings")
    return retrieval.nearest(e, e.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector")), k, "vec_id", "embedding")


@R.add(_KNN + "SELECT query_id, vec_id, round(score, 5) AS score, rank_no FROM knn")
def tx9_nearest(t):
    return knn(t).select("query_id", "vec_id", F.round("score", 5).alias("score"), "rank_no")


@R.add(_KNN + "SELECT query_id, arg_max(label, (w, -label)) AS voted FROM (SELECT query_id, label, round(sum(score), 5) AS w FROM knn JOIN embeddings USING (vec_id) GROUP BY ALL) GROUP BY 1")
def ag33_weighted_vote(t):
    """The label of the largest sum of scores among the neighbours; ties to the smaller label."""
    v = knn(t).join(t("embeddings").select("vec_id", "label"), "vec_id").groupBy("query_id", "label").agg(F.round(F.sum("score"), 5).alias("w"))
    return v.groupBy("query_id").agg(F.max_by("label", F.struct("w", -F.col("label"))).alias("voted"))


_L2 = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY fused DESC, doc_id)::int AS rank_no FROM (SELECT query_id, doc_id, round(sum(1.0 / (60 + rank_no)), 9) AS fused FROM (SELECT query_id, doc_id, rank_no FROM bm UNION ALL SELECT query_id, doc_id, rank_no FROM near) GROUP BY ALL)) WHERE rank_no <= 10"


@R.add(_BM25 + ", near AS (SELECT * FROM (SELECT a.doc_id AS query_id, b.doc_id, row_number() OVER (PARTITION BY a.doc_id ORDER BY abs(a.n_chars - b.n_chars), b.doc_id)::int AS rank_no FROM documents a JOIN documents b ON a.doc_id <> b.doc_id AND a.doc_id % 100 = 0 AND abs(a.n_chars - b.n_chars) <= 5) WHERE rank_no <= 10)" + f"SELECT query_id, doc_id, fused FROM ({_L2})")
def tx10_rank_fusion(t):
    """BM25 fused with a second ranking, by nearness in length within five characters. Of the documents of one length only
    those of the eleven smallest ids can be among a query's ten nearest others."""
    docs = t("documents").select("doc_id", "n_chars")
    first = docs.where("doc_id is not null").withColumn("_r", F.dense_rank().over(Window.partitionBy("n_chars").orderBy("doc_id"))).where("_r <= 11").drop("_r")
    q = docs.where("doc_id % 100 = 0").select(F.col("doc_id").alias("query_id"), F.explode(F.sequence(F.col("n_chars") - 5, F.col("n_chars") + 5)).alias("n_chars"), F.col("n_chars").alias("len"))
    near = q.join(first, "n_chars").where("query_id <> doc_id").withColumn("far", F.abs(F.col("n_chars") - F.col("len")))
    near = top_per_group(near, ["query_id"], ["far", "doc_id"], 10)
    return retrieval.fuse(bm25(t), near, ["query_id", "doc_id"], 60, 10).select("query_id", "doc_id", "fused")


@R.add("SELECT label, pos::int AS pos, round(avg(x), 5) AS mean FROM (SELECT label, unnest(embedding::double[]) AS x, unnest(range(len(embedding))) AS pos FROM embeddings) GROUP BY ALL")
def ma3_centroids(t):
    c = retrieval.centroids(t("embeddings"), "label", "embedding")
    return c.select("label", F.posexplode("centroid").alias("pos", "m")).select("label", "pos", F.round("m", 5).alias("mean"))


@R.add("WITH c AS (SELECT label AS nearest, list(m ORDER BY pos) AS centroid FROM (SELECT label, pos, avg(x) AS m FROM (SELECT label, unnest(embedding::double[]) AS x, unnest(range(len(embedding))) AS pos FROM embeddings) GROUP BY ALL) GROUP BY 1), s AS (SELECT vec_id, nearest, list_cosine_similarity(embedding::double[], centroid) AS score FROM embeddings, c) SELECT vec_id, nearest, round(score, 4) AS score FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, nearest) AS r FROM s) WHERE r = 1")
def j18_nearest_centroid(t):
    """Each vector with its nearest centroid: the centroids, one per label, are a broadcast array."""
    c = retrieval.centroids(t("embeddings"), "label", "embedding")
    all_c = c.agg(F.sort_array(F.collect_list(F.struct(F.col("label").alias("nearest"), "centroid"))).alias("cs"))
    e = t("embeddings").crossJoin(F.broadcast(all_c))  # one row
    scored = F.transform("cs", lambda x: F.struct(retrieval.cosine(F.col("embedding"), x["centroid"]).alias("score"), (-x["nearest"]).alias("neg")))
    return e.select("vec_id", F.array_max(scored).alias("b")).select("vec_id", (-F.col("b.neg")).alias("nearest"), F.round("b.score", 4).alias("score"))


@R.add("WITH c AS (SELECT label, list(m ORDER BY pos) AS v FROM (SELECT label, pos, avg(x) AS m FROM (SELECT label, unnest(embedding::double[]) AS x, unnest(range(len(embedding))) AS pos FROM embeddings) GROUP BY ALL) GROUP BY 1) SELECT a.label AS a, b.label AS b, round(list_cosine_similarity(a.v, b.v), 5) AS similarity FROM c a JOIN c b ON a.label < b.label")
def j12_theme_similarity(t):
    """Similarity of each pair of themes: of the centroids, as many as labels, not of records."""
    c = retrieval.centroids(t("embeddings"), "label", "embedding")
    a, b = c.select(F.col("label").alias("a"), F.col("centroid").alias("x")), c.select(F.col("label").alias("b"), F.col("centroid").alias("y"))
    return a.join(F.broadcast(b), F.col("a") < F.col("b")).select("a", "b", F.round(retrieval.cosine(F.col("x"), F.col("y")), 5).alias("similarity"))


@R.add("SELECT user_id, count(*) FILTER (event_type = 'click') AS click, count(*) FILTER (event_type = 'view') AS view, round(sum(value) FILTER (event_type = 'purchase'), 4) AS purchase_value FROM events GROUP BY 1")
def j19_pivot_wide(t):
    e = t("events")
    return e.groupBy("user_id").agg(F.count_if(F.col("event_type") == "click").alias("click"), F.count_if(F.col("event_type") == "view").alias("view"), F.round(F.sum(F.when(F.col("event_type") == "purchase", F.col("value"))), 4).alias("purchase_value"))


@R.add("SELECT event_type, round(avg((props IS NOT NULL AND json_valid(props))::int), 6) AS valid_rate, round(avg((json_extract(props, '$.k') IS NOT NULL)::int), 6) AS has_k, sum(json_extract(props, '$.k')::bigint)::bigint AS k_sum FROM events GROUP BY 1")
def ag40_json_validity(t):
    k = F.get_json_object("props", "$.k")
    return t("events").groupBy("event_type").agg(F.round(F.avg(F.expr("try_parse_json(props) is not null").cast("double")), 6).alias("valid_rate"), F.round(F.avg(k.isNotNull().cast("double")), 6).alias("has_k"), F.sum(k.cast("bigint")).alias("k_sum"))


_LAB = "(SELECT l_orderkey, l_linenumber, (l_returnflag = 'R')::int AS y, round((l_quantity * (1 - l_discount)) / 50, 4) AS s FROM lineitem)"


def scored(t):
    return t("lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"), (F.col("l_returnflag") == "R").cast("int").alias("y"), F.round(F.col("l_quantity") * (1 - F.col("l_discount")) / 50, 4).alias("s"))


@R.add(f"WITH x AS {_LAB}, g AS (SELECT s, sum(y) AS pos, sum(1 - y) AS neg FROM x GROUP BY 1), c AS (SELECT *, coalesce(sum(pos) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ap, coalesce(sum(neg) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS an FROM g) SELECT round(sum(neg * (ap + pos / 2)) / (sum(pos) * sum(neg)), 6) AS roc_auc, round(sum(pos * (ap + pos) / (ap + pos + an + neg)) / sum(pos), 6) AS average_precision, round(sum(pos * (1 - s) ** 2 + neg * s ** 2) / sum(pos + neg), 6) AS brier, sum(pos) FILTER (s >= 0.5)::bigint AS tp, sum(neg) FILTER (s >= 0.5)::bigint AS fp, (sum(pos) - sum(pos) FILTER (s >= 0.5))::bigint AS fn, (sum(neg) - sum(neg) FILTER (s >= 0.5))::bigint AS tn FROM c")
def ml11_metrics(t):
    return metrics.summary(scored(t), "y", "s", 0.5)


@R.add("SELECT 'l_quantity' AS feature, round(corr(l_quantity, l_extendedprice), 6) AS correlation FROM lineitem UNION ALL SELECT 'l_discount', round(corr(l_discount, l_extendedprice), 6) FROM lineitem UNION ALL SELECT 'l_tax', round(corr(l_tax, l_extendedprice), 6) FROM lineitem")
def ml13_correlation(t):
    return metrics.correlations(t("lineitem"), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice")


@R.add()
def ml1_kmeans(t):
    """Cosine k-means of the embeddings with the cosine to the own centre."""
    e = learning.kmeans(learning.vectors(t("embeddings"), "embedding"), 10)
    return e.select("vec_id", "cluster", F.round("confidence", 4).alias("confidence"))


@R.add()
def ml2_pca(t):
    return learning.reduce_pca(learning.vectors(t("embeddings"), "embedding"), 4).select("vec_id", F.transform("reduced", lambda x: F.round(F.abs(x), 4)).alias("reduced"))


@R.add()
def ml6_silhouette(t):
    """Cosine silhouette of k-means for a sweep of k."""
    x = learning.vectors(t("embeddings"), "embedding").persist()
    rows = [(k, round(learning.silhouette(learning.kmeans(x, k, max_iter=5)), 4)) for k in (5, 10, 15)]
    x.unpersist()
    return x.sparkSession.createDataFrame(rows, "k int, silhouette double")


@R.add()
def ml5_agglomerate(t):
    """Themes of the labels' centroids."""
    c = retrieval.centroids(t("embeddings"), "label", "embedding").join(t("embeddings").groupBy("label").agg(F.count(F.lit(1)).alias("n")), "label")
    themes = learning.agglomerate([(r.label, r.centroid, r.n) for r in c.orderBy("label").collect()], 0.9)  # one row per label
    return c.sparkSession.createDataFrame(sorted(themes.items()), "label int, theme int")


@R.add()
def ml9_classifier(t):
    """A balanced logistic model of returned lines with its metrics on the newest fifth."""
    from tarnwerk.operators import sampling

    x = t("lineitem").select("l_shipdate", "l_quantity", "l_extendedprice", "l_discount", "l_linestatus", (F.col("l_returnflag") == "R").cast("int").alias("y"))
    parts = sampling.newest(x, "l_shipdate", 0.2)
    train = learning.balanced(parts.where("part = 'train'"), "y")
    prep = learning.preprocess(["l_quantity", "l_extendedprice", "l_discount"], ["l_linestatus"]).fit(train)
    model = learning.classifier("logistic", "y").fit(prep.transform(train))
    from pyspark.ml.functions import vector_to_array

    out = model.transform(prep.transform(parts.where("part = 'test'"))).select("y", F.round(vector_to_array("probability")[1], 4).alias("p"))
    return metrics.summary(out, "y", "p", 0.5)


QUERIES, SQL = R.queries, R.sql
