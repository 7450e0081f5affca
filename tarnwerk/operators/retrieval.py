"""Vectors, TF-IDF, BM25 and their fusion: a stated set of queries against all rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnwerk.operators.lineage import cut
from tarnwerk.operators.topk import bags, best_by_terms
from tarnwerk.operators.windows import top_per_group

#: Query vectors held in memory at once; more are taken in blocks, each with its own pass over the rows.
QUERY_BLOCK = 4_096
K1, B = 1.5, 0.75


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays in double precision; 0 for a zero vector, null for null."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return F.coalesce(F.try_divide(dot(a, b), F.sqrt(dot(a, a) * dot(b, b))), F.when(a.isNotNull() & b.isNotNull(), 0.0))


def nearest(rows: DataFrame, queries: DataFrame, k: int, row_id: str, vector: str, query_id: str = "query_id", query_vector: str = "query_vector", block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, row_id, score, rank_no): the k rows of largest cosine per query, other than the row of its own id.

    Exact. Queries are held in blocks of bounded size; every Arrow batch of rows is one matrix product with a block and
    hands on its k best per query only, so the shuffle carries k rows per query and batch. Ties go to the smaller id.
    Rows or queries without a vector, or of another length than the block's first, match nothing.
    """
    spark = rows.sparkSession
    wanted = queries.where(F.col(query_vector).isNotNull()).orderBy(query_id)
    schema = f"query_id bigint, {row_id} bigint, score double"
    parts, ids, vecs = [], [], []

    def flush() -> None:
        q = np.array([v for v in vecs if len(v) == len(vecs[0])], dtype=np.float64)
        norm = np.linalg.norm(q, axis=1, keepdims=True)
        shared = spark.sparkContext.broadcast((np.array([i for i, v in zip(ids, vecs) if len(v) == len(vecs[0])]), q / np.where(norm > 0, norm, 1)))

        def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            qid, m = shared.value
            for b in batches:
                b = b[[v is not None and len(v) == m.shape[1] for v in b["_v"]]]
                if b.empty:
                    continue
                x = np.array(b["_v"].tolist(), dtype=np.float64)
                n = np.linalg.norm(x, axis=1, keepdims=True)
                s = m @ (x / np.where(n > 0, n, 1)).T
                rid = b["_id"].to_numpy()
                s[qid[:, None] == rid[None, :]] = -np.inf
                take = min(k, s.shape[1])
                order = np.lexsort((np.broadcast_to(rid, s.shape), -s), axis=1)[:, :take]
                got = np.take_along_axis(s, order, axis=1)
                out = pd.DataFrame({"query_id": np.repeat(qid, take), row_id: rid[order].ravel(), "score": got.ravel()})
                yield out[np.isfinite(out["score"])]

        parts.append(rows.select(F.col(row_id).cast("bigint").alias("_id"), F.col(vector).cast("array<double>").alias("_v")).mapInPandas(best, schema))

    for r in wanted.select(query_id, query_vector).toLocalIterator():
        ids.append(r[0])
        vecs.append([float(x) for x in r[1]])
        if len(ids) == block:
            flush()
            ids, vecs = [], []
    if ids:
        flush()
    if not parts:
        return spark.createDataFrame([], schema + ", rank_no int")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return top_per_group(out, ["query_id"], [F.desc("score"), row_id], k)


#: A term: letters of any script, figures, hyphens and slashes, two signs at least.
TERM = r"[\p{L}\p{N}_\-/]{2,}"


def grams(words: Column, up_to: int = 2) -> Column:
    """The words of an array and its runs of up to ``up_to`` words, each joined by a space."""

    def runs(n: int) -> Column:
        count = F.size(words) - (n - 1)
        at = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.array_join(F.slice(words, i, n), " "))

    return F.concat(words, *[runs(n) for n in range(2, up_to + 1)])


def term_counts(docs: DataFrame, doc_id: str, text: str, pattern: str = TERM, up_to: int = 2) -> DataFrame:
    """(doc_id, term, tf): terms of a text in lower case, and runs of up to ``up_to`` of them; documents without terms
    have no rows."""
    words = F.regexp_extract_all(F.lower(F.col(text)), F.lit(f"({pattern})"), F.lit(1))
    # The words are a column of their own, so they are found once.
    held = docs.select(F.col(doc_id), words.alias("_w")).where(F.size("_w") > 0)
    return held.select(doc_id, F.explode(grams(F.col("_w"), up_to)).alias("term")).groupBy(doc_id, "term").agg(F.count(F.lit(1)).alias("tf"))


def tf_idf(counts: DataFrame, doc_id: str, documents: int, min_df: int = 2, max_df: float = 0.95) -> DataFrame:
    """(doc_id, term, weight): (1 + ln tf) x (ln((1 + N) / (1 + df)) + 1), of unit length per document.

    Terms in fewer than min_df or more than max_df x N documents are left out. df has one row per term; the join on
    the term is by shuffle with adaptive splitting of frequent terms, which max_df keeps in bounds.
    """
    df = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df")).where((F.col("df") >= min_df) & (F.col("df") <= max_df * documents))
    w = counts.join(df, "term").select(doc_id, "term", ((1 + F.log("tf")) * (F.log((1.0 + documents) / (1 + F.col("df"))) + 1)).alias("w"))
    norm = w.groupBy(doc_id).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return w.join(norm, doc_id).select(doc_id, "term", (F.col("w") / F.col("norm")).alias("weight"))


def term_bags(docs: DataFrame, doc_id: str, text: str, pattern: str = TERM, up_to: int = 2) -> DataFrame:
    """(doc_id, terms): the same terms as often as they occur, one row per document; texts, not terms, are shuffled."""
    words = F.regexp_extract_all(F.lower(F.col(text)), F.lit(f"({pattern})"), F.lit(1))
    held = docs.select(F.col(doc_id), words.alias("_w")).where(F.size("_w") > 0).groupBy(doc_id).agg(F.collect_list("_w").alias("_w"))
    return held.select(doc_id, F.flatten(F.transform("_w", lambda w: grams(w, up_to))).alias("terms"))


def bag_counts(held: DataFrame, doc_id: str, out: str = "tf") -> DataFrame:
    """(doc_id, term, tf) of bags."""
    return held.select(doc_id, F.explode("terms").alias("term")).groupBy(doc_id, "term").agg(F.count(F.lit(1)).alias(out))


def bag_frequencies(held: DataFrame) -> DataFrame:
    """(term, df) of bags."""
    return held.select(F.explode(F.array_distinct("terms")).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def _bm25_terms(queries: DataFrame, frequencies: DataFrame, n_docs: Column, query_id: str, max_df: float) -> DataFrame:
    found = queries.join(frequencies, "term").where(F.col("df") <= max_df * n_docs)
    return found.select(query_id, "term", (F.log(1 + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5)) * (1 + F.log(1 + F.col("qtf")))).alias("weight"))


def bm25(counts: DataFrame, queries: DataFrame, doc_id: str, k: int, query_id: str = "query_id", k1: float = K1, b: float = B, max_df: float = 0.98) -> DataFrame:
    """(query_id, doc_id, score, rank_no): BM25 of query terms (query_id, term, qtf) against all documents.

    idf = ln(1 + (N - df + .5) / (df + .5)), query terms weigh 1 + ln(1 + qtf); positive scores only, the document of
    the query's own id excluded; ties by id. Statistics are of all documents. The queries' terms meet the documents in
    memory (``best_by_terms``), not in a row per query, document and term.
    """
    lens = counts.groupBy(doc_id).agg(F.sum("tf").alias("len"))
    n_docs, mean = lens.agg(F.count(F.lit(1)), F.avg("len")).first()
    terms = _bm25_terms(queries, counts.groupBy("term").agg(F.count(F.lit(1)).alias("df")), F.lit(n_docs), query_id, max_df)
    weight = F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("len") / F.lit(mean)))
    return best_by_terms(bags(counts.join(lens, doc_id).withColumn("_w", weight), doc_id, "_w"), terms, doc_id, k, query_id=query_id).where("score > 0")


def bm25_bags(held: DataFrame, wanted: Column, doc_id: str, k: int, k1: float = K1, b: float = B, max_df: float = 0.98) -> DataFrame:
    """``bm25`` of the documents of ``term_bags``, with those that are ``wanted`` as queries."""
    n_docs, mean = held.agg(F.count(F.lit(1)), F.avg(F.size("terms"))).first()
    queries = bag_counts(held.where(wanted).select(F.col(doc_id).alias("query_id"), "terms"), "query_id", "qtf")
    terms = _bm25_terms(queries, bag_frequencies(held), F.lit(n_docs), "query_id", max_df)
    rows = held.select(doc_id, "terms", (F.lit(k1) * (1 - b + b * F.size("terms") / F.lit(mean))).alias("x"))
    return best_by_terms(rows, terms, doc_id, k, lambda tf, x: tf * (k1 + 1) / (tf + x)).where("score > 0")


#: Terms with their idf that are broadcast; more are joined by shuffle, with the same result.
MAX_TERMS = 500_000


class TermVectors:
    """The weights of ``tf_idf`` by document, without a table of them: held are idf by term and norm by document, both cut,
    and weights are made anew from the texts for those documents that need them."""

    def __init__(self, docs: DataFrame, doc_id: str, text: str, min_df: int = 2, max_df: float = 0.95, max_terms: int = MAX_TERMS):
        documents = docs.count()
        self.doc_id, self.bags = doc_id, term_bags(docs, doc_id, text)
        df = bag_frequencies(self.bags).where((F.col("df") >= min_df) & (F.col("df") <= max_df * documents))
        self.idf = cut(df.select("term", (F.log((1.0 + documents) / (1 + F.col("df"))) + 1).alias("idf")))
        if self.idf.count() <= max_terms:
            self.idf = F.broadcast(self.idf)
        self.norms = cut(self._raw(self.bags).groupBy(doc_id).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm")))

    def _raw(self, held: DataFrame) -> DataFrame:
        return bag_counts(held, self.doc_id).join(self.idf, "term").select(self.doc_id, "term", "idf", ((1 + F.log("tf")) * F.col("idf")).alias("w"))

    def weights(self, ids: DataFrame) -> DataFrame:
        """(doc_id, term, weight, idf) of the documents whose ids are given."""
        some = self._raw(self.bags.join(ids.select(self.doc_id).distinct(), self.doc_id, "left_semi"))
        return some.join(self.norms, self.doc_id).select(self.doc_id, "term", (F.col("w") / F.col("norm")).alias("weight"), "idf")

    def nearest(self, queries: DataFrame, k: int) -> DataFrame:
        """(query_id, doc_id, score, rank_no): the k documents of largest cosine for each query_id, other than its own."""
        q = self.weights(queries.select(F.col("query_id").alias(self.doc_id))).select(F.col(self.doc_id).alias("query_id"), "term", (F.col("weight") * F.col("idf")).alias("weight"))
        rows = self.bags.join(self.norms, self.doc_id).select(self.doc_id, "terms", F.col("norm").alias("x"))
        return best_by_terms(rows, q, self.doc_id, k, lambda tf, x: (1 + np.log(tf)) / x)


def write_index(counts: DataFrame, path: str, doc_id: str, min_df: int = 2, max_df: float = 0.98) -> None:
    """A stored BM25 index under ``path``: postings partitioned by a hash of the term, lengths of documents and terms with
    their document frequencies. Terms in fewer than min_df or more than max_df of the documents are left out, as in a
    vocabulary; lengths count all terms."""
    lens = counts.groupBy(doc_id).agg(F.sum("tf").alias("len"))
    n = lens.count()
    df = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df")).where((F.col("df") >= min_df) & (F.col("df") <= max_df * n))
    bucket = F.pmod(F.xxhash64("term"), F.lit(64)).cast("int").alias("bucket")
    lens.write.mode("overwrite").parquet(f"{path}/lengths")
    df.write.mode("overwrite").parquet(f"{path}/terms")
    counts.join(df, "term").select("term", doc_id, "tf", "df", bucket).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings")


def search_index(spark, path: str, queries: DataFrame, doc_id: str, k: int, query_id: str = "query_id", k1: float = K1, b: float = B) -> DataFrame:
    """BM25 of a stored index for query terms (query_id, term, qtf); the same scores as ``bm25`` for the terms it holds. Only
    the buckets of query terms are read."""
    q = queries.withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(64)).cast("int"))
    lens = spark.read.parquet(f"{path}/lengths")
    stats = lens.agg(F.count(F.lit(1)).alias("n_docs"), F.avg("len").alias("mean_len"))
    hit = spark.read.parquet(f"{path}/postings").join(q, ["bucket", "term"]).where(F.col(query_id) != F.col(doc_id)).join(lens, doc_id).crossJoin(F.broadcast(stats))  # one row
    idf = F.log(1 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5)) * (1 + F.log(1 + F.col("qtf")))
    s = F.sum(idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("len") / F.col("mean_len"))))
    return top_per_group(hit.groupBy(query_id, doc_id).agg(F.round(s, 6).alias("score")).where("score > 0"), [query_id], [F.desc("score"), doc_id], k)


#: Names a mode of search goes by.
MODES = {"bm25": "bm25", "lexical": "bm25", "keyword": "bm25", "vector": "vector", "dense": "vector", "similarity": "vector", "hybrid": "hybrid", "rrf": "hybrid", "fusion": "hybrid"}


def search(mode: str, lexical, dense, keys: Sequence[str], top: int, pool: int = 75, k: int = 60) -> DataFrame:
    """One route of search: by words, by vectors, or both fused from pools of ``pool``. lexical and dense are functions of
    how many matches per query they are to give; only those the mode needs are called. An unknown mode is an error."""
    route = MODES.get(mode.strip().lower())
    if route is None:
        raise ValueError(f"no such mode of search: {mode}")
    if route != "hybrid":
        return (lexical if route == "bm25" else dense)(top)
    return fuse(lexical(pool), dense(pool), keys, k, top)


def fuse(a: DataFrame, b: DataFrame, keys: Sequence[str], k: int, top: int, group: str = "query_id") -> DataFrame:
    """Reciprocal-rank fusion of two ranked lists: the sum of 1 / (k + rank) over the places a row has in the lists."""
    both = a.select(*keys, "rank_no").unionByName(b.select(*keys, "rank_no"))
    scored = both.groupBy(*keys).agg(F.round(F.sum(F.lit(1.0) / (k + F.col("rank_no"))), 9).alias("fused"))
    return top_per_group(scored, [group], [F.desc("fused"), *[c for c in keys if c != group]], top)


def merge(lists: Sequence[DataFrame], keys: Sequence[str], top: int, group: str = "query_id") -> DataFrame:
    """Several result lists (keys, src, own) in one: a row found by more than one counts in the list of the least ``src``;
    lists follow each other, each by its own falling score, ``top`` rows per group."""
    out = lists[0]
    for x in lists[1:]:
        out = out.unionByName(x)
    once = out.groupBy(*keys).agg(F.min(F.struct("src", (-F.col("own")).alias("_s"))).alias("_m")).select(*keys, "_m.src", (-F.col("_m._s")).alias("own"))
    return top_per_group(once, [group], ["src", F.desc("own"), *[c for c in keys if c != group]], top)


def centroids(vectors: DataFrame, label: str, vector: str, weight: str | None = None) -> DataFrame:
    """(label, centroid): the weighted mean vector of each label, by sums per position; null vectors are left out."""
    w = F.col(weight) if weight else F.lit(1.0)
    long = vectors.where(F.col(vector).isNotNull()).select(label, w.alias("_w"), F.posexplode(vector).alias("_i", "_x"))
    mean = long.groupBy(label, "_i").agg((F.sum(F.col("_w") * F.col("_x").cast("double")) / F.sum("_w")).alias("_m"))
    return mean.groupBy(label).agg(F.transform(F.sort_array(F.collect_list(F.struct("_i", "_m"))), lambda x: x["_m"]).alias("centroid"))
