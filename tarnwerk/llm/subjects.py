"""Subject areas of documents (problem 10): interpolated n-gram language models against a background model.

A sentence deals with a subject if the subject's model needs fewer nats per token for it than the background model.
The models start from hand-labelled documents and are then re-estimated over the whole corpus, whose documents carry
sentences in languages and words that no label covers. A document has a subject if two of its sentences deal with it.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from tarnwerk.llm.text import sentences
from tarnwerk.operators.lineage import cut

#: Labelled documents the first models are fitted and calibrated on, at most; and documents with the keywords of a subject
#: that has no label. The bound of what comes to the driver.
MAX_LABELLED = 5_000
#: Parts of the labelled documents: the first thresholds are calibrated on each part by models fitted on the others.
FOLDS = 3
#: A model keeps what holds at least one in so many of all its counts: so it has at most so many n-grams, at any size of
#: the corpus. What is rarer is told by the unigram of its word, or as an unknown word.
RAREST = 1_000_000
#: and is met more than once.
MIN_COUNT = 1.5
#: Sentences whose judgement a worker remembers; then it begins anew.
REMEMBERED = 300_000
#: Relative frequency of a history at which its words and the unigrams weigh the same.
KAPPA = 0.001
#: Rounds of re-estimation on the labelled documents.
LABELLED_ROUNDS = 4
MIN_SENTENCES = 2
#: Passes of re-estimation over all documents; True: whole documents count for their subjects. On 10,000 documents these
#: three differ in 1.4 % of the rows from four alternating passes of the first models, none at all in 15 %.
PASSES = (True, True, False)
#: Thresholds tried when acceptance is calibrated, in nats per token.
GRID = tuple(round(0.04 * k, 2) for k in range(1, 21))
DEFAULT_THRESHOLD = 0.2
_TOKEN = re.compile(r"[^\W_]+(?:['’-][^\W_]+)*")
_NUMBER = re.compile(r"\d+")


def tokens(sentence: str) -> list[str]:
    """Words in lower case, numbers as 0, after a mark for the beginning."""
    return ["<s>", *_TOKEN.findall(_NUMBER.sub("0", sentence.lower()))]


def read(text: str | None) -> list[str]:
    """The sentences of a text, each as its tokens with a space between them."""
    return [" ".join(tokens(s)) for s in sentences(text)] if text else []


def count_ngrams(ws: Sequence[str], into: Counter, weight: float = 1.0) -> None:
    for a, b in zip(ws, ws[1:]):
        into[b] += weight
        into[a, b] += weight


class Models:
    """One interpolated bigram model per subject, the background last; all probabilities looked up together."""

    def __init__(self, subjects: Sequence[str], counts: Sequence[Counter], thresholds: Sequence[float] | None = None):
        self.subjects = list(subjects)
        self.limits = list(thresholds) if thresholds is not None else [DEFAULT_THRESHOLD] * len(self.subjects)
        self.memo: dict[str, tuple[int, float]] = {}
        k = len(counts)
        word: dict[str, int] = {}
        pair: dict[tuple[str, str], int] = {}
        hist: dict[str, int] = {}
        at: list[tuple[list[int], list[int], list[float]]] = [([], [], []), ([], [], [])]
        for i, c in enumerate(counts):
            for g, n in c.items():
                one = isinstance(g, str)
                ids = word if one else pair
                x = ids.get(g)
                if x is None:
                    x = ids[g] = len(ids)
                    if not one:
                        hist.setdefault(g[0], len(hist))
                rows, cols, values = at[not one]
                rows.append(x)
                cols.append(i)
                values.append(n)
        uni, two, history = np.zeros((len(word), k)), np.zeros((len(pair), k)), np.zeros((len(hist), k))
        for m, (rows, cols, values) in zip((uni, two), at):
            m[np.array(rows, dtype=int), np.array(cols, dtype=int)] = values
        first = np.array([hist[g[0]] for g in pair], dtype=int)
        np.add.at(history, first, two)
        total = np.maximum(uni.sum(axis=0), 1.0)
        # Unigrams lean on the uniform distribution by one count per word of the vocabulary, shared out evenly.
        flat = 0.02 / (len(word) + 1)
        p_uni = 0.98 * uni / total + flat
        rel = history / total
        weight = rel / (rel + KAPPA)
        known = np.vstack([p_uni, np.full((1, k), flat)])
        second = np.array([word.get(g[1], len(word)) for g in pair], dtype=int)
        p_two = weight[first] * two / np.maximum(history[first], 1e-9) + (1 - weight[first]) * known[second]
        # One table of rows: nothing, an unknown word, words, histories to fall back from, pairs.
        self.table = np.vstack([np.zeros((1, k)), np.full((1, k), math.log(flat)), np.log(p_uni), np.log(1 - weight), np.log(p_two)])
        self.word = {w: i + 2 for w, i in word.items()}
        self.back = {h: i + 2 + len(word) for h, i in hist.items()}
        self.pair = {g: i + 2 + len(word) + len(hist) for g, i in pair.items()}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"memo": {}}

    def gains(self, sentences_: Sequence[Sequence[str]]) -> np.ndarray:
        """Of each sentence and subject, the nats per token the subject's model saves against the background; -1 for
        sentences of under two words."""
        one: list[int] = []
        two: list[int] = []
        ends = [0]
        pair, word, back = self.pair.get, self.word.get, self.back.get
        for ws in sentences_:
            for g in zip(ws, ws[1:]):
                r = pair(g)
                if r is None:
                    one.append(word(g[1], 1))
                    two.append(back(g[0], 0))
                else:
                    one.append(r)
                    two.append(0)
            ends.append(len(one))
        at = np.array(ends)
        t = self.table[np.array(one, dtype=np.int64)] + self.table[np.array(two, dtype=np.int64)]
        cum = np.vstack([np.zeros((1, self.table.shape[1])), np.cumsum(t, axis=0)])
        n = at[1:] - at[:-1]
        s = (cum[at[1:]] - cum[at[:-1]]) / np.maximum(n, 1)[:, None]
        return np.where((n >= 2)[:, None], s[:, :-1] - s[:, -1:], -1.0)

    def judge(self, docs: Sequence[Sequence[str]]) -> list[list[tuple[int, float]]]:
        """Of each sentence of each document (as ``read`` gives them) the best subject and its gain. A sentence met
        before, in any document, is not looked up again."""
        if not self.subjects:
            return [[] for _ in docs]
        known = self.memo
        if len(known) > REMEMBERED:
            known.clear()
        new = list(dict.fromkeys(s for d in docs for s in d if s not in known))
        if new:
            g = self.gains([s.split(" ") for s in new])
            best = g.argmax(axis=1)
            known.update(zip(new, zip(best.tolist(), g[np.arange(len(g)), best].tolist())))
        return [[known[s] for s in d] for d in docs]

    def own(self, judged: Sequence[tuple[int, float]]) -> list[int]:
        """The subjects of a document: at least two sentences gain more than the threshold."""
        limit = self.limits
        hits = Counter(k for k, g in judged if g > limit[k])
        return sorted(k for k, n in hits.items() if n >= MIN_SENTENCES)

    def subjects_of(self, text: str | None) -> list[str]:
        return [self.subjects[k] for k in self.own(self.judge([read(text)])[0])] if self.subjects else []

def fit_labelled(subjects: Sequence[str], rows: Sequence[tuple[str, Sequence[str]]], rounds: int = LABELLED_ROUNDS) -> Models:
    """Models of labelled documents, rows of (text, subject codes).

    At first every sentence counts for all subjects of its document, and all sentences for the background. Then each
    sentence goes to the one subject of its document that gains most over the background, or to the background.
    """
    at = {s: i for i, s in enumerate(subjects)}
    docs = [([tokens(s) for s in sentences(t)], [at[c] for c in codes if c in at]) for t, codes in rows if t]
    if not any(own for _, own in docs):
        return Models(subjects, [Counter() for _ in range(len(subjects) + 1)])
    counts = [Counter() for _ in range(len(subjects) + 1)]
    for ss, own in docs:
        for ws in ss:
            for k in own:
                count_ngrams(ws, counts[k], 1 / len(own))
            count_ngrams(ws, counts[-1])
    models = Models(subjects, counts)
    for r in range(rounds):
        counts = [Counter() for _ in range(len(subjects) + 1)]
        for ss, own in docs:
            for ws, g in zip(ss, models.gains(ss)):
                k = max(own, key=lambda i: g[i]) if own else -1
                least = 0.05 if r == 0 else 0.1
                count_ngrams(ws, counts[k if own and g[k] > least else -1])
        models = Models(subjects, counts)
    return models


def calibrate(models: Models, rows: Sequence[tuple[str, Sequence[str]]], judged: Sequence[Sequence[tuple[int, float]]] | None = None) -> Models:
    """The thresholds of best F1 per subject on labelled documents; of equal ones the middle. A subject that none of them
    has keeps DEFAULT_THRESHOLD. judged: their sentences' subjects and gains, where other models than ``models`` gave them."""
    judged = models.judge([read(t) for t, _ in rows]) if judged is None else judged
    for k, code in enumerate(models.subjects):
        # Of each document the second greatest gain of the subject: above the threshold it is accepted.
        second = [(sorted((g for j, g in js if j == k), reverse=True) + [-9.0] * MIN_SENTENCES)[MIN_SENTENCES - 1] for js in judged]
        true = [code in codes for _, codes in rows]
        f1 = []
        for x in GRID:
            tp = sum(g > x and t for g, t in zip(second, true))
            wrong = sum((g > x) != t for g, t in zip(second, true))
            f1.append(2 * tp / (2 * tp + wrong) if tp else 0.0)
        top = [x for x, f in zip(GRID, f1) if f >= max(f1) - 1e-9]
        models.limits[k] = top[len(top) // 2] if max(f1) > 0 else DEFAULT_THRESHOLD
    return models


def fit_held_out(subjects: Sequence[str], rows: Sequence[tuple[str, Sequence[str]]], folds: int = FOLDS) -> Models:
    """Models fitted on all labelled documents, with thresholds calibrated on documents that were held out: each fold is
    judged by models of the others."""
    judged: list = [None] * len(rows)
    for f in range(folds):
        models = fit_labelled(subjects, [r for i, r in enumerate(rows) if i % folds != f])
        at = range(f, len(rows), folds)
        for i, js in zip(at, models.judge([read(rows[i][0]) for i in at])):
            judged[i] = js
    return calibrate(fit_labelled(subjects, rows), rows, judged)


def sentence_rows(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ss): the sentences of each document as tokens, cut: all passes read them, and only this one the texts."""

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b["ss"] = [read(t) for t in b.pop("_text")]
            yield b

    schema = documents.select(key).schema.add("ss", ArrayType(StringType()))
    return cut(documents.select(key, F.col(text).alias("_text")).where(F.length("_text") > 0).mapInPandas(split, schema))


def _estimate(rows: DataFrame, models: Models, whole: bool) -> list[Counter]:
    """n-gram counts per subject and of the background over all documents (rows of sentence_rows), by grouped aggregation.

    whole: all sentences of a document count for its subjects, and for the background; otherwise each sentence counts
    for its own subject, where the document has that, or else for the background. Of each model what is at least one in
    RAREST of its counts comes to the driver.
    """
    shared = rows.sparkSession.sparkContext.broadcast(models)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        last = len(m.subjects)
        # How often a sentence counts for a model, and shared among how many: equal sentences are taken apart once.
        total: Counter = Counter()
        for b in batches:
            docs = b["ss"].tolist()
            for ss, judged in zip(docs, m.judge(docs)):
                own = m.own(judged)
                if whole:
                    total.update((s, j, len(own)) for s in ss for j in own)
                    total.update((s, last, 1) for s in ss)
                else:
                    total.update((s, k if k in own and g > 0.5 * m.limits[k] else last, 1) for s, (k, g) in zip(ss, judged))
            # The counts are handed on before they grow beyond a bound.
            if len(total) > 100_000:
                yield _frame(total)
                total.clear()
        yield _frame(total)

    counted = rows.select("ss").mapInPandas(count, "k int, a string, b string, n double")
    sums = cut(counted.groupBy("k", "a", "b").agg(F.sum("n").alias("n")))
    out = [Counter() for _ in range(len(models.subjects) + 1)]
    often = F.lit(False)
    for r in sums.groupBy("k").agg(F.sum("n").alias("n")).collect():
        often = often | ((F.col("k") == r.k) & (F.col("n") >= max(MIN_COUNT, r.n / RAREST)))
    for k, a, b, n in sums.where(often).toPandas().itertuples(index=False):
        out[k][b if a is None else (a, b)] = n
    return out


def _frame(total: Counter) -> pd.DataFrame:
    one: Counter = Counter()
    for (s, k, share), n in total.items():
        ws = s.split(" ")
        n = n / share
        for a, b in zip(ws, ws[1:]):
            one[k, None, b] += n
            one[k, a, b] += n
    return pd.DataFrame([(*g, n) for g, n in one.items()], columns=["k", "a", "b", "n"])


def labelled_rows(documents: DataFrame, labels: DataFrame, subjects: Sequence[str], limit: int = MAX_LABELLED) -> list[tuple[str, list[str]]]:
    """(text, codes) of at most ``limit`` labelled documents, chosen by a hash of their id (an action)."""
    one = labels.where(F.col("doc_id").isNotNull() & F.col("subject_code").isin(*subjects)).groupBy("doc_id").agg(F.sort_array(F.collect_set("subject_code")).alias("codes")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    rows = documents.select("doc_id", "text").join(F.broadcast(one), "doc_id").where(F.length("text") > 0).orderBy("doc_id").collect()
    return [(r.text, list(r.codes)) for r in rows]


def train(documents: DataFrame, areas: DataFrame, labels: DataFrame, rows: DataFrame | None = None, passes: Sequence[bool] = PASSES) -> Models:
    """Models fitted on labelled documents (fit_held_out), then re-estimated over all documents in ``passes``. No label takes
    part in re-estimation, so each pass is calibrated on all labelled documents. rows: the documents' sentence_rows.

    A subject without any label starts from documents with its keywords instead, MAX_LABELLED at most.
    """
    hints = {r.subject_code: [k.lower() for k in r.keywords or []] for r in areas.where(F.col("subject_code").isNotNull()).select("subject_code", "keywords").collect()}
    subjects = sorted(hints)
    labelled = labelled_rows(documents, labels, subjects)
    missing = [s for s in subjects if not any(s in codes for _, codes in labelled)]
    for s in missing:
        words = [w for w in hints[s] if w]
        if words:
            hit = F.lower("text").rlike("|".join(rf"\b{re.escape(w)}\b" for w in words))
            labelled += [(r.text, [s]) for r in documents.where(hit).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED).select("text").collect()]
    models = fit_held_out(subjects, labelled)
    rows = sentence_rows(documents) if rows is None else rows
    for whole in passes:
        models = calibrate(Models(subjects, _estimate(rows, models, whole)), labelled)
    return models


def find_subjects(documents: DataFrame, areas: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, subject_code): the subjects of each document, none, one or more.

    Null and empty texts have none; whole texts are read; a repeated document gives its own rows. Without any subject
    area the result is empty.
    """
    rows = sentence_rows(documents)
    models = train(documents, areas, labels, rows)
    shared = documents.sparkSession.sparkContext.broadcast(models)

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for b in batches:
            found = [(d, m.subjects[k]) for d, judged in zip(b["doc_id"], m.judge(b["ss"].tolist())) for k in m.own(judged)] if m.subjects else []
            yield pd.DataFrame(found, columns=["doc_id", "subject_code"])

    schema = documents.select("doc_id").schema.add("subject_code", "string")
    return rows.mapInPandas(find, schema)
