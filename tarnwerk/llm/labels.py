"""Missing or wrong language labels (problem 6): Bayesian fusion of text, declared label and place.

log posterior = log likelihood of the text + log P(label | language) + log P(language | place). The place prior is
hierarchically smoothed: a location leans on its locale, the locale on the whole, by counts of grouped aggregation.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwerk.llm import langid
from tarnwerk.llm.langid import LANGS, Model
from tarnwerk.llm.text import sentences
from tarnwerk.operators.joins import lookup_join
from tarnwerk.operators.lineage import cut

#: Names of languages; those beyond the six name another language.
NAMES = {
    "en": "en eng english englisch inglés ingles inglês anglais английский",
    "es": "es spa esp spanish español espanol castellano spanisch espagnol espanhol испанский",
    "de": "de deu ger german deutsch alemán aleman allemand alemão немецкий",
    "fr": "fr fra fre french français francais französisch francés francês французский",
    "pt": "pt por portuguese português portugues portugiesisch portugués portugais португальский",
    "ru": "ru rus russian русский ruso russisch russe russo",
}
OTHER_NAMES = "it ita italian nl nld dut dutch pl pol polish sv swe swedish da dan danish cs ces cze czech tr tur turkish zh zho chi chinese ja jpn japanese ko kor korean ar ara arabic uk ukr ukrainian ro ron rum romanian ca cat catalan hi hin hindi".split()
#: P(label | language of the text): the label is right, names another language, or names none.
LABEL_RIGHT, LABEL_WRONG = 0.85, 0.15 / (len(LANGS) - 1)
#: Counts that a level lends to the level below it.
SMOOTHING = 20.0
#: Log cost of a change of language between two sentences.
SWITCH = 6.0
MIN_WORDS = 5
#: A record of one language counts as wrongly labelled from this confidence on.
SURE = 0.9


def label_code(label: str | None) -> str | None:
    """Language of a label in any usual spelling: a code, ``other``, or None where it names no language."""
    t = (label or "").strip().lower().replace("_", "-")
    head = t.split("-")[0] if "-" in t and len(t.split("-")[0]) in (2, 3) else t
    for code, names in NAMES.items():
        if head in names.split():
            return code
    return "other" if head in OTHER_NAMES else None


def runs(like: np.ndarray, log_prior: np.ndarray) -> list[tuple[int, float, int, int]]:
    """Maximal runs of one language (language, confidence, first row, end row) by the best path through the sentences,
    rows of log likelihoods."""
    best = like.argmax(axis=1)
    if (best == best[0]).all():
        p = langid.posterior(like.sum(axis=0), log_prior)
        k = int(p.argmax())
        return [(k, float(p[k]), 0, len(like))]
    n = len(LANGS)
    move = np.full((n, n), -SWITCH)
    np.fill_diagonal(move, 0.0)
    at, back = like[0] + log_prior, []
    for row in like[1:]:
        step = at[:, None] + move
        back.append(step.argmax(axis=0))
        at = step.max(axis=0) + row
    path = [int(at.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    path.reverse()
    out, lo = [], 0
    for k, same in groupby(path):
        hi = lo + len(list(same))
        p = langid.posterior(like[lo:hi].sum(axis=0), log_prior)
        out.append((k, float(p[k]), lo, hi))
        lo = hi
    return out


def place_priors(counts: DataFrame) -> tuple[list[float], DataFrame]:
    """The log prior of all, and (place, prior) of each place, from counts (kind g0, item = place and locale, lang, n).

    Hierarchically smoothed by grouped aggregation: a place leans on its locale, the locale on all. An action brings the
    six sums of all to the driver; places and locales stay in the cluster.
    """
    told = counts.where("kind = 'g0'").select(F.split_part("item", F.lit("\t"), F.lit(1)).alias("place"), F.split_part("item", F.lit("\t"), F.lit(2)).alias("locale"), "lang", "n")
    top = np.ones(len(LANGS))
    for r in told.groupBy("lang").agg(F.sum("n").alias("n")).collect():
        top[r.lang] += r.n
    top /= top.sum()
    each = lambda: F.array(*[F.sum(F.when(F.col("lang") == k, F.col("n")).otherwise(0)).cast("double") for k in range(len(LANGS))])

    def lean(own: Column, on: Column) -> Column:
        total = F.aggregate(own, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(own, on, lambda x, y: (x + F.lit(SMOOTHING) * y) / (total + F.lit(SMOOTHING)))

    of_all = F.array(*[F.lit(float(x)) for x in top])
    locales = told.where("locale != ''").groupBy("locale").agg(each().alias("_l")).select("locale", lean(F.col("_l"), of_all).alias("_on"))
    places = told.where("place != ''").groupBy("place").agg(F.min("locale").alias("locale"), each().alias("_p")).join(locales, "locale", "left")
    smoothed = lean(F.col("_p"), F.coalesce("_on", of_all))
    return np.log(top).tolist(), places.select("place", F.transform(smoothed, lambda x: F.log(x)).alias("prior"))


RUN_SCHEMA = "table_name string, record_id string, label_code string, is_english boolean, seg_no int, lang_code string, confidence double, runs int, words int"


def detect(rows: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per record and run of one language, with its confidence.

    rows: table_name, record_id, text, label, is_english, place, locale. Null, empty and wordless texts give no rows.
    Very long texts are read whole. The label and the place only weigh in where the text leaves doubt. Two passes over
    the texts, which are cut first: one counts words per language and languages per place, one finds the runs. The
    prior of its place is joined to each row (lookup_join).
    """
    rows = cut(rows.select("table_name", "record_id", "text", "label", "is_english", "place", "locale").where(F.length("text") > 0))
    counts = langid.count(rows.withColumn("where", F.concat(F.coalesce("place", F.lit("")), F.lit("\t"), F.coalesce("locale", F.lit("")))), "text", ("where",))
    top, priors = place_priors(counts)
    shared = rows.sparkSession.sparkContext.broadcast((model or langid.model_of(counts), top))
    rows = lookup_join(rows.drop("locale"), priors, "place")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, top = shared.value
        codes = {c: i for i, c in enumerate(LANGS)}
        said = np.full((len(LANGS), len(LANGS)), np.log(LABEL_WRONG))
        np.fill_diagonal(said, np.log(LABEL_RIGHT))
        known: dict = {}
        for b in batches:
            parts: list[list[str]] = []
            ends = [0]
            for t in b["text"]:
                parts += [langid.spoken(s) for s in sentences(t)]
                ends.append(len(parts))
            score, told = model.score_all(parts)
            size = np.array([len(ws) for ws in parts] or [0])
            out = []
            for i, (name, rid, label, english, of_place) in enumerate(zip(b["table_name"], b["record_id"], b["label"], b["is_english"], b["prior"])):
                lo, hi = ends[i], ends[i + 1]
                keep = told[lo:hi] > 0
                if not keep.any():
                    continue
                if label not in known:
                    known[label] = label_code(label)
                code = known[label]
                prior = np.array(top if of_place is None else of_place)
                if code in codes:
                    prior = prior + said[codes[code]]
                found = runs(score[lo:hi][keep], prior)
                n = int(size[lo:hi].sum())
                out += [(name, rid, code, english, j, LANGS[k], conf, len(found), n) for j, (k, conf, _, _) in enumerate(found, 1)]
            yield pd.DataFrame(out, columns=["table_name", "record_id", "label_code", "is_english", "seg_no", "lang_code", "confidence", "runs", "words"])

    return rows.select("table_name", "record_id", "text", "label", "is_english", "prior").mapInPandas(run, RUN_SCHEMA)


def wrong_labels(detected: DataFrame) -> DataFrame:
    """The runs of the records whose label is missing, wrong or contradicted, or that mix languages. A missing label
    needs no certainty; a filled one is only contradicted by a run of confidence SURE."""
    contrary = F.col("is_english").isNotNull() & (F.col("is_english") != (F.col("lang_code") == "en"))
    contradicted = (F.col("confidence") >= SURE) & ((F.col("label_code") != F.col("lang_code")) | contrary)
    return detected.where((F.col("words") >= MIN_WORDS) & ((F.col("runs") > 1) | F.col("label_code").isNull() | contradicted))
