"""Language likelihoods of short texts: words first, character n-grams for words not seen.

The model is trained without labels: sentences with clear function words seed it, all sentences of the corpus are then
counted. Counts come from grouped aggregation over the whole corpus; the model keeps what is not rarer than a share of it.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwerk.llm.text import sentences, words
from tarnwerk.operators.lineage import cut

LANGS = ("en", "es", "de", "fr", "pt", "ru")
#: The model keeps what holds at least one in so many of all counts of its kind: so it has at most so many words, and
#: n-grams, per language, at any size of the corpus; what is rarer is told by the n-grams of its letters.
RAREST_WORD, RAREST_GRAM = 2_000_000, 400_000

#: Fixed value lists: common function words of each language.
FUNCTION_WORDS = {
    "en": "the of and to in is was were with that for on at by from this it he she they not be are had has have when while which an as no one or who will been would there their his her its after before during near behind under a as i if we you my me him them so then than do did does can could would should about into out up down over all any some got off back".split(),
    "es": "el la los las de del que y en un una se por con para su al lo como más pero sus le ya o este sí porque esta entre cuando muy sin sobre también hasta hay donde quien desde todo nos fue era está había hacia bajo durante si mi tu ser fue son han ha eran fueron otra otro cada".split(),
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man wurde beim unter gegen".split(),
    "fr": "le la les de des du et en un une est que qui dans pour au aux par sur pas plus ne se ce cette il elle son sa ses avec était sont ont été être mais ou où leur sans sous dès lors chez aucun aucune entre vers après avant pendant".split(),
    "pt": "o a os as de do da dos das que e em um uma no na nos nas para com por se não mais como mas foi ao ele ela seu sua ou quando muito já está eu também só pelo pela até isso era depois sem mesmo aos sob há estava foram durante".split(),
    "ru": "и в не на что с по как это но к из у за от о так для же все до при был была было были их его её она они мы он или если уже бы под над после перед во ко со около возле без между".split(),
}


#: Mail and web addresses are in no language.
_ADDRESS = re.compile(r"\S+\s?(?:@|\[at\]|\(at\))\s?\S+|https?://\S+|www\.\S+", re.IGNORECASE)


def grams(word: str) -> list[str]:
    """Character 2- to 4-grams of a word with its edges."""
    w = f"^{word}$"
    return [w[i : i + n] for n in (2, 3, 4) for i in range(len(w) - n + 1)]


class Model:
    """Log likelihoods per language of words and of character n-grams, in one table that grows by the words met."""

    MOST_NEW = 200_000

    def __init__(self, word_counts: dict[str, dict[str, int]], gram_counts: dict[str, dict[str, int]]):
        words_, grams_ = _logs(word_counts), _logs(gram_counts)
        self.index = {w: i for i, w in enumerate(words_, 1)}
        self.known = len(self.index)
        self.free = self.kept = self.known + 1
        self.table = np.zeros((len(words_) + 1024, len(LANGS)))
        if words_:
            self.table[1 : len(words_) + 1] = np.array(list(words_.values()))
        self.grams = grams_

    def _row(self, w: str) -> int:
        """Table row of a word not met so far: the sum of its n-grams; row 0 where they tell nothing."""
        parts = [self.grams[g] for g in grams(w) if g in self.grams] if self.grams else []
        row = 0
        if parts:
            row = self.free
            self.free += 1
            if row >= len(self.table):
                self.table = np.vstack([self.table, np.zeros_like(self.table)])
            # n-grams overlap: together they weigh as much as two words at most
            self.table[row] = np.sum(parts, axis=0) * min(1.0, 2.0 / len(parts))
        if len(self.index) < self.known + self.MOST_NEW:
            self.index[w] = row
            self.kept = self.free
        return row

    def score_all(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Of each list of words the log likelihoods in each language, up to a constant, and the words they rest on."""
        flat: list[int] = []
        ends = [0]
        get = self.index.get
        self.free = self.kept  # rows of words beyond MOST_NEW last for one call
        for ws in texts:
            rows_ = [get(w, -1) for w in ws]
            if -1 in rows_:
                rows_ = [self._row(w) if k < 0 else k for w, k in zip(ws, rows_)]
            flat += rows_
            ends.append(len(flat))
        rows = np.array(flat, dtype=np.int64)
        sums = np.vstack([np.zeros((1, len(LANGS))), np.cumsum(self.table[rows], axis=0)])
        told = np.concatenate([[0], np.cumsum(rows > 0)])
        at = np.array(ends)
        return sums[at[1:]] - sums[at[:-1]], told[at[1:]] - told[at[:-1]]

    def score(self, text: str) -> tuple[np.ndarray, int]:
        """The same for one text."""
        s, n = self.score_all([spoken(text)])
        return s[0], int(n[0])


def spoken(text: str) -> list[str]:
    """Words in lower case, without those of mail and web addresses, which are in no language."""
    if "@" in text or "[at]" in text or "(at)" in text or "://" in text or "www." in text:
        text = _ADDRESS.sub(" ", text)
    return words(text)


def _logs(counts: dict[str, dict[str, int]]) -> dict[str, np.ndarray]:
    totals = np.array([sum(counts.get(c, {}).values()) + 1.0 for c in LANGS])
    keys = sorted(set().union(*[counts.get(c, {}) for c in LANGS])) if counts else []
    size = max(1, len(keys))
    out = {}
    for k in keys:
        n = np.array([counts.get(c, {}).get(k, 0) for c in LANGS], dtype=float)
        v = np.log((n + 0.05) / (totals + 0.05 * size))
        out[k] = v - v.max()
    return out


def seed_model() -> Model:
    """A model of the function words alone, each shared word split among its languages."""
    return Model({c: {w: 20 for w in ws} for c, ws in FUNCTION_WORDS.items()}, {})


def leading(scores: np.ndarray, margin: float) -> np.ndarray:
    """Per row the most likely language, -1 where it does not lead by ``margin``."""
    two = np.sort(scores, axis=1)[:, -2:]
    return np.where(two[:, 1] - two[:, 0] >= margin, scores.argmax(axis=1), -1)


def guess(model: Model, text: str, margin: float = 0.0) -> int | None:
    """Index of the most likely language, if it leads by ``margin``; None for a text without evidence."""
    s, n = model.score(text)
    k = int(leading(s[None, :], margin)[0]) if n else -1
    return None if k < 0 else k


#: Rows of counts: what is counted, an item, its language (0 where that means nothing) and how often.
COUNTS = "kind string, item string, lang int, n bigint"


def count(texts: DataFrame, column: str, groups: Sequence[str] = (), margin: float = 10.0, extra: Callable[[list[list[str]], Counter], None] | None = None) -> DataFrame:
    """Counts of all texts in ``column``, by kind: ``w`` the words of each language, ``g0``, ``g1`` … the languages of the
    texts of each value of the columns ``groups``, and what ``extra`` adds to a counter of (kind, item) from the
    sentences of each text. One pass over the texts; the counts are cut, since several results are read off them.

    Sentences are labelled by their function words and counted if the best language leads by ``margin`` nats, that is
    by at least two such words. Null and empty texts add nothing. Counts are combined per partition and handed on
    before they grow beyond a bound, then summed by key.
    """
    seeds = texts.sparkSession.sparkContext.broadcast(seed_model())
    keys, many = [F.col(g).cast("string").alias(f"_g{i}") for i, g in enumerate(groups)], len(groups)

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ws = [Counter() for _ in LANGS]
        told: Counter = Counter()
        more: Counter = Counter()

        def frame() -> pd.DataFrame:
            rows = [("w", w, k, n) for k in range(len(LANGS)) for w, n in ws[k].items()]
            rows += [(*g, n) for g, n in told.items()] + [(kind, item, 0, n) for (kind, item), n in more.items()]
            return pd.DataFrame(rows, columns=["kind", "item", "lang", "n"])

        for b in batches:
            cut_up = [sentences(t) for t in b["t"]]
            parts = [spoken(s) for p in cut_up for s in p]
            s, _ = seeds.value.score_all(parts)
            for k, words_ in zip(leading(s, margin).tolist(), parts):
                if k >= 0:
                    ws[k].update(words_)
            if extra is not None:
                extra(cut_up, more)
            if many:
                at = np.cumsum([0, *map(len, cut_up)])
                cum = np.vstack([np.zeros((1, len(LANGS))), np.cumsum(s, axis=0)])
                whole = leading(cum[at[1:]] - cum[at[:-1]], margin).tolist()
                for k, *g in zip(whole, *[b[f"_g{i}"] for i in range(many)]):
                    if k >= 0:
                        told.update((f"g{i}", x, k) for i, x in enumerate(g) if x is not None)
            if len(more) + len(told) + sum(map(len, ws)) > 400_000:
                yield frame()
                for c in (*ws, told, more):
                    c.clear()
        yield frame()

    rows = texts.select(F.col(column).alias("t"), *keys).where(F.length("t") > 0).mapInPandas(tally, COUNTS)
    return cut(rows.groupBy("kind", "item", "lang").agg(F.sum("n").alias("n")))


def model_of(counts: DataFrame) -> Model:
    """The model of counted words (an action): words that hold at least one in RAREST_WORD of the words of a language,
    and two of them; the n-grams of these words that hold one in RAREST_GRAM. Without any text the function words remain."""
    words_ = counts.where("kind = 'w'")
    least = {r.lang: max(2.0, r.n / RAREST_WORD) for r in words_.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    by_word: dict[str, dict[str, int]] = {c: {w: 1 for w in ws} for c, ws in FUNCTION_WORDS.items()}
    by_gram: dict[str, Counter] = {c: Counter() for c in LANGS}
    often = F.lit(False)
    for lang, n in least.items():
        often = often | ((F.col("lang") == lang) & (F.col("n") >= n))
    for lang, item, n in words_.where(often).select("lang", "item", "n").toPandas().itertuples(index=False):
        by_word[LANGS[lang]][item] = int(n)
        for g in grams(item):
            by_gram[LANGS[lang]][g] += int(n)
    kept = {c: {g: n for g, n in gs.items() if n * RAREST_GRAM >= gs.total()} for c, gs in by_gram.items()}
    return Model(by_word, kept)


def train(texts: DataFrame, column: str, margin: float = 10.0) -> Model:
    """A model of all texts in ``column`` (actions: one pass over the texts, and its bounded counts come to the driver)."""
    return model_of(count(texts, column, margin=margin))


_CYRILLIC, _LATIN, _LETTER = re.compile("[\u0400-\u04ff]"), re.compile("[A-Za-z\u00c0-\u024f]"), re.compile(r"[^\W\d_]")


def script_of(text: str) -> str | None:
    """The script of most letters of a text: ``latin``, ``cyrillic`` or ``other``; None without letters."""
    n = len(_LETTER.findall(text))
    if not n:
        return None
    if text.isascii() or 2 * len(_LATIN.findall(text)) > n:
        return "latin"
    return "cyrillic" if 2 * len(_CYRILLIC.findall(text)) > n else "other"


def script_due(lang: int) -> str:
    """The script a language is written in."""
    return "cyrillic" if LANGS[lang] == "ru" else "latin"


def posterior(log_likelihood: np.ndarray, log_prior: np.ndarray) -> np.ndarray:
    """Normalised probabilities."""
    v = log_likelihood + log_prior
    v = np.exp(v - v.max())
    return v / v.sum()


def entropy(p: np.ndarray) -> float:
    return float(-sum(x * math.log(x) for x in p if x > 0))
