"""Words and phrases: accents, stop words, stems, evidence, useful phrases; everything stays in the JVM but phrase lists."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value list: function words of the six languages of the corpus, without accents.
STOP_WORDS = tuple(sorted(set(
    "the and was were with that for from this are has have had not but its his her she him they them their there which when where who will would been into onto over under than then "
    "los las del por con para una que como mas pero sus este esta entre cuando muy sin sobre hasta hay donde desde todo nos fue era "
    "der die das und den von mit sich des auf fur ist dem nicht ein eine als auch werden aus hat dass sie nach wird bei einer noch wie einem uber einen zum war haben nur oder aber vor zur bis mehr durch "
    "les une est qui dans pour aux par sur pas plus cette avec son ses etait sont ete mais sans sous "
    "dos nas uma com foi ele ela seu sua quando muito ja tambem pelo pela ate isso depois mesmo "
    "на не что по как это из от так для же все до при был была было были его ее они мы или если уже бы под над после перед во со около".split()
)))
#: Fixed value list: longer suffixes before shorter ones, and the letters that must be left.
SUFFIXES, LEFT = ("ciones", "mente", "acion", "ments", "tion", "ing", "ed", "es", "s"), 4


def _folding() -> tuple[str, str]:
    """Small letters of the Latin and Cyrillic blocks that are a letter with a mark, and these letters."""
    pairs = [(c, b) for c in map(chr, [*range(0xC0, 0x250), *range(0x400, 0x500)]) if c == c.lower() and len(b := "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))) == 1 and b != c]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


MARKED, PLAIN = _folding()


def folded(c: Column) -> Column:
    """Lower case without accents."""
    return F.translate(F.lower(c), MARKED, PLAIN)


def normal(c: Column) -> Column:
    """Lower case without accents, web and mail addresses and numbers of up to four digits, single spaces."""
    t = F.regexp_replace(folded(c), r"https?://\S+|www\.\S+|[\w.-]+@[\w.-]+", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"\b[0-9]{1,4}\b", " "), r"\s+", " "))


def words(c: Column, stop: Sequence[str] = STOP_WORDS, least: int = 3) -> Column:
    """The words of a text in reading order: letters with inner hyphens, folded, no stop words, at least ``least`` letters,
    and not one letter over and over."""
    found = F.regexp_extract_all(folded(c), F.lit(r"([\p{L}][\p{L}-]*\p{L})"), F.lit(1))
    return F.filter(found, lambda w: (F.length(w) >= least) & ~w.isin(*stop) & ~w.rlike(r"^(.)\1+$"))


def stem(w: Column, suffixes: Sequence[str] = SUFFIXES, left: int = LEFT) -> Column:
    """A word without the first of the suffixes that fits, if enough letters are left."""
    out = w
    for s in reversed(suffixes):
        out = F.when(w.endswith(s) & (F.length(w) - len(s) >= left), F.substring(w, F.lit(1), F.length(w) - len(s))).otherwise(out)
    return F.when(F.length(w) <= left, w).otherwise(out)


def lemma(w: Column) -> Column:
    """Singular and base forms by rule: ies to y, then ing, ed, es and s are cut where enough is left."""
    n = F.length(w)
    cut = lambda k: F.substring(w, F.lit(1), n - k)
    plural = w.endswith("s") & ~w.endswith("ss") & ~w.endswith("us")
    return (
        F.when((n > 5) & w.endswith("ies"), F.concat(cut(3), F.lit("y"))).when((n > 5) & w.endswith("ing"), cut(3)).when((n > 5) & w.endswith("ed"), cut(2))
        .when((n > 5) & w.endswith("es"), cut(2)).when((n > 4) & plural, cut(1)).otherwise(w)
    )


def without_labels(c: Column, labels: Sequence[str]) -> Column:
    """Text without field labels: ``label:`` wherever it stands, in any letter case; single spaces."""
    union = "|".join(re.escape(x) for x in labels)
    return F.trim(F.regexp_replace(F.regexp_replace(c, rf"(?i)\b(?:{union})\s*:", " "), r"\s+", " "))


def distinct_sentences(c: Column, most: int) -> Column:
    """The different sentences of a text in order, compared in lower case, joined up to ``most`` characters."""
    ss = F.filter(F.transform(F.split(F.trim(F.regexp_replace(c, r"\s+", " ")), r"(?<=[.!?])\s+"), lambda s: F.trim(s)), lambda s: s != "")
    keys = F.transform(ss, lambda s: F.lower(s))
    once = F.filter(ss, lambda s, i: F.array_position(keys, F.lower(s)) == i + 1)
    return F.substring(F.array_join(once, " "), 1, most)


def evidence(c: Column, tag: str, around: int = 45) -> Column:
    """The first place of a tag in a text with ``around`` characters to both sides; null where it does not occur."""
    p = F.instr(F.lower(c), tag.lower())
    lo = F.greatest(F.lit(1), p - around)
    return F.when(p > 0, F.substring(c, lo, p + len(tag) + around - lo))


def evidences(c: Column, tags: Sequence[str], most: int = 4, around: int = 45) -> Column:
    """The evidence of the first ``most`` tags that occur; where none does, the beginning of the first sentence."""
    found = F.slice(F.array_compact(F.array(*[evidence(c, t, around) for t in tags])), 1, most)
    first = F.substring(F.get(F.split(F.trim(F.regexp_replace(c, r"\s+", " ")), r"(?<=[.!?])\s+"), F.lit(0)), 1, 180)
    return F.when(F.size(found) > 0, found).when(first != "", F.array(first)).otherwise(F.array().cast("array<string>"))


def useful(phrase: Column, least: int = 2) -> Column:
    """Whether a phrase has at least ``least`` words that are no stop words."""
    return F.size(words(phrase)) >= least


def friendly(c: Column, labels: Sequence[tuple[str, str]] = ()) -> Column:
    """A feature name for people: patterns of ``labels`` replaced in order, underscores as spaces, words with capitals."""
    for pattern, by in labels:
        c = F.regexp_replace(c, pattern, by)
    return F.initcap(F.trim(F.regexp_replace(F.regexp_replace(c, "_", " "), r"\s+", " ")))


def id_like(c: Column) -> Column:
    """Whether a name is a bare number."""
    return F.coalesce(F.trim(c).rlike(r"^\d+(?:\.0+)?$"), F.lit(False))


def distinct_phrases(phrases: Sequence[str], most: int, overlap: float = 0.8) -> list[str]:
    """Phrases in order of rank without repeats: of two that hold each other's words, or share ``overlap`` of either's, one
    stays, in the better place; it is the longer one if that holds all words of the other. Phrases that say a word twice
    in a row, or the same half twice, are left out. The list is bounded by what is ranked before."""
    kept: list[tuple[str, frozenset[str]]] = []
    for p in phrases:
        ws = re.findall(r"\w+", p.lower())
        half = len(ws) // 2
        if not ws or any(a == b for a, b in zip(ws, ws[1:])) or (len(ws) % 2 == 0 and ws[:half] == ws[half:]):
            continue
        own = frozenset(ws)
        for i, (_, other) in enumerate(kept):
            if other < own:
                kept[i] = (p, own)
                kept = [k for j, k in enumerate(kept) if j == i or not k[1] < own]
                break
            if len(own & other) >= overlap * min(len(own), len(other)):
                break
        else:
            if len(kept) < most:
                kept.append((p, own))
    return [p for p, _ in kept]
