"""Personal information inside free text (problem 3): bootstrapped contextual extraction.

Identifiers of fixed shape (mail addresses, telephone numbers, two public number formats, streets with a house number,
names after a title) are the seeds. The words around them become patterns; patterns and instances form a graph that
Spark scores in turns: a pattern is as good as the share of known instances it meets, an instance as good as the
patterns it is met in. Patterns and name words of high confidence then find the rest.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarnwerk.operators.lineage import cut

TYPES = ("email", "phone", "identity_no", "street_address", "person_name")
ROUNDS = 3
#: Patterns need this share of known instances, and this many different ones; instances this score.
PATTERN_SHARE, PATTERN_SUPPORT, INSTANCE_SCORE = 0.5, 3, 0.6
#: A name word stands in the middle of a sentence with a capital in this share of its uses: words that have theirs from
#: the beginning of a sentence or a heading, and those mostly written small, are none.
MIDDLE_SHARE = 0.25
#: Lower confidence bound of the share of good patterns among all that a name word is met in, and its number of deviations.
NAME_SHARE, DEVIATIONS = 0.25, 1.0
#: A model of at most so many entries is broadcast whole. Of a larger one each part of the texts gets the entries that it
#: can look up, by a join: the finds are the same.
MAX_ENTRIES = 1_000_000
#: Texts in a part: two to the power of this.
PART_BITS = 10

EMAIL = re.compile(r"(?<![\w.+@-])[\w.+-]+(?:@|\s?[\[(]\s?at\s?[\])]\s?)[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z0-9-]*[A-Za-z0-9](?![\w@])", re.IGNORECASE)
PHONE = re.compile(
    r"(?<![\w#+/.-])(?<!\d )(?:\+\d{1,3}[\s.-]?(?:\(0\)[\s.-]?)?(?:\(\d{2,4}\)|\d{1,4})(?:[\s./-]?\d{2,8}){1,4}|00[1-9]\d?[\s.-]?(?:\(0\)[\s.-]?)?\d{1,4}(?:[\s./-]?\d{2,8}){1,4}"
    r"|\+\d{9,14}|(?:1[-.\s])?(?:\(\d{3}\)\s?|\d{3}[-.\s])\d{3}[-.\s]\d{4}|0\d{2,4}/\d{3,8}(?:-\d{1,5})?|0\d{1,4}[\s-]\d{3,4}[\s-]\d{3,5}|0\d{2,4}\s\d{5,8}(?:[\s-]\d{2,4})?)(?![\w/]|[-.]\d|\s\d)"
)
#: Two public formats of personal numbers seed the rest: 3-2-4 digits, and two letters, six digits and a letter.
ID_SEED = re.compile(r"(?<![\w#/.-])(?<!\d )(?:\d{3}([- ])\d{2}\1\d{4}|[A-Z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-D])(?![\w/]|-\w|[ .]\d)", re.IGNORECASE)
ID_SHAPE = re.compile(r"(?<![\w#/.-])(?<!\d )(?:[A-Z]{1,3}[- ]?)?\d(?:[ -]?\d){4,12}(?:-?[A-Z]{1,3}|\s[A-Z])?(?![\w/]|-\w)")

_W = r"[^\W\d_][^\W\d_]*(?:['’-][^\W\d_]+)*"
#: Fixed value lists: words for kinds of streets.
_SUFFIX = r"(?:street|st|road|rd|lane|ln|avenue|ave|close|drive|dr|way|court|ct|place|pl|square|sq|crescent|terrace|boulevard|blvd|row|walk|hill|gardens?|grove|mews|alley|parkway)"
_COMPOUND = r"[^\W\d_]{3,}(?:straße|strasse|str|weg|allee|gasse|platz|ring|ufer|damm|steig|pfad|chaussee)\.?"
_PREFIX = r"(?:calle|c/|avenida|avda\.?|plaza|paseo|camino|carrera|ronda|travesía|rue|avenue|boulevard|place|chemin|allée|impasse|rua|praça|travessa|alameda|largo|ул\.|улица|проспект|переулок|via)"
_LINK = r"(?:de la|de las|de los|del|de|la|las|los|el|du|des|da|do|das|dos|der|den|am|an der|im|zum|zur)"
STREET_SEED = re.compile(
    rf"(?<![\w#./-])(?:\d{{1,4}}[A-Za-z]?\s(?:{_W}\s){{1,3}}?{_SUFFIX}\b(?:(?<=\bst)\.|(?<=\b(?:rd|ln|dr))\.(?=,)|(?<=\bave)\.(?=,))?|{_COMPOUND}\s\d{{1,4}}(?:\s?[a-z])?\b(?![\w.-]*\d)|{_PREFIX}\s(?:{_LINK}\s)?(?:{_W}\s){{1,3}}?\d{{1,4}}\b)",
    re.IGNORECASE,
)
_C = r"[A-ZÀ-ÞА-ЯЁ][^\W\d_]+(?:['’-][^\W\d_]+)*"
STREET_SHAPE = re.compile(rf"(?<![\w#./-])(?:\d{{1,4}}[A-Za-z]?\s(?:{_C}\s){{0,3}}?{_C}|(?:{_C}\s)(?:{_LINK}\s)?(?:{_C}\s){{0,2}}?\d{{1,4}}[A-Za-z]?\b)")
_STREET_WORD = re.compile(rf"^(?:{_SUFFIX}|{_PREFIX})\.?$", re.IGNORECASE)
#: Fixed value list: titles before a name.
TITLES = set("mr mrs ms miss mx dr prof herr frau hr fr sr sra señor señora don doña monsieur madame mme m senhor senhora г-н г-жа".split())
_TOKEN = re.compile(r"\x00[A-Z]\x00|[^\W_]+(?:['’-][^\W_]+)*|[^\s\w]|_")
_WORD = re.compile(_W)
_NUMBER = re.compile(r"\d+")

#: Cheap signs without which the expressions above cannot match.
_AT = re.compile(r"@|[\[(]\s?at\s?[\])]", re.IGNORECASE)
_ANY_DIGIT = re.compile(r"\d")
_DIGITS = re.compile(r"\d\D{0,3}\d\D{0,3}\d\D{0,3}\d\D{0,3}\d")
_CAPITALS = re.compile(r"[A-ZÀ-ÞА-ЯЁ][a-zß-ÿа-яё'’-]+,? [A-ZÀ-ÞА-ЯЁ]|[A-ZÀ-ÞА-ЯЁ]\. ?[A-ZÀ-ÞА-ЯЁ][a-zß-ÿа-яё]")
_NUMBERED = re.compile(r"[A-ZÀ-ÞА-ЯЁ][^\W\d_]+(?:['’-][^\W\d_]+)* \d|\d[A-Za-z]? [A-ZÀ-ÞА-ЯЁ]")
_STREET_WORDS = set("street st road rd lane ln avenue ave close drive dr way court ct place pl square sq crescent terrace boulevard blvd row walk hill garden gardens grove mews alley parkway calle c avenida avda plaza paseo camino carrera ronda travesía rue chemin allée impasse rua praça travessa alameda largo ул улица проспект переулок via".split())
_STREET_ENDS = ("straße", "strasse", "str", "weg", "allee", "gasse", "platz", "ring", "ufer", "damm", "steig", "pfad", "chaussee")
_LETTERS = re.compile(r"[^\W\d_]+")


def _has_street(words: set[str]) -> bool:
    return not _STREET_WORDS.isdisjoint(words) or any(w.endswith(_STREET_ENDS) for w in words)


def spans_of_shape(text: str) -> list[tuple[int, int, str]]:
    """Mail addresses and telephone numbers with their places; a later find never overlaps an earlier one."""
    out: list[tuple[int, int, str]] = []
    digits = _DIGITS.search(text) is not None
    for kind, pattern in (("email", EMAIL), ("identity_no", ID_SEED), ("phone", PHONE)):
        if not (digits if kind != "email" else _AT.search(text)):
            continue
        for m in pattern.finditer(text):
            if kind == "phone" and sum(c.isdigit() for c in m.group()) < 9:
                continue
            if all(m.end() <= a or b <= m.start() for a, b, _ in out):
                out.append((m.start(), m.end(), kind))
    return out


def _around(text: str, a: int, b: int, taken: list[tuple[int, int, str]]) -> tuple[list[str], list[str]]:
    """Two tokens before and after a span in lower case; finds of fixed shape as their type, digits as 0."""

    def side(lo: int, hi: int) -> list[str]:
        part = []
        at = lo
        for s, e, kind in sorted(taken):
            if lo <= s and e <= hi:
                part.append(_NUMBER.sub("0", text[at:s].lower()))
                part.append(f" \x00{kind[0].upper()}\x00 ")
                at = e
        part.append(_NUMBER.sub("0", text[at:hi].lower()))
        return _TOKEN.findall("".join(part))

    lo, hi = max(0, a - 80), min(len(text), b + 80)
    for s, e, _ in taken:  # never cut a find in half
        if s < lo < e:
            lo = s
        if s < hi < e:
            hi = e
    left, right = side(lo, a)[-3:], side(b, hi)[:2]
    if text[b : b + 1] == " " and text[b + 1 : b + 2].isupper() and not text[b + 1 : b + 3].isupper():
        right = ["^C"] + right[1:]
    return ["^"] * (3 - len(left)) + left, right + ["$"] * (2 - len(right))


BOUNDARY = set("^.!?;>)-/|,$") | {"\x00E\x00", "\x00P\x00", "\x00I\x00"}


def patterns(left: list[str], right: list[str]) -> list[str]:
    """The lexical patterns of a context: two words before with one after, one before with two after, three
    and two before."""
    l3, l2, l1 = left
    three = f"{l3} {l2} {l1}_"
    two = f"{l2} {l1}_"
    # A capital right after may begin a new sentence or go on with a name: it tells nothing.
    if l1 in BOUNDARY:  # what stands at the beginning of a sentence is told by what follows only
        three = two = ""
    both = [] if right[0] == "^C" else [f"{l2} {l1}_{right[0]}", f"{l1}_{right[0]} {right[1]}"]
    return [p for p in (*both, three, two) if p]


def name_spans(text: str, taken: list[tuple[int, int, str]], names: frozenset[str] = frozenset()) -> list[tuple[int, int, tuple[str, ...]]]:
    """Spans of the shapes ``A B``, ``A M. B``, ``B, A``, ``A. B`` and ``A B.`` with their words in lower case, outside of
    finds. Every word has a capital, is one of ``names`` or is a lone letter."""
    free = []
    for m in _WORD.finditer(text):
        w = m.group()
        free.append((m.start(), m.end(), w, len(w) == 1 or w[0].isupper() or w.lower() in names))
    if taken:
        free = [x for x in free if all(x[1] <= s or e <= x[0] for s, e, _ in taken)]
    out = []
    for k in range(len(free) - 1):
        if not (free[k][3] and free[k + 1][3]):
            continue
        (a, b, one, _), (c, d, two, _) = free[k], free[k + 1]
        gap = text[b:c]
        last = free[k + 2] if k + 2 < len(free) else None
        if gap == " " and last and len(two) == 1 and text[d : last[0]] == ". " and len(one) > 2 and len(last[2]) > 2 and last[2][0].isupper() and one[0].isupper():
            out.append((a, last[1], (one.lower(), last[2].lower())))  # with an initial between
        if gap and not gap.strip(" "):
            if len(two) == 1 and text[d : d + 1] == "." and len(one) > 2 and text[d + 1 : d + 2] in ("", " ", ",", ")", "\n", ";", "<", "|", "."):
                out.append((a, d + 1, (one.lower(),)))
            elif len(one) > 2 and len(two) > 2:
                out.append((a, d, (one.lower(), two.lower())))
        elif gap == ", " and len(one) > 2 and len(two) > 2:
            out.append((a, d, (one.lower(), two.lower())))
        elif gap in (". ", ".") and len(one) == 1 and len(two) > 2:
            out.append((a, d, (two.lower(),)))
    return out


def _capital(text: str) -> bool:
    """Whether every word begins with a capital and goes on in lower case."""
    ws = _WORD.findall(text)
    return all(w[0].isupper() and w[1:] == w[1:].lower() for w in ws)


def candidates(text: str) -> Iterator[tuple[str, str, str, int]]:
    """(kind, pattern, instance, seed) of everything in a text that has the shape of an identifier."""
    taken = spans_of_shape(text)
    seen: list[tuple[int, int]] = []
    capitals = False

    def links(kind: str, a: int, b: int, inst: str, seed: int) -> Iterator[tuple[str, str, str, int]]:
        left, right = _around(text, a, b, taken)
        for p in patterns(left, right):
            yield kind, p, inst, seed

    for s, e, kind in taken:
        if kind == "identity_no":
            yield from links("identity_no", s, e, re.sub(r"\W", "", text[s:e].lower()), 1)
    for m in ID_SHAPE.finditer(text) if _DIGITS.search(text) else ():
        if all(m.end() <= s or e <= m.start() for s, e, _ in taken):
            yield from links("identity_no", m.start(), m.end(), re.sub(r"\W", "", m.group().lower()), 0)
    for m in STREET_SEED.finditer(text) if _has_street(set(_LETTERS.findall(text.lower()))) else ():
        if all(m.end() <= s or e <= m.start() for s, e, _ in taken) and _street_case(m.group()) and not m.group().isupper():
            seen.append(m.span())
            yield from links("street_address", *m.span(), re.sub(r"\d+\w?", "", m.group().lower()).strip(), 1)
    for m in STREET_SHAPE.finditer(text) if _NUMBERED.search(text) else ():
        if all(m.end() <= s or e <= m.start() for s, e in [*seen, *[t[:2] for t in taken]]) and _street_case(m.group()):
            yield from links("street_address", *m.span(), re.sub(r"\d+\w?", "", m.group().lower()).strip(), 0)
    mails = {w for s, e, k in taken if k == "email" for w in re.findall(r"[a-z]{4,}", re.split(r"@|[\[(]", text[s:e].lower())[0])}
    for a, b, ws in name_spans(text, taken) if _CAPITALS.search(text) else ():
        if _capital(text[a:b]) and all(b <= s or e <= a for s, e in seen):
            before = _TOKEN.findall(text[max(0, a - 12) : a].lower())
            title = bool(before) and (before[-1] in TITLES or (before[-1] == "." and len(before) > 1 and before[-2] in TITLES))
            for w in ws:  # the words of names recur more often than whole names
                yield from links("person_name", a, b, w, int(title))
            capitals = True
    if capitals:
        yield from case_links(text, taken)
    for w in mails:
        yield "mail_word", "", w, 1


def case_links(text: str, taken: list[tuple[int, int, str]]) -> Iterator[tuple[str, str, str, int]]:
    """Of each word that is not all in capitals, how it is written: with a capital in the ``middle`` of a sentence, with
    one at its ``begin``, or ``small``. Words inside finds tell nothing."""
    for m in _WORD.finditer(text):
        w = m.group()
        a = m.start()
        if len(w) < 3 or w.isupper() or any(s <= a < e for s, e, _ in taken):
            continue
        if w[0].isupper():
            before = text[max(0, a - 3) : a]
            yield "case", "middle" if before.endswith((" ", "-", "(", "'")) and before.strip() and before.rstrip()[-1] not in "^.!?;>)-/|:•*+–—" and "\n" not in before else "begin", w.lower(), 0
        else:
            yield "case", "small", w.lower(), 0


def _street_case(s: str) -> bool:
    """Whether a street is written like a name: its first and last word with a capital, and more than a kind of street."""
    ws = [w for w in re.findall(_W, s) if w.lower() not in ("de", "la", "las", "los", "del", "el", "du", "des", "da", "do", "der", "den", "am", "an", "im", "zum", "zur")]
    if re.match(r"\d+[A-Za-z]\s", s) and ws and len(ws[0]) == 1:
        ws = ws[1:]
    if not ws or not all(w[0].isupper() for w in ws):
        return False
    return not all(_STREET_WORD.match(w) for w in ws)


LINKS = "kind string, pattern string, instance string, seed int, n bigint"
#: What an identifier cannot do without: tested in the JVM, so that other texts never reach Python. Each of the finds of
#: ``candidates`` asks for one of these signs itself, so the graph is the same with and without the test.
SIGN = "|".join((r"@|[\[(]\s?[aA][tT]\s?[\])]", _DIGITS.pattern, _CAPITALS.pattern, _NUMBERED.pattern))


def link_graph(texts: DataFrame, column: str) -> DataFrame:
    """The pattern-instance graph of all texts: one row per kind, pattern and instance with its count. Rows of kind
    ``case`` count how the words of texts with two capitals in a row are written."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c: Counter = Counter()
        for b in batches:
            for t in b["t"]:
                c.update(candidates(t))
            if len(c) > 200_000:
                yield pd.DataFrame([(*k, n) for k, n in c.items()], columns=["kind", "pattern", "instance", "seed", "n"])
                c = Counter()
        yield pd.DataFrame([(*k, n) for k, n in c.items()], columns=["kind", "pattern", "instance", "seed", "n"])

    rows = texts.select(F.col(column).alias("t")).where(F.col("t").rlike("(?U)" + SIGN)).mapInPandas(emit, LINKS)
    return rows.groupBy("kind", "pattern", "instance").agg(F.max("seed").alias("seed"), F.sum("n").alias("n"))


def proper_words(links: DataFrame) -> DataFrame:
    """The words that are written with a capital in the middle of sentences in MIDDLE_SHARE of their uses."""
    middle = F.sum(F.when(F.col("pattern") == "middle", F.col("n")).otherwise(0))
    return links.where(F.col("kind") == "case").groupBy("instance").agg(middle.alias("m"), F.sum("n").alias("n")).where(F.col("m") >= MIDDLE_SHARE * F.col("n")).select("instance")


def score(links: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """(patterns, instances) of high confidence: kind, pattern, share, good; kind, instance, n, all.

    Seeds score 1; words of mail addresses are seeds of name words. In each round a pattern scores the share of its different instances that are known, and an instance
    the chance that not all of its good patterns are wrong. Of name words only the proper ones take part. Every step is a grouped aggregation over the graph. n and all are the
    good patterns and all patterns that an instance is met in.
    """
    mail = links.where(F.col("kind") == "mail_word").select(F.lit("person_name").alias("kind"), "instance", F.lit(1).alias("m"))
    proper = proper_words(links).withColumn("kind", F.lit("person_name"))
    own = links.where(~F.col("kind").isin("mail_word", "case"))
    edges = own.where(F.col("kind") != "person_name").unionByName(own.where(F.col("kind") == "person_name").join(proper, ["kind", "instance"], "left_semi"))
    # A pattern of fewer instances can never be good: most patterns go here.
    often = edges.groupBy("kind", "pattern").agg(F.count(F.lit(1)).alias("all")).where(F.col("all") >= PATTERN_SUPPORT)
    kept = edges.join(often, ["kind", "pattern"]).join(mail, ["kind", "instance"], "left")
    kept = cut(kept.select("kind", "pattern", "instance", "n", "all", F.greatest("seed", F.coalesce("m", F.lit(0))).cast("double").alias("score")))
    pats = None
    for _ in range(rounds):
        pats = kept.groupBy("kind", "pattern").agg(F.sum("score").alias("good"), F.max("all").alias("all")).withColumn("share", F.col("good") / F.col("all"))
        pats = pats.where((F.col("good") >= PATTERN_SUPPORT) & (F.col("share") >= PATTERN_SHARE)).select("kind", "pattern", "share", "good")
        met = kept.join(pats, ["kind", "pattern"]).groupBy("kind", "instance").agg((1 - F.exp(F.sum(F.log(1.0001 - F.col("share"))))).alias("s")).where(F.col("s") >= INSTANCE_SCORE)
        kept = cut(kept.join(met, ["kind", "instance"], "left").select("kind", "pattern", "instance", "n", "all", F.greatest("score", F.coalesce("s", F.lit(0.0))).alias("score")))
    pats = cut(pats)
    known = kept.where(F.col("score") >= INSTANCE_SCORE).select("kind", "instance").distinct()
    # An instance is judged by all that it is met in, the rare patterns too.
    met = edges.join(pats.select("kind", "pattern", F.lit(1).alias("good")), ["kind", "pattern"], "left").groupBy("kind", "instance").agg(F.count("good").alias("n"), F.count(F.lit(1)).alias("all"))
    return pats, met.join(known, ["kind", "instance"])


def lower_bound(good: Column, all_: Column, z: float = DEVIATIONS) -> Column:
    """Wilson's lower bound of a share."""
    p = good / all_
    return (p + z * z / (2 * all_) - z * F.sqrt((p * (1 - p) + z * z / (4 * all_)) / all_)) / (1 + z * z / all_)


def _word_before(text: str, a: int) -> str:
    """The token right before a place, digits as 0."""
    near = _TOKEN.findall(text[max(0, a - 30) : a].lower())
    return re.sub(r"\d+", "0", near[-1]) if near else "^"


class Finder:
    """What was learned: patterns by kind, and the words of names."""

    def __init__(self, pats: dict[str, dict[str, float]], names: frozenset[str], before: dict[str, set[str]] | None = None):
        self.pats, self.names = pats, names
        #: Of each kind the words right before an instance in any pattern: most contexts end at this test.
        self.before = before or {k: {p[: p.index("_")].split(" ")[-1] for p in v} for k, v in pats.items()}

    def fits(self, kind: str, text: str, a: int, b: int, taken: list[tuple[int, int, str]], least: float) -> bool:
        own = self.pats.get(kind, {})
        if not own:
            return False
        if not any(e == a or not text[e:a].strip() for _, e, _ in taken) and _word_before(text, a) not in self.before.get(kind, ()):
            return False
        left, right = _around(text, a, b, taken)
        return max((own.get(p, 0.0) for p in patterns(left, right)), default=0.0) >= least

    def find(self, text: str | None) -> list[tuple[int, int, str]]:
        """All mentions in reading order, without overlaps."""
        if not text:
            return []
        words = set(_LETTERS.findall(text.lower()))
        named = not self.names.isdisjoint(words) or _CAPITALS.search(text) is not None
        figures = _ANY_DIGIT.search(text) is not None
        street = figures and _has_street(words)
        numbered = figures and _NUMBERED.search(text) is not None
        digits = figures and _DIGITS.search(text) is not None
        if not (named or street or numbered or digits or "@" in text or "at" in words and _AT.search(text)):
            return []
        taken = spans_of_shape(text)
        found = [t for t in taken if t[2] != "identity_no"]
        free = lambda a, b: all(b <= s or e <= a for s, e, _ in found)
        for s, e, kind in taken:
            if kind == "identity_no":
                found.append((s, e, kind))
        for m in ID_SHAPE.finditer(text) if digits else ():
            if free(*m.span()) and self.fits("identity_no", text, *m.span(), taken, 0.6):
                found.append((*m.span(), "identity_no"))
        for m in STREET_SEED.finditer(text) if street else ():
            if free(*m.span()) and ((_street_case(m.group()) and not m.group().isupper()) or self.fits("street_address", text, *m.span(), taken, 0.6)):
                found.append((*m.span(), "street_address"))
        for m in STREET_SHAPE.finditer(text) if numbered else ():
            if free(*m.span()) and _street_case(m.group()) and self.fits("street_address", text, *m.span(), taken, 0.8):
                found.append((*m.span(), "street_address"))
        if named:
            found += [(a, b, "person_name") for a, b in self._best(text, list(found), taken)]
        return sorted(found)

    def _best(self, text: str, blocked: list[tuple[int, int, str]], taken: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
        """The names of a text: of spans that overlap the one that is worth most, of equal ones the first."""
        spans = []
        for a, b, ws in name_spans(text, blocked, self.names):
            worth = self._worth(text, a, b, ws, taken)
            if worth > 0:
                spans.append((-worth, a, b))
        out: list[tuple[int, int]] = []
        for _, a, b in sorted(spans):
            if all(b <= s or e <= a for s, e in out):
                out.append((a, b))
        return out

    def _worth(self, text: str, a: int, b: int, ws: tuple[str, ...], taken: list[tuple[int, int, str]]) -> float:
        """How surely a span is a name: two known words (with an initial between them, side by side, or around a comma)
        before one known word with an initial before what only its context tells; 0 for no name."""
        known = sum(w in self.names for w in ws)
        if known == len(ws):
            if len(ws) == 2:
                gap = text[a:b]
                return 3.0 if "," in gap else 5.0 if "." in gap else 4.0
            if self._like(text, a, b, taken):
                return 2.0
        if _capital(text[a:b]) and self.fits("person_name", text, a, b, taken, 0.8) and (len(ws) == 1 or known or self._both(text, a, b, taken)):
            return 1.0
        return 0.0

    def _like(self, text: str, a: int, b: int, taken: list[tuple[int, int, str]]) -> bool:
        """A single name word with an initial: written like one, or in a known context."""
        return _capital(text[a:b]) or text[a:b].isupper() or self.fits("person_name", text, a, b, taken, 0.5)

    def _both(self, text: str, a: int, b: int, taken: list[tuple[int, int, str]]) -> bool:
        """Two words never seen in a name need a context that fits on both sides."""
        left, right = _around(text, a, b, taken)
        own = self.pats.get("person_name", {})
        return all(own.get(p, 0.0) >= 0.8 for p in patterns(left, right)[:2])


#: Kinds of entries of a model that are no patterns: name words, and the words before a pattern's instance by kind.
NAME, BEFORE = "name", "before "


class _Every:
    """Holds every word."""

    def __contains__(self, word: object) -> bool:
        return True


def lookups(text: str) -> set[tuple[str, str]]:
    """(kind, entry) of all that a Finder can look up in a text, whatever was learned: what it finds first only takes
    places away, and more name words only add spans."""
    out = {(NAME, w) for w in (*_LETTERS.findall(text.lower()), *(w.lower() for w in _WORD.findall(text))) if len(w) > 2}
    taken = spans_of_shape(text)

    def context(kind: str, a: int, b: int) -> None:
        out.add((BEFORE + kind, _word_before(text, a)))
        out.update((kind, p) for p in patterns(*_around(text, a, b, taken)))

    for m in ID_SHAPE.finditer(text) if _DIGITS.search(text) else ():
        context("identity_no", *m.span())
    for m in STREET_SEED.finditer(text) if _has_street(set(_LETTERS.findall(text.lower()))) else ():
        context("street_address", *m.span())
    for m in STREET_SHAPE.finditer(text) if _NUMBERED.search(text) else ():
        if _street_case(m.group()):
            context("street_address", *m.span())
    for a, b, ws in name_spans(text, [], _Every()):
        if len(ws) == 1 or _capital(text[a:b]):
            context("person_name", a, b)
    return out


def learn_model(texts: DataFrame, column: str) -> DataFrame:
    """(kind, entry, share): the patterns of each kind and the name words (kind NAME) that all texts teach, none left out;
    written to the checkpoint folder (an action)."""
    pats, inst = score(cut(link_graph(texts, column)))
    # A name word is met mostly in good contexts: words that also stand in many others drop out.
    ws = inst.where((F.col("kind") == "person_name") & (F.col("n") >= 2) & (F.length("instance") > 2) & (lower_bound(F.col("n"), F.col("all")) >= NAME_SHARE))
    return cut(pats.select("kind", F.col("pattern").alias("entry"), "share").unionByName(ws.select(F.lit(NAME).alias("kind"), F.col("instance").alias("entry"), F.lit(1.0).alias("share"))))


def _finder(entries: Iterable[tuple[str, str, float]]) -> Finder:
    """The finder of a model's entries; with the words before instances among them, it tests by these."""
    kept: dict[str, dict[str, float]] = {}
    before: dict[str, set[str]] = {}
    for kind, entry, share in entries:
        if kind.startswith(BEFORE):
            before.setdefault(kind[len(BEFORE) :], set()).add(entry)
        else:
            kept.setdefault(kind, {})[entry] = share
    names = frozenset(kept.pop(NAME, ()))
    return Finder(kept, names, before or None)


def learn(texts: DataFrame, column: str) -> Finder:
    """Bootstrap the patterns and name words from all texts and bring all of them to the driver (an action)."""
    return _finder(learn_model(texts, column).toLocalIterator())


def _apply(rows: DataFrame, finder: Finder | None, use: Callable[[pd.DataFrame, Finder], pd.DataFrame], schema: StructType) -> DataFrame:
    """``use`` on all rows (checkpointed, with a text) with the finder, else with what they teach themselves: broadcast up
    to MAX_ENTRIES entries, beyond that joined to the parts of the texts that can look them up."""
    if finder is None:
        model = learn_model(rows, "text")
        if model.count() > MAX_ENTRIES:
            return _apply_by_parts(rows, model, use, schema)
        finder = _finder(model.toLocalIterator())
    shared = rows.sparkSession.sparkContext.broadcast(finder)

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield use(b, shared.value)

    return rows.mapInPandas(each, schema)


def _apply_by_parts(rows: DataFrame, model: DataFrame, use: Callable[[pd.DataFrame, Finder], pd.DataFrame], schema: StructType) -> DataFrame:
    """``use`` on the rows in parts, each with a finder of the entries that its texts can look up. No task holds the model."""
    own = rows.columns
    # The rows are checkpointed: their numbers are the same each time.
    rows = rows.withColumn("part", F.shiftright(F.monotonically_increasing_id(), PART_BITS))

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for part, texts in b.groupby("part")["text"]:
                asked = set().union(*(lookups(t) for t in texts if t))
                yield pd.DataFrame([(part, *x) for x in asked], columns=["part", "kind", "entry"])

    before = model.where(F.col("kind") != NAME).select(F.concat(F.lit(BEFORE), "kind").alias("kind"), F.element_at(F.split(F.substring_index("entry", "_", 1), " "), -1).alias("entry"), F.lit(1.0).alias("share")).distinct()
    asked = rows.select("part", "text").mapInPandas(ask, "part bigint, kind string, entry string").distinct().join(model.unionByName(before), ["kind", "entry"])

    def each(b: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        return use(b[own], _finder(zip(entries["kind"], entries["entry"], entries["share"])))

    return rows.groupBy("part").cogroup(asked.groupBy("part")).applyInPandas(each, schema)


def find_mentions(rows: DataFrame, finder: Finder | None = None) -> DataFrame:
    """(table_name, record_id, pii_type, pii_text): each distinct mention of a record, exactly as written.

    rows: table_name, record_id, text. Null and empty texts hold nothing; whole texts are read. They are read twice,
    so they are cut first.
    """
    rows = cut(rows.select("table_name", "record_id", "text").where(F.length("text") > 0))

    def find(b: pd.DataFrame, finder: Finder) -> pd.DataFrame:
        out = []
        for name, rid, t in zip(b["table_name"], b["record_id"], b["text"]):
            for kind, s in dict.fromkeys((kind, t[s:e]) for s, e, kind in finder.find(t)):
                out.append((name, rid, kind, s))
        return pd.DataFrame(out, columns=["table_name", "record_id", "pii_type", "pii_text"])

    schema = rows.select("table_name", "record_id").schema.add("pii_type", "string").add("pii_text", "string")
    return _apply(rows, finder, find, schema)


def redact(rows: DataFrame, finder: Finder | None = None) -> DataFrame:
    """The rows with ``redacted``: every mention replaced by its placeholder, such as [EMAIL], all else unchanged.
    A null text stays null."""
    rows = cut(rows.select("table_name", "record_id", "text"))

    def replace(b: pd.DataFrame, finder: Finder) -> pd.DataFrame:
        return b.assign(redacted=[_replaced(t, finder) if t is not None else None for t in b["text"]])

    schema = rows.select("table_name", "record_id", "text").schema.add("redacted", "string")
    return _apply(rows, finder, replace, schema)


def _replaced(text: str, finder: Finder) -> str:
    out, at = [], 0
    for s, e, kind in finder.find(text):
        out += [text[at:s], f"[{kind.upper()}]"]
        at = e
    return "".join([*out, text[at:]])
