"""Broken prompt and response pairs (problem 1): empty, truncated, refused, copied and wrong-language answers.

A pushdown parser reads fences, brackets and quotations and tells whether an answer breaks off; greedy string tiling
tells whether it says anything of its own; a refusal grammar and language likelihoods do the rest.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwerk.llm import langid
from tarnwerk.llm.langid import LANGS, Model
from tarnwerk.llm.text import sentences
from tarnwerk.operators.lineage import cut

FALLBACK = "fallback_from_invalid_json"
#: Shortest tile of words that counts as copied, unless it is a whole sentence.
MIN_TILE = 3
#: Log-likelihood lead, in nats, from which an answer is in another language than asked for.
LANGUAGE_LEAD = 8.0
#: A pair of words ends sentences if it did so at least so often, and in this share of its uses.
END_COUNT, END_SHARE = 2, 0.2
#: A pair that ends sentences is kept if it ends at least one in so many of them: so there are at most so many.
RAREST_END = 1_000_000

#: Fixed value list: words that stand for no answer.
PLACEHOLDERS = set("n/a na none null nil nan undefined empty tbd - -- . .. ... … ? k.a. keine keiner nichts ninguno ninguna nada aucun aucune rien néant nenhum nenhuma нет ничего".split()) | {"no answer", "no response", "keine angabe", "keine antwort", "sin respuesta", "sin datos", "pas de réponse", "sem resposta", "нет ответа", "no data", "not available"}
_FENCE = re.compile(r"```+[a-zA-Z0-9_-]*|~~~+[a-zA-Z0-9_-]*")
_INVISIBLE = re.compile(r"[​‌‍⁠﻿ \s]+")
_TOKEN = re.compile(r"[^\W_]+(?:['’.,:][^\W_]+)*")
_DIGITS = re.compile(r"\d+")

#: Fixed patterns of refusal: who declines and what is declined, by language.
REFUSALS = re.compile(
    r"""
    \b(?:i|we)\s*(?:['’]d|\s+would)?\s*(?:['’]m|\s+am|\s+are)?\s*(?:\s+(?:must|have\s+to|need\s+to|will|do))?\s*
      (?:rather\s+not|decline|refuse|unable|not\s+able|not\s+allowed|not\s+permitted|not\s+in\s+a\s+position|cannot|can['’]?t|can\s+not|will\s+not|won['’]?t|would\s+not|wouldn['’]t|not\s+comfortable|pass\s+on|prefer\s+not)
      (?:[^.!?]{0,60}\b(?:help|assist|answer|comment|classify|judge|assess|name|evaluat\w*|analy[sz]\w*|provide|give|comply|respond|discuss|process|summari[sz]\w*|review|support|this|that|these|request|do)\b)
    | \b(?:not\s+my\s+(?:place|role|job)|against\s+my\s+(?:policy|policies|guidelines|rules)|beyond\s+what\s+i\s+(?:can|may))\b
    | \b(?:no\s+(?:puedo|debo|quiero|voy\s+a|podemos)|no\s+me\s+(?:corresponde|es\s+posible|está\s+permitido)|(?:debo|tengo\s+que|prefiero)\s+(?:rechazar|declinar|no)|me\s+niego\s+a|rechazo)\b
      [^.!?]{0,50}\b(?:ayudar\w*|responder|contestar|valorar|analizar|an[áa]lisis|evaluar|comentar|clasificar|juzgar|opinar|dar|atender|texto|petici[óo]n|solicitud|suceso)\b
    | \b(?:kann|darf|möchte|werde|will|können|dürfen)\b[^.!?]{0,50}\b(?:nicht|keine?n?)\b[^.!?]{0,40}\b(?:helfen|äußern|beantworten|antworten|bewerten|beurteilen|einschätzen|einordnen|analysieren|kommentieren|nennen|geben|weiterhelfen)\b
    | \b(?:muss|möchte)\b[^.!?]{0,50}\b(?:ablehnen|verweigern)\b | \blehne\b[^.!?]{0,50}\bab\b | \bsteht\s+mir\s+nicht\s+zu\b
    | \bje\s+(?:ne\s+(?:peux|puis|saurais|souhaite|veux|suis)|dois\s+(?:refuser|décliner)|refuse|préfère\s+ne)\b[^.!?]{0,60}\b(?:aider|répondre|évaluer|analyser|commenter|juger|classer|donner|traiter|demande|texte)\b
    | \bne\s+m['’]appartient\s+pas\b | \bne\s+suis\s+pas\s+en\s+mesure\b
    | \bnão\s+(?:posso|devo|vou|consigo|quero|podemos|me\s+cabe|estou\s+autorizado)\b[^.!?]{0,50}\b(?:ajudar\w*|responder|avaliar|analisar|comentar|classificar|julgar|opinar|dar|atender|pedido|texto|ocorrência)\b
    | \b(?:devo|tenho\s+de|tenho\s+que|preciso|prefiro)\s+(?:recusar|declinar|não)\b | \brecuso\b | \bnão\s+me\s+cabe\b
    | (?:не\s+могу|не\s+буду|не\s+стану|не\s+вправе|не\s+имею\s+права|не\s+готов\w*)\s[^.!?]{0,50}(?:помо\w+|отве\w+|оцен\w+|анализ\w*|коммент\w+|суд\w+|классифиц\w+|обсужд\w+|выполн\w+|да(?:ть|вать))
    | (?:вынужден\w*|должен|должна|придётся)\s+(?:отказ\w+|отклон\w+) | отказываюсь | не\s+мне\s+(?:оценивать|судить)
    """,
    re.IGNORECASE | re.VERBOSE,
)
#: Words of which every refusal holds one: an answer without any of them needs no search.
DECLINING = frozenset("rather decline refuse unable not cannot can't can’t cant won't won’t wont wouldn't wouldn’t pass prefer against beyond no niego rechazo debo tengo prefiero nicht kein keine keinen ablehnen verweigern lehne ne refuse refuser décliner préfère não recuso recusar declinar devo tenho preciso prefiro не отказываюсь вынужден вынуждена вынуждены вынуждено должен должна придётся".split())
#: Fixed patterns of courtesies that may go with a refusal.
COURTESY = re.compile(r"\b(?:thank|thanks|sorry|take care|anything else|understanding|please|unfortunately|consult|contact|ask an?|gracias|perd[oó]n|siento|por favor|consulte|danke|leid|bitte|wenden|merci|désolé|veuillez|obrigad[oa]|desculpe|procure|спасибо|извин\w+|простите|пожалуйста|обратитесь|сожалению)\b", re.IGNORECASE)

#: Fixed patterns by which a question asks for a language, and the stems of language names.
_ASKS = re.compile(r"\b(?:answer|reply|respond|write|give|responde\w*|contest\w*|escribe|antwort\w*|schreib\w*|répond\w*|écri\w*|respond\w*|escreva|ответ\w*|напиши\w*)\b[^.!?\n]{0,40}?\b(?:in|en|auf|em|на|по)[\s-]+(\w+)", re.IGNORECASE)
_NAMED = {
    "en": ("engl", "ingl", "angl", "англ"), "es": ("span", "españ", "espan", "espagn", "espanh", "испан"), "de": ("germ", "deut", "alem", "allem", "нем"),
    "fr": ("fren", "franc", "franz", "franç", "франц"), "pt": ("portu", "порт"), "ru": ("russ", "rus", "русск"),
}


@dataclass
class Parsed:
    """What the pushdown parser found: structured or not, closed or not, the text values and what else is said."""

    structured: bool = False
    closed: bool = True
    values: list[str] = field(default_factory=list)
    filled: bool = False
    tail: str = ""
    #: What is still open at the end, the innermost last: brackets, quotations, fences, list items, tags.
    open: list[str] = field(default_factory=list)


#: Where JSON begins after an opening sentence: a bracket before a quotation, a bracket or a line end.
_BEGIN = re.compile(r"[{\[](?=\s*[\"{\[]|\s*\n)")
#: The symbols of JSON: a string (closed or not) and whether a colon follows it, brackets, figures.
_SYMBOL = re.compile(r'"((?:[^"\\]|\\.)*)("?)(\s*:)?|([{\[])|([}\]])|\d', re.DOTALL)
#: The symbols of prose: fences, tags, list items, brackets and quotations.
_PROSE = re.compile(r"(?P<fence>```+|~~~+)|<(?P<end>/?)(?P<tag>[A-Za-z][A-Za-z0-9]*)\b[^<>]*(?P<close>>|\Z)|(?P<item>(?:^|\n)[ \t]*(?:[-*•]|\d{1,2}[.)])(?=\s|\Z))|(?P<open>[(\[{«“„])|(?P<shut>[)\]}»”])")
_SHUT = {"(": ")", "[": "]", "{": "}", "«": "»", "“": "”", "„": "“”"}
#: Fixed value list: tags that are never closed.
_VOID = frozenset("br hr img input meta link p li td tr".split())
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "b": " ", "f": " "}


def _unescape(s: str) -> str:
    if "\\" not in s:
        return s
    return re.sub(r"\\(?:u([0-9a-fA-F]{4})|(.))", lambda m: chr(int(m.group(1), 16)) if m.group(1) else _ESCAPES.get(m.group(2), m.group(2)), s, flags=re.DOTALL)


def parse(text: str) -> Parsed:
    """Read an answer with a stack. JSON, also after an opening sentence or in a fence, is closed when its first
    bracket is; stray commas and missing commas are no matter. All other text is prose: one value, whose fences,
    tags, list items, brackets and quotations are pushed and popped, so that ``open`` tells what it leaves unfinished."""
    t = _FENCE.sub(" ", text).strip()
    if t[:4].lower() == "json":
        t = t[4:].lstrip()
    begin = 0 if t[:1] in ("{", "[") else m.start() if (m := _BEGIN.search(t)) else None
    if begin is None:
        return Parsed(values=[t] if t else [], filled=bool(t), open=_open_in(text.strip()))
    out = Parsed(structured=True, closed=False)
    before = t[:begin].strip()
    stack: list[str] = []
    for m in _SYMBOL.finditer(t, begin):
        opened, shut = m.group(4), m.group(5)
        if m.group(1) is not None:
            if not m.group(2):
                out.values.append(_unescape(m.group(1)))
                out.open = [*stack, '"']
                break
            if not (m.group(3) and stack and stack[-1] == "}"):  # a key is no value
                v = _unescape(m.group(1)).strip()
                if v:
                    out.values.append(v)
                    out.filled = out.filled or not is_nothing(v)
        elif opened:
            stack.append("}" if opened == "{" else "]")
        elif shut:
            while stack and stack.pop() != shut:
                pass
            if not stack:
                out.closed = True
                out.tail = t[m.end() :].strip()
                break
        else:
            out.filled = True
    else:
        out.open = stack
    if before:
        out.tail = f"{before}\n{out.tail}".strip()
    return out


def _open_in(text: str) -> list[str]:
    """What prose leaves open: a fence, a tag, a list item without words, a bracket or a quotation."""
    stack: list[str] = []
    for m in _PROSE.finditer(text):
        kind = m.lastgroup
        if m.group("item") is not None:
            if not text[m.end() :].strip():
                stack.append("item")
        elif m.group("fence") is not None:
            if "fence" in stack:
                del stack[stack.index("fence") :]
            else:
                stack.append("fence")
        elif m.group("tag") is not None:
            name = m.group("tag").lower()
            if not m.group("close"):
                stack.append("<")
            elif m.group("end"):
                if name in stack:
                    del stack[stack.index(name) :]
            elif name not in _VOID:
                stack.append(name)
        elif m.group("open") is not None:
            stack.append(m.group("open"))
        elif kind is not None:
            c = m.group("shut")
            for i in range(len(stack) - 1, -1, -1):
                if c in _SHUT.get(stack[i], ""):
                    del stack[i:]
                    break
    return stack


def is_nothing(text: str | None) -> bool:
    """Whether a text says nothing: blank, invisible, punctuation only or a word for no answer."""
    t = _INVISIBLE.sub(" ", _FENCE.sub(" ", text or "")).strip().strip("\"'`*_ ").lower()
    return t in PLACEHOLDERS or t.strip(".") in PLACEHOLDERS or not any(c.isalnum() for c in t)


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


def tiled(answer: list[str], record: list[str], least: int = MIN_TILE) -> int:
    """Words of ``answer`` that greedy string tiling covers by runs of ``record`` of at least ``least`` words.

    Only places that share the hash of ``least`` words are compared, and a tile once found is not looked at again;
    the longest matches are placed first, and what they leave of others is matched again.
    """
    if len(answer) < least or len(record) < least:
        return 0
    free_a, free_r = [True] * len(answer), [True] * len(record)
    at: dict[tuple[str, ...], list[int]] = {}
    for j in range(len(record) - least + 1):
        at.setdefault(tuple(record[j : j + least]), []).append(j)

    def run(i: int, j: int) -> int:
        n = 0
        while i + n < len(answer) and j + n < len(record) and free_a[i + n] and free_r[j + n] and answer[i + n] == record[j + n]:
            n += 1
        return n

    heap = [(-n, i, j) for i in range(len(answer) - least + 1) for j in at.get(tuple(answer[i : i + least]), ()) if (i == 0 or j == 0 or answer[i - 1] != record[j - 1]) and (n := run(i, j)) >= least]
    heapq.heapify(heap)
    covered = 0
    while heap:
        n, i, j = heapq.heappop(heap)
        now = run(i, j)
        if now < -n:  # another tile took a part of it: the pieces before and after that are matches of their own
            if now >= least:
                heapq.heappush(heap, (-now, i, j))
            if -n - now - 1 >= least:
                heapq.heappush(heap, (n + now + 1, i + now + 1, j + now + 1))
            continue
        for k in range(now):
            free_a[i + k] = free_r[j + k] = False
        covered += now
    return covered


def copies(texts: list[str], record: str) -> bool:
    """Whether the texts have only words of the record, at least one of its sentences whole, and nothing of their own."""
    a = [w for t in texts for w in tokens(t)]
    r = tokens(record)
    if len(a) < MIN_TILE or not set(a) <= set(r):
        return False
    whole = [tokens(s) for s in sentences(record)]
    joined = " " + " ".join(a) + " "
    if not any(len(s) >= MIN_TILE and f" {' '.join(s)} " in joined for s in whole):
        return False
    # A sentence said twice is tiled from the record as often as needed.
    left = joined
    for s in sorted((s for s in whole if len(s) >= MIN_TILE), key=len, reverse=True):
        phrase = f" {' '.join(s)} "
        while phrase in left:
            left = left.replace(phrase, "  ")
    rest = left.split()
    return not rest or tiled(rest, r, min(MIN_TILE, len(rest))) == len(rest)


def refuses(texts: list[str]) -> bool:
    """Whether the texts decline to answer and say nothing else but courtesies."""
    if not any(not DECLINING.isdisjoint(tokens(t)) for t in texts):
        return False
    declined, own = False, 0
    for t in texts:
        for s in sentences(t):
            if REFUSALS.search(s):
                declined = True
            elif not COURTESY.search(s):
                own += len(tokens(s))
    return declined and own <= 4


def final_pair(text: str) -> str | None:
    """The last two words of a text, digits as 0."""
    ws = tokens(text)
    return _DIGITS.sub("0", " ".join(ws[-2:])) if len(ws) >= 2 else None


def count_ends(texts: list[list[str]], into: Counter) -> None:
    """Adds how often each pair of adjacent words stands before a full stop (``end``), how often elsewhere (``mid``), and
    the ends in all (``ends``); texts as their sentences."""
    for parts in texts:
        for s in parts:
            ws = tokens(_DIGITS.sub("0", s))
            if len(ws) < 2:
                continue
            ps = [f"{a} {b}" for a, b in zip(ws, ws[1:])]
            if s.rstrip("\"'»”)]").endswith((".", "!", "?")):
                into["end", ps.pop()] += 1
                into["ends", ""] += 1
            into.update(("mid", p) for p in ps)


def ends_of(counts: DataFrame) -> frozenset[str]:
    """Pairs of words that end sentences (an action): often enough, in a good share of their uses, and at least one in
    RAREST_END of all ends."""
    total = counts.where("kind = 'ends'").agg(F.sum("n")).first()[0] or 0
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("n")).otherwise(0)).alias(kind)
    kept = counts.where("kind in ('end', 'mid')").groupBy("item").agg(of("end"), of("mid")).where((F.col("end") >= max(END_COUNT, total / RAREST_END)) & (F.col("end") >= END_SHARE * (F.col("end") + F.col("mid"))))
    return frozenset(kept.select("item").toPandas()["item"])


def breaks_off(text: str, ends: frozenset[str], left_open: Sequence[str] = ()) -> bool:
    """Whether prose ends inside a sentence, or with what the parser found open: a tag, an empty list item, a bracket
    or a quotation whose sentence has no end. A missing full stop alone is no break, nor is an open fence: the last two
    words must be ones that do not end sentences."""
    if left_open and left_open[-1] in ("<", "item"):
        return True
    t = _FENCE.sub(" ", text).strip()
    parts = sentences(t)
    if not parts:
        return False
    last = parts[-1].rstrip("\"'»”)]*_ ")
    if last.endswith((".", "!", "?")) and not last.endswith(".."):
        return False
    if last.endswith(("…", "..", ",", ":", "-", "–", "(")):
        return True
    if any(x in _SHUT for x in left_open):
        return True
    return final_pair(last) not in ends


def named_language(question: str) -> int | None:
    """The language that a question asks the answer to be in, if it names one."""
    for m in _ASKS.finditer(question):
        name = m.group(1).lower()
        for code, stems in _NAMED.items():
            if name.startswith(stems):
                return LANGS.index(code)
    return None


def judge_form(answer: str | None, question: str, ends: frozenset[str]) -> tuple[str | None, list[str]]:
    """(defect, what is said): empty, refusal, truncated or copied, the first that holds, or None."""
    if answer is None or is_nothing(answer):
        return "empty", []
    p = parse(answer)
    if p.structured and p.closed and not p.filled and is_nothing(p.tail):
        return "empty", []
    said = [v for v in p.values if len(tokens(v)) >= 2] + ([p.tail] if p.tail else [])
    if refuses(said):
        return "refusal", said
    if p.structured and not p.closed:
        return "truncated", said
    if not p.structured and breaks_off(answer, ends, p.open):
        return "truncated", said
    head, blank, record = question.partition("\n\n")
    record = record if blank and record.strip() else question
    return ("copied" if copies(said, record) else None), said


def wrong_language(said: str, due: int, score: np.ndarray, n: int) -> bool:
    """Whether what is said is in another script than the language due, or more likely in another language."""
    script = langid.script_of(said)
    if script is not None and script != langid.script_due(due) and len(tokens(said)) >= 3:
        return True
    return n >= 3 and score.max() - score[due] >= LANGUAGE_LEAD


def defects(answers_: Sequence[str | None], questions: Sequence[str], model: Model, ends: frozenset[str]) -> list[str | None]:
    """The defect of each answer, or None: empty, refusal, truncated, copied or wrong_language, the first that holds. All
    languages are looked up together."""
    formed = [judge_form(a, q, ends) for a, q in zip(answers_, questions)]
    open_ = [i for i, (d, said) in enumerate(formed) if d is None and said]
    asked = list(dict.fromkeys(questions[i] for i in open_))
    own, told = model.score_all([langid.spoken(q) for q in asked])
    guessed = dict(zip(asked, np.where(told > 0, langid.leading(own, 3.0), -1).tolist() if asked else []))
    scores, n = model.score_all([langid.spoken("\n".join(formed[i][1])) for i in open_])
    out = [d for d, _ in formed]
    for i, s, k in zip(open_, scores, n):
        due = named_language(questions[i])
        due = guessed[questions[i]] if due is None else due
        if due >= 0 and wrong_language("\n".join(formed[i][1]), due, s, int(k)):
            out[i] = "wrong_language"
    return out


def defect(answer: str | None, question: str, model: Model, ends: frozenset[str]) -> str | None:
    """The defect of one answer."""
    return defects([answer], [question], model, ends)[0]


def answers(chats: DataFrame, key: str = "chat_id") -> DataFrame:
    """(key, answer_field, question, answer): the answers to judge, a chat delivered again counting once.

    Of ``messages`` the last assistant message, null where there is none; ``llm_free_text_description`` where
    parse_status reports the fallback. The question is the last user message. Chats without a key are left out.
    """
    one = chats.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct("parse_status", "llm_free_text_description", "messages")).alias("r")).select(key, "r.*")
    one = one.withColumns({"_a": F.try_element_at(F.filter("messages", lambda m: F.lower(F.trim(m["role"])) == "assistant"), F.lit(-1)), "_u": F.try_element_at(F.filter("messages", lambda m: F.lower(F.trim(m["role"])) == "user"), F.lit(-1))})
    free = F.when(F.lower(F.trim("parse_status")) == FALLBACK, F.struct(F.lit("llm_free_text_description").alias("answer_field"), F.col("llm_free_text_description").alias("answer")))
    both = F.array_compact(F.array(F.struct(F.lit("messages").alias("answer_field"), F.col("_a.content").alias("answer")), free))
    return one.select(key, F.coalesce("_u.content", F.lit("")).alias("question"), F.explode(both).alias("x")).select(key, "x.answer_field", "question", "x.answer")


def find_defects(chats: DataFrame, key: str = "chat_id") -> DataFrame:
    """(key, answer_field, defect) of every unusable answer; at most one defect each.

    Nulls: no messages, no assistant message, a null content and a null description are empty answers. Very long
    answers are read whole. Language words and sentence ends are learned from all texts first, in one pass over them.
    """
    rows = cut(answers(chats, key))
    counts = langid.count(rows.select(F.explode(F.array("question", "answer")).alias("t")), "t", extra=count_ends)
    shared = chats.sparkSession.sparkContext.broadcast((langid.model_of(counts), ends_of(counts)))

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, ends = shared.value
        for b in batches:
            b["defect"] = defects(b.pop("answer").tolist(), [q or "" for q in b.pop("question")], model, ends)
            yield b[b["defect"].notna()]

    schema = rows.select(key, "answer_field").schema.add("defect", "string")
    return rows.select(key, "answer_field", "question", "answer").mapInPandas(judge, schema)
