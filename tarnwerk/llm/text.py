"""Plain-Python text helpers that run inside Arrow batches."""

from __future__ import annotations

import html
import re
import unicodedata

_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)\b[^<>]{0,300}>")
_BREAKS = {"br", "p", "div", "li", "ul", "ol", "tr", "td", "h1", "h2", "h3", "h4"}
#: A sentence ends after punctuation before a space or a capital, at a line break, or at a lone separator.
_CUT = re.compile(r"[.!?…][\"'»”)\]]*(?:\s+|(?=[A-ZÀ-ÞА-ЯЁ¿¡][a-zà-ÿа-яё]))|[\n\r]+|\s[;/|•·–—-]+\s+")
_BULLET = re.compile(r"^\s*(?:[-*•·–—+;/|]+|\d{1,2}[.)])\s+")
#: Fixed value list: abbreviations whose full stop ends no sentence.
_ABBREVIATIONS = re.compile(r"(?:^|[\s(])(?:mr|mrs|ms|dr|st|rd|ave|nr|no|inc|prof|sr|sra|hr|fr|tel|bzw|z\.b|usw|ca|approx|etc|[a-zA-ZÀ-Þ])\.$", re.IGNORECASE)
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")


def plain(text: str) -> str:
    """Text without markup; block tags become line breaks, entities their characters."""
    if "<" in text:
        text = _TAG.sub(lambda m: "\n" if m.group(2).lower() in _BREAKS else " ", text)
    if "&" in text:
        text = html.unescape(text)
    return text.replace(" ", " ").replace("​", "")


def sentences(text: str) -> list[str]:
    """The sentences and lines of a text in reading order, without bullets and blanks."""
    t = plain(text)
    out: list[str] = []
    lo = 0
    for m in _CUT.finditer(t):
        stop = t[m.start()] in ".!?…"
        part = t[lo : m.end() if stop else m.start()].strip()
        if stop and part[-1:] == "." and len(part) - part.rfind(" ") <= 6 and len(part) < 400 and _ABBREVIATIONS.search(part):
            continue  # no end: the sentence goes on
        lo = m.end()
        if part and not part[0].isalpha():
            part = _BULLET.sub("", part).strip()
        if part:
            out.append(part)
    part = t[lo:].strip()
    if part and not part[0].isalpha():
        part = _BULLET.sub("", part).strip()
    if part:
        out.append(part)
    return out


def words(text: str) -> list[str]:
    """Words of letters in lower case."""
    return _WORD.findall(text.lower())


def fold(text: str) -> str:
    """Lower case without accents and compatibility forms."""
    return "".join(c for c in unicodedata.normalize("NFKD", text.casefold()) if not unicodedata.combining(c))
