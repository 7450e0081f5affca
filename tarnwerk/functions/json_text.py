"""JSON inside free text: the first balanced value, and its repair where it breaks off."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_SIGN = re.compile(r'"(?:[^"\\]|\\.)*("?)|[{\[]|[}\]]', re.DOTALL)
_COMMA = re.compile(r",(\s*[}\]])")


def balanced(text: str | None) -> tuple[str | None, list[str]]:
    """(the first JSON object or list of a text as written, what it leaves open). None where there is none."""
    if not text:
        return None, []
    starts = [i for i in (text.find("{"), text.find("[")) if i >= 0]
    if not starts:
        return None, []
    at = min(starts)
    stack: list[str] = []
    for m in _SIGN.finditer(text, at):
        c = m.group()
        if c[0] == '"':
            if not m.group(1):
                return text[at:], [*stack, '"']
        elif c in "{[":
            stack.append("}" if c == "{" else "]")
        elif stack and stack[-1] == c:
            stack.pop()
            if not stack:
                return text[at : m.end()], []
    return text[at:], stack


def valid(text: str) -> bool:
    try:
        json.loads(text)
        return True
    except ValueError:
        return False


def extract(text: str | None) -> tuple[str | None, str]:
    """(JSON, how it came): ``valid`` as it stands, ``repaired`` after stray commas went and what was open was closed, or
    (None, ``none``) where nothing parses. A string that breaks off ends where the text does; a key without value goes."""
    found, open_ = balanced(text)
    if found is None:
        return None, "none"
    if not open_ and valid(found):
        return found, "valid"
    if open_ and open_[-1] == '"':
        found, open_ = found.rstrip("\\") + '"', open_[:-1]
    tail = "".join(reversed(open_))
    for body in (found, re.sub(r',?\s*"(?:[^"\\]|\\.)*"\s*:?\s*$', "", found), re.sub(r"[,:]\s*[^,{}\[\]\"]*$", "", found)):
        whole = _COMMA.sub(r"\1", body.rstrip().rstrip(",") + tail)
        if valid(whole):
            return whole, "repaired"
    return None, "none"


def extracted(c: Column) -> Column:
    """``extract`` of a column as a struct (json, how), by Arrow batches; texts without a bracket never reach Python."""

    @F.pandas_udf("json string, how string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([extract(t) for t in b], columns=["json", "how"])

    return F.when(c.rlike(r"[{\[]"), run(c)).otherwise(F.struct(F.lit(None).cast("string").alias("json"), F.lit("none").alias("how")))
