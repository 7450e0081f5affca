"""Column expressions shared by the operators; all stay inside generated JVM code."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value sets of truthy spellings; modules differ in whether "x" counts.
TRUTHY = ("true", "1", "yes", "y", "t", "x")
TRUTHY_STRICT = ("true", "1", "yes", "y", "t")
FALSY = ("false", "0", "no", "n", "f")
#: Fixed value set: texts that stand for no text.
NULL_TEXTS = ("nan", "none", "null", "nat")


def norm_id(c: Column) -> Column:
    """An id as text: trimmed, ``12.0`` as ``12``; blank and ``nan`` are null.

    Nulls stay null; leading zeros and non-numeric ids are kept as they are written.
    """
    t = F.regexp_replace(F.trim(c.cast("string")), r"^([+-]?\d+)\.0*$", "$1")
    return F.when((t != "") & (F.lower(t) != "nan"), t)


def id_number(c: Column) -> Column:
    """An id as BIGINT through DOUBLE-free text; null where it is not an integer."""
    return norm_id(c).try_cast("bigint")


def rounded(c: Column, places: int) -> Column:
    """A double rounded by its product with a power of ten, as databases do; ``F.round`` goes by its shortest decimal
    text, which differs where that ends in a half, as of numbers rounded before."""
    return F.round(c * 10.0**places) / 10.0**places


def truthy(c: Column, words: Iterable[str] = TRUTHY) -> Column:
    """Two-valued truth of a text or boolean; null and everything else is false."""
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin(*words), F.lit(False))


def three_valued(c: Column) -> Column:
    """True, false, or null where neither spelling set holds."""
    t = F.lower(F.trim(c.cast("string")))
    return F.when(t.isin(*TRUTHY_STRICT), True).when(t.isin(*FALSY), False)


def clean_text(c: Column) -> Column:
    """Text without markup and with single spaces; null and the words for no text become ''."""
    t = F.regexp_replace(c.cast("string"), r"<[^>]{1,200}>", " ")
    t = F.regexp_replace(t, r"&nbsp;|&#160;", " ")
    t = F.regexp_replace(F.regexp_replace(t, r"&amp;", "&"), r"&lt;|&gt;|&quot;|&#39;", " ")
    t = F.trim(F.regexp_replace(t, r"[\s ]+", " "))
    return F.when(t.isNull() | F.lower(t).isin(*NULL_TEXTS), "").otherwise(t)


def word_count(c: Column) -> Column:
    """Number of whitespace-separated words; 0 for null and blank."""
    t = F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " "))
    return F.when(t == "", 0).otherwise(F.size(F.split(t, " ")))


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0 or null."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def source_key(c: Column) -> Column:
    """One spelling of a source name: lower case, words joined by underscores; blank is null."""
    t = F.regexp_replace(F.lower(F.trim(c)), r"[\s\-_]+", "_")
    return F.when(t != "", t)
