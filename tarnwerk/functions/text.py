"""Text and date expressions of the event records; everything stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwerk.functions.scalars import NULL_TEXTS

#: The fixed event schema: column, type, default; None keeps null. The contract is the set of columns, their types and
#: defaults; the order is this project's own, by type as the table's description lists them.
EVENT_SCHEMA = tuple(
    [(c, "string", "") for c in "event_id source_type source_subtype site department location_path title description clean_text status category audit_type task_source_module detected_language language_detection_status".split()]
    + [(c, "bigint", None) for c in "source_id location_id raw_status_id raw_category_id raw_type_id raw_source_type_id".split()]
    + [(c, "timestamp_ntz", None) for c in "event_date due_date completion_date".split()]
    + [(c, "boolean", False) for c in "is_open_task is_overdue_task any_injury severe_actual fatality losttime restrictedtime inpatient emergencyroom has_text".split()]
    + [("is_english_text", "boolean", None), ("injury_record_count", "int", 0), ("text_length", "int", 0), ("detected_language_score", "double", None)]
)


def with_defaults(df: DataFrame, schema=EVENT_SCHEMA) -> DataFrame:
    """Exactly the columns of a schema in its order and types; absent columns and nulls take the default."""
    have = {c.lower(): c for c in df.columns}
    out = []
    for name, kind, default in schema:
        c = F.col(have[name]).cast(kind) if name in have else F.lit(None).cast(kind)
        out.append((c if default is None else F.coalesce(c, F.lit(default))).alias(name))
    return df.select(*out)


def keep_existing(df: DataFrame, columns) -> DataFrame:
    """The wanted columns that exist, in the order wanted."""
    return df.select(*[c for c in columns if c in df.columns])


def snake_columns(df: DataFrame) -> DataFrame:
    """Column names in snake case: a break before a capital after a small letter, other signs as underscores."""
    import re

    return df.toDF(*[re.sub(r"[^0-9a-z]+", "_", re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", c).lower()).strip("_") for c in df.columns])


def clean(c: Column) -> Column:
    """Text without tags and no-break entities, single spaces; null and the words for no text become ''."""
    t = F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"<[^>]{1,200}>", " "), "&nbsp;", " ")
    t = F.trim(F.regexp_replace(t, r"\s+", " "))
    return F.when(F.lower(t).isin(*NULL_TEXTS), "").otherwise(t)


def first_text(*columns: str) -> Column:
    """The first column whose cleaned text is not empty, else ''."""
    return F.coalesce(*[F.nullif(clean(F.col(c)), F.lit("")) for c in columns], F.lit(""))


def text_block(*columns: str, separator: str = " | ") -> Column:
    """``column: text`` of every column with text, joined."""
    return F.concat_ws(separator, *[F.when(clean(F.col(c)) != "", F.concat(F.lit(f"{c}: "), clean(F.col(c)))) for c in columns])


def compact(c: Column, most: int) -> Column:
    """Single-spaced text of at most ``most`` characters, the cut marked by three dots."""
    x = F.trim(F.regexp_replace(c, r"\s+", " "))
    return F.when(F.length(x) > most, F.concat(F.rtrim(F.substring(x, 1, most - 3)), F.lit("..."))).otherwise(x)


def feature_token(c: Column, most: int = 48) -> Column:
    """Letters and digits in lower case, everything else as single underscores, cut at ``most``."""
    return F.substring(F.regexp_replace(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", "_"), r"^_+|_+$", ""), 1, most)


def script(c: Column) -> Column:
    """Script of a text by its code points."""
    return F.when(c.rlike(r"[Ѐ-ӿ]"), "cyrillic").when(c.rlike(r"[À-ſ]"), "latin_accented").otherwise("latin")


def period(c: Column, by: str) -> Column:
    """Label of a date's year, quarter, month or ISO week."""
    y = F.date_format(c, "yyyy")
    if by == "Y":
        return y
    if by == "Q":
        return F.concat(y, F.lit("Q"), F.quarter(c).cast("string"))
    if by == "M":
        return F.date_format(c, "yyyy-MM")
    return F.concat(F.extract(F.lit("YEAROFWEEK"), c).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(c).cast("string"), 2, "0"))


def day_difference(a: Column, b: Column) -> Column:
    """Whole days from b to a, rounded down: the time of day counts."""
    us = lambda c: F.unix_micros(c.cast("timestamp"))
    return F.floor((us(a) - us(b)) / 86_400_000_000).cast("bigint")


def month_sequence(first: Column, last: Column) -> Column:
    """The first days of the months from one date to another, both included; empty where the order is reversed."""
    a, b = F.trunc(first, "MM"), F.trunc(last, "MM")
    return F.when(a <= b, F.sequence(a, b, F.expr("interval 1 month"))).otherwise(F.array().cast("array<date>"))


def reference_day(instant: str) -> Column:
    """The UTC day of an instant in ISO form: a parameter, never the clock of the query."""
    import datetime as dt

    at = dt.datetime.fromisoformat(instant)
    return F.lit((at.astimezone(dt.UTC) if at.tzinfo else at).date())
