"""Projections and filters whose columns, words and limits are arguments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwerk.functions import text as T
from tarnwerk.functions.scalars import word_count


def full_block(*columns: str, separator: str = " | ") -> Column:
    """``column: text`` of every column, empty ones too."""
    parts: list[Column] = []
    for c in columns:
        parts += [F.lit(f"{separator if parts else ''}{c}: "), T.clean(F.col(c))]
    return F.concat(*parts)


def early_text(df: DataFrame, early: str, others: Sequence[str], out: str, least_words: int = 3) -> DataFrame:
    """Adds ``out``: the early text of all rows if any row has ``least_words`` words in it, else the other columns joined.
    The choice is one row, made by one pass over the column."""
    good = df.agg(F.coalesce(F.max(word_count(F.coalesce(F.col(early), F.lit("")))) >= least_words, F.lit(False)).alias("_good"))
    return df.crossJoin(F.broadcast(good)).withColumn(out, F.when(F.col("_good"), F.coalesce(F.col(early), F.lit(""))).otherwise(F.concat_ws(" ", *others))).drop("_good")  # one row


def fallback_text(base: str, others: Sequence[str]) -> Column:
    """The cleaned text, or where it is blank the cleaned other columns that are not."""
    return F.coalesce(F.nullif(T.clean(F.col(base)), F.lit("")), F.concat_ws(" ", *[F.nullif(T.clean(F.col(c)), F.lit("")) for c in others]))


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    """All columns with a prefix, so that a join cannot clash."""
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns])


def with_unknown(df: DataFrame, keys: Sequence[str], unknown: str = "Unknown") -> DataFrame:
    """Group keys without nulls and blanks."""
    return df.withColumns({k: F.coalesce(F.nullif(F.trim(k), F.lit("")), F.lit(unknown)) for k in keys})


def resolved(facts: DataFrame, first: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """facts with the columns of ``first``, one row per key, where these are not null, else with their own."""
    other = first.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    return facts.join(other, key, "left").withColumns({c: F.coalesce(f"_{c}", c) for c in columns}).drop(*[f"_{c}" for c in columns])


def with_missing(df: DataFrame, wanted: Mapping[str, str], unknown: str = "Unknown") -> DataFrame:
    """The wanted columns that df lacks: ``unknown`` for strings, 0 for all else, of the type wanted."""
    have = {c.lower() for c in df.columns}
    return df.withColumns({c: F.lit(unknown if kind == "string" else 0).cast(kind) for c, kind in wanted.items() if c.lower() not in have})


def location_key(number: str, path: str) -> Column:
    """The id of a place, else its path marked as such, else null."""
    p = F.trim(F.coalesce(F.col(path), F.lit("")))
    return F.when(F.col(number).isNotNull(), F.col(number).cast("string")).when(p != "", F.concat(F.lit("path:"), p))


def shapes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows, n_columns) of each table; row counts come from the files' footers."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns"))
        out = one if out is None else out.unionByName(one)
    return out


def messages(system: str, user: Column, assistant: Column) -> Column:
    """Three messages of a chat."""
    return F.array(*[F.struct(F.lit(r).alias("role"), c.alias("content")) for r, c in (("system", F.lit(system)), ("user", user), ("assistant", assistant))])


def is_active(active: str, archived: str) -> Column:
    """Active and not archived; unknown counts as not active, and as not archived."""
    return F.coalesce(F.col(active), F.lit(False)) & ~F.coalesce(F.col(archived), F.lit(False))


def good_text(df: DataFrame, text: Column, least_chars: int, least_words: int) -> DataFrame:
    """The rows whose text is long enough in both."""
    return df.where((F.length(text) >= least_chars) & (word_count(text) >= least_words))


def searchable(*columns: str) -> Column:
    """Several columns as one text in lower case."""
    return F.lower(F.concat_ws(" ", *columns))


def contains_any(text: Column, words: Sequence[str]) -> Column:
    """Whether a lower-case text holds any of the words as they are."""
    out = F.lit(False)
    for w in words:
        out = out | F.contains(text, F.lit(w.lower()))
    return out


def matches_any(text: Column, patterns: Sequence[str]) -> Column:
    """Whether any of the patterns is found, as one union."""
    return text.rlike("(?:" + ")|(?:".join(patterns) + ")")


def column_roles(df: DataFrame, target: str, prefixes: Sequence[str]) -> DataFrame:
    """(column_name, excluded) of every column: the target and names with one of the prefixes are excluded. Reads no data."""
    rows = [(c, c == target or c.startswith(tuple(prefixes))) for c in df.columns]
    return df.sparkSession.createDataFrame(rows, "column_name string, excluded boolean")


def with_manual(df: DataFrame, key: str, all_: DataFrame, include: Sequence) -> DataFrame:
    """The keys of df and those of ``all_`` that are included by hand, each once."""
    return df.select(key).union(all_.where(F.col(key).isin(*include)).select(key)).distinct()


def chosen(df: DataFrame, key: str, chain: Sequence[Column], all_: DataFrame, include: Sequence) -> DataFrame:
    """The keys that pass every filter of a chain, and those included by hand."""
    for c in chain:
        df = df.where(c)
    return with_manual(df, key, all_, include)


def supporting_ids(df: DataFrame, keys: Sequence[str], row_id: str, text: str, phrases: Sequence[str], most: int) -> DataFrame:
    """(keys, tag, docs, ids): how many rows hold a phrase as whole words, and the ids of the ``most`` shortest.

    One pass: every row gives the phrases it holds; partitions keep ``most`` ids of a group only.
    """
    from tarnwerk.operators.windows import top_per_group

    hits = F.array_compact(F.array(*[F.when(F.lower(text).rlike(rf"\b{p}\b"), F.lit(p)) for p in phrases]))
    long = df.select(*keys, F.col(row_id).alias("_id"), F.length(text).alias("_len"), F.explode(hits).alias("tag"))
    n = long.groupBy(*keys, "tag").agg(F.count(F.lit(1)).alias("docs"))
    top = top_per_group(long, [*keys, "tag"], ["_len", "_id"], most, "_r").groupBy(*keys, "tag").agg(F.transform(F.sort_array(F.collect_list(F.struct("_r", "_id"))), lambda x: x["_id"]).alias("ids"))
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in (*keys, "tag")]
    on = same[0]
    for c in same[1:]:
        on = on & c
    return n.alias("a").join(top.alias("b"), on).select(*[F.col(f"a.{k}") for k in keys], "a.tag", "docs", "ids")
