"""Readers and writers of delimited, JSON-lines and columnar files."""

from __future__ import annotations

import json
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENCODINGS = ("UTF-8", "ISO-8859-1")
FORMATS = {".csv": "csv", ".gz": "csv", ".parquet": "parquet", ".json": "json", ".jsonl": "json", ".txt": "text", ".orc": "orc"}


def file_format(path: str) -> str:
    """Format of a path by its ending; .csv.gz is CSV, anything unknown Parquet."""
    p = Path(path)
    if p.suffix == ".gz" and len(p.suffixes) > 1 and p.suffixes[-2] in (".json", ".jsonl"):
        return "json"
    return FORMATS.get(p.suffix, "parquet")


def read_csv(spark: SparkSession, path: str, schema: str | None = None, encoding: str | None = None, delimiter: str = ",") -> DataFrame:
    """A CSV file or folder with a header; all columns text unless a schema is given. Quoted line breaks are kept.

    Without an encoding UTF-8 is tried first: the file is read as bytes, and if any line is not valid UTF-8 it is read
    as ISO-8859-1. That test is one distributed scan that stops at the first bad line. Files that end in .gz are not
    splittable: repartition what is read.
    """
    if encoding is None:
        lines = spark.read.format("text").load(path)
        bad = lines.where(~F.is_valid_utf8("value")).limit(1).count()
        encoding = ENCODINGS[1] if bad else ENCODINGS[0]
    reader = spark.read.option("header", True).option("encoding", encoding).option("sep", delimiter).option("multiLine", True).option("quote", '"').option("escape", '"')
    return (reader.schema(schema) if schema else reader).csv(path)


def read_json_lines(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON lines; lines that are no JSON are left out."""
    reader = spark.read.option("mode", "DROPMALFORMED")
    return (reader.schema(schema) if schema else reader).json(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table in the format of its ending."""
    kind = file_format(path)
    if kind == "csv":
        return read_csv(spark, path)
    return read_json_lines(spark, path) if kind == "json" else spark.read.format(kind).load(path)


def write_table(df: DataFrame, path: str, formats: Sequence[str] = ("parquet",), mode: str = "overwrite", partition_by: Sequence[str] = ()) -> list[str]:
    """Write a frame under ``path`` in several formats; the paths written. CSV is compressed with a header."""
    out = []
    for kind in formats:
        w = df.write.mode(mode).partitionBy(*partition_by) if partition_by else df.write.mode(mode)
        if kind == "csv":
            w = w.option("header", True).option("compression", "gzip").option("escape", '"')
        target = f"{path}.{kind}"
        w.format(kind).save(target)
        out.append(target)
    return out


def write_with_preview(df: DataFrame, path: str, rows: int = 100) -> None:
    """Parquet, and a CSV of the first ``rows`` rows beside it; the preview is read back from what was written."""
    df.write.mode("overwrite").parquet(path)
    df.sparkSession.read.parquet(path).limit(rows).coalesce(1).write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{path}.preview")


def write_report(df: DataFrame, path: str) -> dict:
    """The one row of a report frame as one JSON line under ``path``, on any file system Spark writes to; null fields too."""
    one = df.limit(1).select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))
    one.coalesce(1).write.mode("overwrite").text(path)
    row = df.sparkSession.read.text(path).collect()  # one line
    return json.loads(row[0].value) if row else {}


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on the file system its scheme names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_cases(spark: SparkSession, path: str, texts: Sequence[str] = ("query", "text", "description", "title"), ids: Sequence[str] = ("id", "case_id", "row_id")) -> DataFrame:
    """(case_id, query) of a file of cases, by its suffix: a line of ``.txt``, a row of ``.csv``, an object of ``.jsonl`` or
    of a ``.json`` list each is a case. The text is the first of ``texts`` that is filled, the id the first of ``ids``, or
    a hash of the text. Blank cases are left out."""
    kind = path.rsplit(".", 1)[-1].lower()
    if kind == "txt":
        df = spark.read.text(path).withColumnRenamed("value", "query")
    elif kind == "csv":
        df = read_csv(spark, path)
    elif kind in ("json", "jsonl"):
        df = spark.read.option("multiLine", kind == "json").json(path)
    else:
        raise ValueError(f"no reader of cases for {path}")
    have = {c.lower(): c for c in df.columns}
    pick = lambda names: [F.nullif(F.trim(F.col(have[n]).cast("string")), F.lit("")) for n in names if n in have]
    text = pick(texts)
    if not text:
        raise ValueError(f"none of {list(texts)} in {path}")
    out = df.select(F.coalesce(*pick(ids), F.lit(None).cast("string")).alias("_id"), F.coalesce(*text, F.lit(None).cast("string")).alias("query")).where(F.col("query").isNotNull())
    return out.select(F.coalesce("_id", F.hex(F.xxhash64("query"))).alias("case_id"), "query")


def first_source(spark: SparkSession, paths: Sequence[str | None], sample: DataFrame) -> DataFrame:
    """The cases of the first path that is named and exists, else the sample of the tables."""
    for p in paths:
        if p and exists(spark, p):
            return read_cases(spark, p)
    return sample


def up_to(df: DataFrame, rows: int | None) -> DataFrame:
    """The table, or its first rows where a number is asked for: no task reads more than it needs."""
    return df if rows is None else df.limit(rows)


def manifest(spark: SparkSession, path: str, chunk: str, vector: str) -> DataFrame:
    """(chunk, rows, dimension) of written chunks: the manifest is read off the data, so it cannot fall behind them."""
    return spark.read.parquet(path).groupBy(chunk).agg(F.count(F.lit(1)).alias("rows"), F.max(F.size(vector)).alias("dimension"))


def merged_chunks(spark: SparkSession, path: str, chunk: str, vector: str, wanted: DataFrame | None = None) -> DataFrame:
    """All chunks as one table; an error if vectors differ in length, or a wanted chunk (column ``chunk``) is missing."""
    df = spark.read.parquet(path)
    one_length(df, vector)
    if wanted is not None:
        lost = [r[0] for r in pending(spark, wanted.select(chunk).distinct(), path, chunk).limit(5).collect()]
        if lost:
            raise ValueError(f"chunks missing under {path}: {lost}")
    return df


def pending(spark: SparkSession, wanted: DataFrame, done_path: str, key: str) -> DataFrame:
    """Of the wanted chunks those not yet under ``done_path``: a resumed job goes on with these."""
    try:
        done = spark.read.parquet(done_path).select(key).distinct()
    except Exception as e:  # nothing written yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return wanted
    return wanted.join(done, key, "left_anti")


def append_chunks(df: DataFrame, path: str, chunk: str) -> None:
    """Write chunks as partitions; a chunk written again replaces itself only, so a retried job leaves no doubles."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(chunk).parquet(path)


def first_existing(candidates: Sequence[str], needed: Sequence[str] = ()) -> str | None:
    """The first folder that exists and holds the needed names."""
    for c in candidates:
        if Path(c).is_dir() and all((Path(c) / n).exists() for n in needed):
            return c
    return None


def one_length(df: DataFrame, vector: str) -> int:
    """The length all vectors have; an error if they differ (an action)."""
    sizes = [r[0] for r in df.where(F.col(vector).isNotNull()).select(F.size(vector)).distinct().limit(2).collect()]
    if len(sizes) > 1:
        raise ValueError(f"vectors of different lengths: {sorted(sizes)}")
    return sizes[0] if sizes else 0
