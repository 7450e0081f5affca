"""Parquet tables by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """The table ``name`` under ``directory``; columns and filters reach the scan."""
    return spark.read.parquet(f"{directory}/{name}.parquet")
