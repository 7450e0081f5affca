"""Cutting lineage in iterative jobs, so that a lost executor or a long plan costs no more than one round."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """The frame written to the shared checkpoint folder and read back (an action).

    The folder is that of the context, else the one the session names in spark.checkpoint.dir. On a cluster it must be
    one that all executors share, so where none is set this raises; only in local mode, where driver and executors are
    one process, as in tests, one is made.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or _own_folder(sc.master))
    return df.checkpoint()


def _own_folder(master: str) -> str:
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError(f"no checkpoint folder on {master}: set spark.checkpoint.dir to one that all executors share")
    return tempfile.mkdtemp(prefix="tarnwerk-checkpoint-")
