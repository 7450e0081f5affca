"""The package itself as a file for the executors' Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_PACKAGE = Path(__file__).resolve().parent.parent


def ship(spark: SparkSession) -> None:
    """Give the workers this package, once per application, as ``--py-files`` would; they may lack it on their path."""
    sc = spark.sparkContext
    if getattr(sc, "_tarnwerk_shipped", False):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="tarnwerk-"), "tarnwerk_package.zip")  # Spark hands it to the executors
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(_PACKAGE.rglob("*.py")):
            z.write(p, p.relative_to(_PACKAGE.parent))
    sc.addPyFile(path)
    sc._tarnwerk_shipped = True
