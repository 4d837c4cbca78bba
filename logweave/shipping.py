"""Makes the package importable on executors that don't have it."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Sends the package to the executors, once for each application; as ``--py-files`` would."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        with tempfile.TemporaryDirectory() as d:
            here = Path(__file__).parent
            shutil.copytree(here, f"{d}/tree/{here.name}", ignore=shutil.ignore_patterns("__pycache__"))
            # Spark serves the file to executors from the driver's own folder
            folder = tempfile.mkdtemp(prefix="package-")
            sc.addPyFile(shutil.make_archive(f"{folder}/{here.name}", "zip", f"{d}/tree"))
        _shipped.add(sc.applicationId)
    return spark
