"""Sending this package to the executors, which need not have the repository."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package to the Python path of all workers, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _sent:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="corpusloom-")) / "corpusloom.zip"
    with zipfile.ZipFile(target, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    sc.addPyFile(str(target))
    _sent.add(sc.applicationId)
