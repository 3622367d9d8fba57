"""Send this package to the executors' Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once for each application; Arrow UDFs import the package by name."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        top = Path(__file__).resolve().parents[1]
        name = Path(tempfile.mkdtemp(prefix="weftlink-")) / f"{top.name}.zip"
        with zipfile.ZipFile(name, "w") as archive:
            for p in sorted(top.rglob("*.py")):
                archive.write(p, p.relative_to(top.parent))
        context.addPyFile(str(name))
        _shipped.add(context.applicationId)
