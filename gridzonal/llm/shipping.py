"""Send the library to the executors with the job, so that it need not be installed there."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Add the package's sources to the session's Python files, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    # The driver's own temporary folder: Spark copies the file to the executors from there.
    target = os.path.join(tempfile.mkdtemp(prefix="gridzonal-"), "gridzonal_package.zip")
    with zipfile.ZipFile(target, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(target)
    _shipped.add(context.applicationId)
