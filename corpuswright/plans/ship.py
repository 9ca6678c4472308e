"""Sends this package to the executors of a running session."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_ROOT = Path(__file__).resolve().parents[2]


def ship(spark: SparkSession) -> SparkSession:
    """Adds the package's sources to the session's Python files, once per Spark context."""
    context = spark.sparkContext
    if any(Path(name).name.startswith("corpuswright-") for name in context._python_includes):
        return spark
    target = Path(tempfile.mkdtemp()) / f"corpuswright-{context.applicationId}.zip"
    with zipfile.ZipFile(target, "w") as out:
        for file in sorted([*_ROOT.glob("corpuswright/**/*.py"), *_ROOT.glob("corpus_pipeline.py")]):
            out.write(file, file.relative_to(_ROOT))
    context.addPyFile(str(target))
    return spark
