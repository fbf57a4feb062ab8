"""Hands this package to the executors, so that functions of it can run in their Python workers."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_done: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's sources once per application; Spark's file server passes them on."""
    app = spark.sparkContext.applicationId
    if app in _done:
        return
    here = Path(__file__).parent
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for p in sorted(here.rglob("*.py")):
            z.write(p, f"{here.name}/{p.relative_to(here)}")
    folder = tempfile.mkdtemp(prefix="attestra-src-")
    path = os.path.join(folder, f"{here.name}_src.zip")
    Path(path).write_bytes(data.getvalue())
    spark.sparkContext.addPyFile(path)
    _done.add(app)
