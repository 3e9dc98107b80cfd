"""The package itself, sent to the executors once per application, so that Python workers can import it anywhere."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    path = os.path.join(tempfile.mkdtemp(prefix="newsloom-"), f"{PACKAGE.name}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(PACKAGE.rglob("*.py")):
            z.write(p, p.relative_to(PACKAGE.parent))
    spark.sparkContext.addPyFile(path)
