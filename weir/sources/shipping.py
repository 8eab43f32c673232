"""Makes this library importable in Python workers that do not have it installed."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package's source files to all executors of an application, once; Spark's own file server carries them."""
    app = spark.sparkContext.applicationId
    if app in _sent:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="weir-package-"), "weir.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(package):
            for f in sorted(files):
                if f.endswith(".py"):
                    whole = os.path.join(folder, f)
                    z.write(whole, os.path.join("weir", os.path.relpath(whole, package)))
    spark.sparkContext.addPyFile(path)
    _sent.add(app)
