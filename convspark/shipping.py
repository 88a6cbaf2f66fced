"""Give the package to the Python workers of a session."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

PACKAGE = os.path.dirname(os.path.abspath(__file__))
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package's own files to the executors, once per application."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="convspark-package-"), "convspark.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, files in os.walk(PACKAGE):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(PACKAGE)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)
