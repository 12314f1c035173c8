"""Carries this package to the Python workers of an application, wherever the driver was started."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_DONE: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once an application: the package's sources as a zip file that Spark hands to every worker."""
    sc = spark.sparkContext
    if sc.applicationId in _DONE:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    if os.path.isdir(root):
        path = os.path.join(tempfile.mkdtemp(prefix="packloom-"), "packloom.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, names in sorted(os.walk(root)):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.join("packloom", os.path.relpath(full, root)))
        sc.addPyFile(path)
    _DONE.add(sc.applicationId)
