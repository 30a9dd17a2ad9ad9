"""Give Python workers this package, wherever the driver found it."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Hand the package to the executors once per application, as a Spark user does
    with ``--py-files``: Spark's driver serves the archive, executors copy it."""
    sc = spark.sparkContext
    if getattr(sc, "_tideline_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="tideline-ship-"), "tideline-package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(archive)
    sc._tideline_shipped = True
