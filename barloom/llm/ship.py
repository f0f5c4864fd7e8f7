"""Send this package to the executors, for clusters where it is not installed there."""

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import barloom

_sent: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Add the package as a Python file of the application, once; Spark serves it to every executor."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return spark
    top = os.path.dirname(os.path.abspath(barloom.__file__))
    if os.path.isdir(top):  # else it came as an archive itself
        archive = os.path.join(tempfile.mkdtemp(prefix="barloom-code-"), "barloom.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for folder, _, names in os.walk(top):
                for name in sorted(names):
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        out.write(path, os.path.join("barloom", os.path.relpath(path, top)))
        context.addPyFile(archive)
    _sent.add(context.applicationId)
    return spark
