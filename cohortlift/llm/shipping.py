"""Sending this package to the executors, for sessions that were not started with it on their path."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import cohortlift

_sent: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Once per application, hand the package's source to Spark, which serves it to all executors."""
    context = spark.sparkContext
    if context.applicationId not in _sent:
        root = os.path.dirname(os.path.abspath(cohortlift.__file__))
        archive = os.path.join(tempfile.mkdtemp(prefix="cohortlift-"), "cohortlift.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for folder, _, names in os.walk(root):
                for name in sorted(names):
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        out.write(path, os.path.relpath(path, os.path.dirname(root)))
        context.addPyFile(archive)
        _sent.add(context.applicationId)
    return spark
