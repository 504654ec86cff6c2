"""Intermediate tables of one operator call, and their removal once nothing reads them any more."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from cohortlift.session import shared_dir

#: Bytes of an Arrow batch that goes to a Python worker; a batch counts rows alone otherwise, 10,000 of any length.
BATCH_BYTES = 1 << 22
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches, so that neither side of a worker holds 10,000 texts; a smaller bound stays."""
    own = spark.conf.get(_BATCH_SETTING, None)
    if not (own and own.isdigit() and int(own) <= BATCH_BYTES):
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Bound the batches of what is computed meanwhile; the session then has its own setting again."""
    own = spark.conf.get(_BATCH_SETTING, None)
    bound_batches(spark)
    try:
        yield
    finally:
        if own is None:
            spark.conf.unset(_BATCH_SETTING)
        else:
            spark.conf.set(_BATCH_SETTING, own)


class Stages:
    """Tables written below one folder of the shared folder."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.base = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.count = 0

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Compute a table once; later passes read only the columns they need."""
        path = f"{self.base}/{self.count}-{name}"
        self.count += 1
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str | None = None) -> None:
        """Remove the tables of that name, or all; nothing may still have to read them."""
        paths = [self.base] if name is None else [f"{self.base}/{n}-{name}" for n in range(self.count)]
        for path in paths:
            place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            files = place.getFileSystem(self.spark._jsc.hadoopConfiguration())
            if files.exists(place):
                files.delete(place, True)
