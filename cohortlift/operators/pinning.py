"""Materialising intermediate tables so that they are computed exactly once."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, StructField, StructType

from cohortlift.session import shared_dir

#: Rows above which a per-study table is no longer held on the driver.
MAX_PINNED_ROWS = 100_000


def pin(df: DataFrame, max_rows: int = MAX_PINNED_ROWS) -> DataFrame:
    """Compute a per-study table once, whatever its size.

    Up to ``max_rows`` rows it comes back as a local relation: Spark then knows its exact size
    and broadcasts it by itself when it is under ``spark.sql.autoBroadcastJoinThreshold``.  A
    larger table is written to the shared folder and joins as any other table.
    """
    spark = df.sparkSession
    if any(isinstance(f.dataType, (StructType, ArrayType)) for f in df.schema):
        df = df.select(*(F.col(f.name).cast(_nullable(f.dataType)) for f in df.schema))
    held = df.persist(StorageLevel.MEMORY_AND_DISK)  # the one computation all that follows reads
    try:
        if held.count() <= max_rows:
            return spark.createDataFrame(held.toArrow(), df.schema)
        return stage(held, "pinned")
    finally:
        held.unpersist()


def _nullable(kind: DataType) -> DataType:
    """``kind`` with nullable members, since Arrow refuses a null struct of required fields."""
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _nullable(f.dataType)) for f in kind])
    if isinstance(kind, ArrayType):
        return ArrayType(_nullable(kind.elementType))
    return kind


def stage(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write a row-level table to the shared folder and read it back.

    Later passes scan only the columns they need, and a lost executor costs a re-read rather
    than a recomputation.  ``by`` names a column of few values whose partitions a filter can
    skip.
    """
    return stage_union([df], name, by)


def stage_union(parts: Sequence[DataFrame], name: str, by: str | None = None) -> DataFrame:
    """As ``stage``, for the rows of all ``parts``, tables of the same columns.

    Each is planned and written by itself: the driver keeps the plan of every running query, once for each
    of its stages, so one wide union costs it far more than its parts do.
    """
    spark = parts[0].sparkSession
    path = f"{shared_dir(spark)}/stages/{name}-{uuid.uuid4().hex}"
    for part in parts:
        writer = part.select(*parts[0].columns).write.mode("append")
        (writer if by is None else writer.partitionBy(by)).parquet(path)
    return spark.read.schema(parts[0].schema).parquet(path)
