"""Scanning and seeding tables."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from cohortlift.operators.sharding import row_numbers


def read_table(spark: SparkSession, name_or_path: str, schema: StructType | None = None) -> DataFrame:
    """A catalog table, or a parquet folder when the name is a path."""
    if "/" in name_or_path:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(name_or_path)
    return spark.table(name_or_path)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """An appended table whose files may have grown columns over time."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def seed_config(spark: SparkSession, rows: Iterable[tuple], schema: StructType) -> DataFrame:
    """Config table from literal rows under a declared schema."""
    names = [field.name for field in schema]
    columns = list(zip(*rows)) or [()] * len(names)
    table = pa.table({name: pa.array(list(values)) for name, values in zip(names, columns)})
    return spark.createDataFrame(table).select(
        *(F.col(field.name).cast(field.dataType) for field in schema)
    )


def assign_ids(df: DataFrame, order: list[str], existing: str | DataFrame | None = None,
               column: str = "patient_id") -> DataFrame:
    """Number rows in ``order``, continuing after the greatest id of ``existing`` if it exists."""
    start = 0
    if isinstance(existing, str):
        known = df.sparkSession.catalog.tableExists(existing)
        existing = df.sparkSession.table(existing) if known else None
    if existing is not None:
        start = existing.agg(F.coalesce(F.max(column), F.lit(0))).first()[0]
    return row_numbers(df, order, column, start=int(start) + 1)
