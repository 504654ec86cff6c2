"""Typed rows and table writers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the declared columns and types; absent columns become typed nulls."""
    return df.select(
        *(
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        )
    )


def save_partitioned(df: DataFrame, path: str, key: str = "study_id") -> None:
    """Replace the partitions of the studies present in ``df`` and leave the others alone.

    The rebalance hint gathers each study into few files and still splits a huge study.
    """
    (
        df.hint("rebalance", key).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)
    )


def replace_table(df: DataFrame, path: str) -> None:
    """Replace the whole table, schema included."""
    df.write.mode("overwrite").parquet(path)


def append(df: DataFrame, path: str) -> None:
    """Append rows; columns new to the table are merged when it is read."""
    df.write.mode("append").parquet(path)


def union_results(*tables: DataFrame) -> DataFrame:
    """Results of several tracks; columns a track lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
