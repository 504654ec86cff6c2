"""Ordering huge groups without putting any of them into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortlift.operators.pinning import pin
from cohortlift.session import shared_dir


def range_shards(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Range-partition by ``order`` and record each row's partition in ``_shard``.

    Shards are sized by Spark from a sample, whatever the key distribution, provided ``order``
    is unique enough to be split.  The result is checkpointed: range bounds come from a sample,
    so the shard of a row must be stored and never be derived a second time.
    """
    shared_dir(df.sparkSession)
    return (
        df.repartitionByRange(*order)
        .withColumn("_shard", F.spark_partition_id())
        .checkpoint()
    )


def shard_offsets(sharded: DataFrame, keys: Sequence[str], size: Column) -> DataFrame:
    """Sum of ``size`` over all earlier shards of the same keys; one row per keys and shard."""
    totals = sharded.groupBy(*keys, "_shard").agg(size.alias("_size"))
    earlier = (
        Window.partitionBy(*keys).orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)
    )
    return pin(
        totals.select(
            *keys, "_shard", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset")
        )
    )


def row_numbers(df: DataFrame, order: Sequence[str], out: str, start: Column | int = 1) -> DataFrame:
    """Consecutive numbers over the whole table in ``order``, computed shard by shard."""
    sharded = range_shards(df, order).withColumn("_all", F.lit(0))
    offsets = shard_offsets(sharded, ["_all"], F.count("*"))
    within = Window.partitionBy("_all", "_shard").orderBy(*order)
    numbered = sharded.withColumn("_rn", F.row_number().over(within))
    return numbered.join(offsets, ["_all", "_shard"]).select(
        *df.columns, (F.col("_rn") - 1 + F.col("_offset") + F.lit(start)).cast("long").alias(out)
    )


def group_index(df: DataFrame, keys: Sequence[str], unit: str, out: str) -> DataFrame:
    """Number the rows of each group 0..n-1 in ``unit`` order, shard by shard at every size."""
    sharded = range_shards(df, [*keys, unit])
    offsets = shard_offsets(sharded, keys, F.count("*"))
    within = Window.partitionBy(*keys, "_shard").orderBy(unit)
    return (
        sharded.withColumn("_rn", F.row_number().over(within))
        .join(offsets, [*keys, "_shard"])
        .withColumn(out, F.expr("cast(_rn - 1 + _offset as bigint)"))
        .drop("_shard", "_rn", "_offset")
    )
