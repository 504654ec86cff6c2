"""Mixing sources to target weights by a splitting tree of exact block quotas.

Each source's documents fall into blocks by a hash, and the blocks' order is a hash as well: a fixed
random permutation.  A source whose target is ``q`` times its size gives every block ``floor(q)`` times and
then the first blocks of the permutation once more; the block at the border gives its first documents.
The draws so counted are the source's exact block quota.  A multivariate-hypergeometric
splitting tree divides all quotas between two halves of the output shards, each half between
its halves, down to one shard, every node with its own seed, so any leaf can be computed
alone and reruns agree.  A shard's quotas then name the disjoint draws it owns, and its rows are
shuffled locally.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cohortlift.llm.words import WORD_PATTERN, word_counts
from cohortlift.operators.pinning import pin, stage

BLOCK_WORDS = 250_000
SHARD_WORDS = 2_000_000
MOST_REPEATS = 3


def _with_sizes(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_size``, the number of words of the column ``_text`` (null: 0)."""
    from pyspark.sql.types import LongType, StructField, StructType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = pa.array(word_counts(batch.column("_text")), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, counts], names=[*batch.schema.names, "_size"])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("_size", LongType())]))


def target_sizes(sizes: Sequence[int], weights: Sequence[float], most: float = MOST_REPEATS) -> np.ndarray:
    """Shares of the total size by weight; a target stops at ``most`` times its source's size and
    the excess is shared again by weight until none is above."""
    size, weight = np.array(sizes, dtype=float), np.array(weights, dtype=float)
    target, free = np.zeros(len(size)), np.ones(len(size), dtype=bool)
    while free.any():
        left = size.sum() - target[~free].sum()
        target[free] = left * weight[free] / weight[free].sum()
        above = free & (target > most * size)
        if not above.any():
            break
        target[above] = most * size[above]
        free &= ~above
    return target


def _quota_parts(sources: list[str | None], quotas: np.ndarray, n_shards: int, seed: int):
    """Quotas of the asked shards, each by its own way down the tree."""
    def walk(shard: int) -> np.ndarray:
        low, high, held = 0, n_shards, quotas
        while high - low > 1:
            middle = (low + high) // 2
            total = int(held.sum())
            take = total * (middle - low) // (high - low)
            rng = np.random.default_rng([seed, low, high])
            left = rng.multivariate_hypergeometric(held, take, method="marginals") if total else held
            if shard < middle:
                held, high = left, middle
            else:
                held, low = held - left, middle
        return held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column("id").to_pylist():
                held = walk(shard)
                keep = np.flatnonzero(held)
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array(np.full(len(keep), shard)), "_source": pa.array([sources[i] for i in keep], pa.string()),
                    "quota": pa.array(held[keep]),
                })

    return run


def _row(docs: DataFrame, names: Sequence[str]) -> list:
    """Columns of the input rows ``docs`` out of a plan, which holds all but the text in a struct."""
    return [(F.col("_text") if n == "text" else F.col("_row").getField(n)).alias(n) for n in docs.columns if n in names]


def plan_mix(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with ``_size``, ``_source_size``, ``_target`` and ``_shards``, the output shards of its draws.

    These four replace columns of the same names; see ``plan`` for the rest.
    """
    added = ["_size", "_source_size", "_target", "_shards"]
    planned = plan(docs, **options)
    names = [n for n in docs.columns if n not in added and (n != "text" or "_text" in planned.columns)]
    return planned.select(*_row(docs, names), *added)


def plan(
    docs: DataFrame, pattern: Sequence[float] = (5, 2, 1), seed: int = 11,
    block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, keep_text: bool = True,
) -> DataFrame:
    """``_row``, an input row but for its text, ``_text``, ``_size``, ``_source_size``, ``_target``, ``_key`` and
    ``_shards``, the output shards of its draws.  No column of ``docs`` can clash with those of the plan.

    Sources by code point, null last, weigh ``pattern``, repeating.  What passes through the driver is
    one row per source.  A null text has size 0 and is drawn with its block; rows with equal doc_ids are
    mixed row by row; an empty table gives an empty result.  ``keep_text=False`` drops the text once it
    is counted.  A source has at most 2^24 blocks and the mixture 2^20 shards; beyond that they grow.
    """
    spark = docs.sparkSession
    sized = _with_sizes(docs.select(
        F.struct(*(n for n in docs.columns if n != "text")).alias("_row"), F.col("text").cast("string").alias("_text")
    ))
    if not keep_text:
        sized = stage(sized.drop("_text"), "sizes")
    sized = sized.withColumns({"_source": F.col("_row.source").cast("string"), "_id": F.col("_row.doc_id")})
    sized = sized.withColumn("_key", F.xxhash64(F.lit(seed), "_id", "_source", "_size"))
    sources = sized.groupBy("_source").agg(F.sum("_size").alias("words")).collect()
    sources = sorted(sources, key=lambda r: (r._source is None, (r._source or "").encode("utf-8")))
    sizes = [int(r.words) for r in sources]
    targets = target_sizes(sizes, [pattern[i % len(pattern)] for i in range(len(sources))]) if sources else np.zeros(0)
    n_blocks = [max(1, min(-(-s // block_words), 1 << 24)) for s in sizes]
    table = spark.createDataFrame(
        [(r._source, s, float(t), b) for r, s, t, b in zip(sources, sizes, targets, n_blocks)],
        "_source string, _source_size long, _target double, _n_blocks long",
    )
    sized = sized.join(table, sized["_source"].eqNullSafe(table["_source"])).drop(table["_source"])
    sized = sized.withColumn("_block", F.pmod("_key", "_n_blocks"))

    # One row per block: words before it in its source's permutation, and how often it is drawn.
    in_source = Window.partitionBy("_source").orderBy("_rank")
    blocks = sized.groupBy("_source", "_block", "_source_size", "_target").agg(F.sum("_size").alias("words"))
    blocks = blocks.withColumn(
        "_rank", F.row_number().over(Window.partitionBy("_source").orderBy(F.xxhash64(F.lit(seed + 1), "_block"), "_block")) - 1
    ).withColumn("_before", F.sum("words").over(in_source.rowsBetween(Window.unboundedPreceding, 0)) - F.col("words"))
    whole = F.floor(F.col("_target") / F.greatest("_source_size", F.lit(1)) + 1e-9)
    rest = F.col("_target") - whole * F.col("_source_size")
    blocks = stage(blocks.select(
        "_source", "_block", "_rank", whole.cast("int").alias("_whole"),
        F.greatest(rest - F.col("_before"), F.lit(0.0)).alias("_room"), F.col("words").alias("_words"),
    ), "blocks")
    drawn = F.col("_whole") + (F.col("_room") > 0).cast("int")
    counts = blocks.groupBy("_source").agg(F.sum(drawn).alias("draws"), F.count("*").alias("blocks")).collect()
    draws = {r._source: int(r.draws) for r in counts}
    names = [r._source for r in sources]
    quotas = np.array([draws.get(s, 0) for s in names], dtype=np.int64)
    n_shards = max(1, min(-(-sum(sizes) // shard_words), 1 << 20))

    quota = spark.range(n_shards).mapInArrow(
        _quota_parts(names, quotas, n_shards, seed), "shard long, _source string, quota long"
    )
    upto = Window.partitionBy("_source").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    owned = quota.withColumn("_to", F.sum("quota").over(upto)).select(
        "_source", "shard", F.explode(F.sequence(F.col("_to") - F.col("quota"), F.col("_to") - 1)).alias("_draw")
    )
    # Draws in permuted order: all blocks of the first repeat, then of the next, then the last, partial one.
    per_source = spark.createDataFrame([(r._source, int(r.blocks)) for r in counts], "_source string, _blocks long")
    owned = owned.join(per_source, owned["_source"].eqNullSafe(per_source["_source"])).select(
        owned["_source"], "shard", (F.col("_draw") % F.col("_blocks")).alias("_rank"),
        F.floor(F.col("_draw") / F.col("_blocks")).cast("int").alias("_repeat"),
    )
    owned = owned.groupBy("_source", "_rank").agg(
        F.sort_array(F.collect_list(F.struct("_repeat", "shard"))).alias("_owned")
    )
    # One row per block, computed once: Spark knows its size and broadcasts it if that is small, so
    # that texts need not be shuffled to their blocks.
    blocks = pin(blocks.join(
        owned.withColumnRenamed("_source", "_s").withColumnRenamed("_rank", "_r"),
        F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_rank") == F.col("_r")), "left",
    ).select(F.col("_source").alias("_s"), F.col("_block").alias("_b"), "_whole", "_room", "_words", "_owned"))
    joined = sized.join(blocks, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_block") == F.col("_b")))

    # Only a source's border block needs its documents' order: they are drawn while they fit, and
    # then the one whose size is nearest to what is left, if that brings the sum nearer.
    border = (F.col("_room") > 0) & (F.col("_room") < F.col("_words"))
    block = Window.partitionBy("_s", "_b")
    ordered = block.orderBy(F.xxhash64(F.lit(seed + 2), "_key"), "_id")
    fits = F.col("_upto") <= F.col("_room")
    miss = F.when(~fits, F.struct(F.abs(F.col("_size") - F.col("_gap")).alias("by"), F.col("_place").alias("place")))
    plain = joined.where(~border).withColumn("_shards", F.coalesce(F.expr("transform(_owned, d -> d.shard)"), F.expr("array()")))
    edge = (
        joined.where(border)
        .withColumns({
            "_upto": F.sum("_size").over(ordered.rowsBetween(Window.unboundedPreceding, 0)),
            "_place": F.row_number().over(ordered),
        })
        .withColumn("_gap", F.col("_room") - F.coalesce(F.max(F.when(fits, F.col("_upto"))).over(block), F.lit(0)))
        .withColumn("_nearest", F.min(miss).over(block))
        .withColumn(
            "_shards",
            F.when(
                fits | ((F.col("_nearest.place") == F.col("_place")) & (F.col("_nearest.by") < F.col("_gap"))),
                F.expr("transform(_owned, d -> d.shard)"),
            ).otherwise(F.expr("transform(filter(_owned, d -> d._repeat < _whole), d -> d.shard)")),
        )
    )
    kept = ["_row", *(["_text"] if keep_text else []), "_size", "_source_size", "_target", "_key", "_shards"]
    return plain.select(*kept).unionByName(edge.select(*kept))


def mix(docs: DataFrame, seed: int = 11, **options) -> DataFrame:
    """The mixture: a row for every draw of a document, with ``shard`` and its ``place`` in the shard.

    These two replace columns of the same names.  Rows of a shard are shuffled by a hash of the draw; a document
    drawn twice stands twice.
    """
    rows = _placed(docs, seed, options)
    return rows.select(*_row(docs, [n for n in docs.columns if n not in ("shard", "place")]), "shard", "place")


def mixed_rows(docs: DataFrame, seed: int = 11, **options) -> DataFrame:
    """The same rows in the same order under the columns of ``docs`` alone, whatever their names."""
    return _placed(docs, seed, options).select(*_row(docs, docs.columns))


def _placed(docs: DataFrame, seed: int, options: dict) -> DataFrame:
    rows = plan(docs, seed=seed, **options).select("_row", "_text", "_key", F.posexplode("_shards").alias("_copy", "shard"))
    order = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed + 3), "_key", "_copy"), "_key", "_copy")
    return rows.withColumn("place", F.row_number().over(order))
