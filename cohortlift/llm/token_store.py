"""Token-id files: Parquet with one row per document, ordered, written for selective reads.

Layout of a store: rows ascend by doc_id over files and within them; ``ids`` is a list of ints
with dictionary encoding (token ids repeat) and ``doc_id``, ``place`` and ``n_tokens`` fall back to delta
encoding (writer version 2); row groups and pages have set sizes, and Parquet's page
indexes let a reader skip pages by doc_id.  Metadata columns are read without touching ids.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cohortlift.llm.token_ids import encoded
from cohortlift.session import shared_dir

STORE_SCHEMA = "shard int, place long, doc_id long, n_tokens long, ids array<int>"

#: Row group, page and dictionary sizes in bytes.
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10


def _encode(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, place = TaskContext.get().partitionId(), 0
        for batch in batches:
            doc_ids = batch.column("doc_id")
            for first, ids, offsets in encoded(batch.column("text"), path, end_id):
                rows = len(offsets) - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(rows, shard, dtype=np.int32)), pa.array(place + offsets[:-1]),
                     doc_ids.slice(first, rows), pa.array(np.diff(offsets)),
                     pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))],
                    names=["shard", "place", "doc_id", "n_tokens", "ids"],
                )
                place += int(offsets[-1])

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int) -> None:
    """Write every document's token ids, ``end_id`` after each, in ascending doc_id order.

    Null texts are empty and get ``end_id`` alone; a null doc_id sorts first; rows with equal doc_ids
    are all written, ordered by text; extra columns are ignored; an empty table gives an empty store.
    """
    (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .repartitionByRange("doc_id")  # bounds are sampled: by the id alone, texts do not travel for them
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(_encode(tokenizer_path, end_id), STORE_SCHEMA)
        .write.option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.enable.dictionary#ids.list.element", "true")
        .option("parquet.enable.dictionary#doc_id", "false")
        .option("parquet.enable.dictionary#place", "false")
        .option("parquet.enable.dictionary#n_tokens", "false")
        .option("parquet.block.size", str(ROW_GROUP_BYTES))
        .option("parquet.page.size", str(PAGE_BYTES))
        .option("compression", "zstd")
        .parquet(path)
    )


def open_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORE_SCHEMA).parquet(path)


def read_tokens(spark: SparkSession, path: str, low: int, high: int) -> DataFrame:
    """doc_id and ids of the documents from ``low`` to ``high``; other pages are skipped."""
    return open_tokens(spark, path).where(F.col("doc_id").between(low, high)).select("doc_id", "ids")


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column("ids")
        offsets = column.offsets.to_numpy()
        ids = column.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
        sums = [zlib.crc32(ids[a:b].data) for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("shard", "place", "doc_id")), pa.array(np.diff(offsets).astype(np.int64)),
             pa.array(sums, pa.int64())],
            names=["shard", "place", "doc_id", "n_tokens", "ids_crc32"],
        )


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document of a store, from its files.

    ``start`` counts the ids of all documents before: those of earlier shards, summed from
    metadata columns with one row a shard, and those before it in its own.
    """
    store = open_tokens(spark, path)
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = store.groupBy("shard").agg(F.sum("n_tokens").alias("total")).select(
        "shard", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before")
    )
    rows = store.select("shard", "place", "doc_id", "ids").mapInArrow(
        _checksums, "shard int, place long, doc_id long, n_tokens long, ids_crc32 long"
    )
    return rows.join(shards, "shard").select(
        "doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids_crc32"
    )


def store_path(spark: SparkSession) -> str:
    """A new place for a store in the folder that all executors share."""
    return f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
