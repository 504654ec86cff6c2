"""Stamps of partitioned tables that reread only what changed.

A manifest holds, for each partition, a fingerprint of its files and its part of the table's stamp.  Restamping
lists the files, rereads the partitions whose fingerprint is new, and adds the parts up.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlift.operators.pinning import pin
from cohortlift.sources.publish import _files, _place
from cohortlift.sources.stamps import merged_stamp, stamp_parts

_MANIFEST = "folder string, fingerprint decimal(38,0), n_rows long, hash_sum decimal(38,0)"


@dataclass
class Restamp:
    """A table's stamp, its partitions' parts, and the folders that had to be read for it."""

    n_rows: int
    stamp: int
    parts: DataFrame
    reread: list[str]


def _folder(path: str):
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def partition_files(spark: SparkSession, path: str) -> DataFrame:
    """(folder, place, fingerprint) of every partition folder; a listing that opens no file.

    ``folder`` is the folder as the metadata of a scan spells it, ``place`` as a path.  The fingerprint adds up
    hashes of the files' names, sizes and modification times.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    listed = files.load(path).select(
        _folder("_metadata.file_path").alias("folder"), _folder("path").alias("place"),
        F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)").alias("file"),
    )
    return listed.groupBy("folder").agg(
        F.first("place").alias("place"), F.sum("file").cast("decimal(38,0)").alias("fingerprint")
    )


def restamp(spark: SparkSession, path: str, manifest: str) -> Restamp:
    """Stamp the partitioned table at ``path`` with the help of the manifest at ``manifest``, and renew that.

    The stamp is the one that ``content_stamp`` gives for the whole table.  A missing or unfinished manifest
    costs a full read.  After a change of the table's columns the manifest has to be left out.
    """
    done = _files(spark, manifest).exists(_place(spark, f"{manifest}/_SUCCESS"))
    known = spark.read.schema(_MANIFEST).parquet(manifest) if done else spark.createDataFrame([], _MANIFEST)
    current = pin(partition_files(spark, path))
    parts = current.drop("place").join(known, ["folder", "fingerprint"])
    changed = current.join(known, ["folder", "fingerprint"], "left_anti")
    places = sorted(row.place for row in changed.toLocalIterator())
    if places:
        schema = spark.read.parquet(path).schema
        rows = spark.read.schema(schema).option("basePath", path).parquet(*places)
        fresh = stamp_parts(rows.withColumn("_folder", _folder("_metadata.file_path")), "_folder")
        parts = parts.unionByName(
            changed.join(fresh.withColumnRenamed("_folder", "folder"), "folder").drop("place")
        )
    parts = pin(parts.select("folder", "fingerprint", "n_rows", "hash_sum"))
    parts.write.mode("overwrite").parquet(manifest)
    total = merged_stamp(parts).first()
    return Restamp(int(total.n_rows), int(total.stamp), parts, places)
