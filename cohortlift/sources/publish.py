"""Publishing the tables of a run once, however often the run is repeated.

A published table is a folder with ``data``, one folder of files for each attempt to write a run, and
``runs``, one small entry for each committed run that names the attempt that counts.  Rows are visible once their
entry exists; an attempt that failed, or that came second, is never listed and so never read.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def _place(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _place(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _entry(path: str, run_id: str) -> str:
    return f"{path}/runs/{hashlib.sha256(run_id.encode()).hexdigest()}.json"


def is_published(spark: SparkSession, path: str, run_id: str) -> bool:
    return _files(spark, path).exists(_place(spark, _entry(path, run_id)))


def publish(df: DataFrame, path: str, run_id: str) -> bool:
    """Commit ``df`` as the rows of ``run_id``; False, and no change, if that run is committed already.

    The rows get a column ``run_id``, which replaces one of that name.  Columns may differ from earlier runs'.
    Of several writers of one run that race, exactly one commits: the entry is renamed into its place, and the
    rename fails where an entry stands.
    """
    spark = df.sparkSession
    if is_published(spark, path, run_id):
        return False
    attempt = uuid.uuid4().hex
    df.withColumn("run_id", F.lit(run_id)).write.parquet(f"{path}/data/{attempt}")
    return _commit(spark, path, run_id, attempt)


def _commit(spark: SparkSession, path: str, run_id: str, attempt: str) -> bool:
    jvm = spark._jvm
    files = _files(spark, path)
    pending, entry = f"{path}/pending-{attempt}.json", _entry(path, run_id)
    files.mkdirs(_place(spark, f"{path}/runs"))
    row = spark.range(1).select(F.to_json(F.struct(F.lit(run_id).alias("run_id"), F.lit(attempt).alias("attempt")))).first()[0]
    out = files.create(_place(spark, pending), False)
    try:
        out.write(bytearray(row.encode()))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        files.getUri(), spark._jsc.hadoopConfiguration())
    keep = spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    keep[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        context.rename(files.makeQualified(_place(spark, pending)), files.makeQualified(_place(spark, entry)), keep)
    except Exception:
        files.delete(_place(spark, pending), False)
        if is_published(spark, path, run_id):
            return False
        raise
    return True


def published_runs(spark: SparkSession, path: str) -> DataFrame:
    """(run_id, attempt) of every committed run."""
    if not _files(spark, path).exists(_place(spark, f"{path}/runs")):
        return spark.createDataFrame([], "run_id string, attempt string")
    return spark.read.schema("run_id string, attempt string").json(f"{path}/runs")


def read_published(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Rows of all committed runs under the union of their columns, or under ``schema``."""
    folders = [f"{path}/data/{row.attempt}" for row in published_runs(spark, path).toLocalIterator()]
    if not folders:
        return spark.createDataFrame([], schema or "run_id string")
    reader = spark.read.option("mergeSchema", "true") if schema is None else spark.read.schema(schema)
    return reader.parquet(*folders)
