"""Per-study intermediates as one table, laid out so that a study's rows are found without a scan."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlift.session import shared_dir

#: Buckets of each study: a study of a third of all rows is written, and later joined, by that many tasks.
BUCKETS = 16


class StudyTable:
    """A catalog table partitioned by ``study_id`` and bucketed by ``unit``, with its files in the shared folder.

    A join with a filtered table of studies reads those studies' partitions only (dynamic partition pruning);
    two such tables of the same buckets join on (study, unit) without a shuffle of either where
    ``spark.sql.requireAllClusterKeysForCoPartition`` is false.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.name = spark, name

    @classmethod
    def save(cls, df: DataFrame, name: str | None = None, unit: str = "patient_id", buckets: int = BUCKETS) -> StudyTable:
        """Write ``df``; a (study, bucket) is one task's, hence one file's, work."""
        spark = df.sparkSession
        name = name or f"intermediate_{uuid.uuid4().hex}"
        # The layout of the bucketed writer: the same hash, and in the same number of buckets.
        bucket = F.pmod(F.hash(unit), F.lit(buckets))
        (
            df.repartition(F.col("study_id"), bucket).write.partitionBy("study_id").bucketBy(buckets, unit).sortBy(unit)
            .option("path", f"{shared_dir(spark)}/intermediates/{name}-{uuid.uuid4().hex}").mode("overwrite")
            .saveAsTable(name)
        )
        return cls(spark, name)

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def rows_of(self, studies: DataFrame) -> DataFrame:
        """Rows of the studies in ``studies``, whose filters prune the partitions that are read."""
        return self.rows().join(studies.select("study_id").distinct(), "study_id", "left_semi").select(*self.rows().columns)

    def drop(self) -> None:
        """Forget the table; its files stay for the owner of the shared folder to expire."""
        self.spark.sql(f"drop table if exists {self.name}")
