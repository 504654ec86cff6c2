"""Surrogate ids that continue across batches, handed out by the name of a table.

Every batch reserves its range in a published table of reservations, one entry after the other: an entry's number
is its run id, so of two batches that reach for the same number one has to try again behind the other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlift.operators.sharding import row_numbers
from cohortlift.sources.publish import publish, read_published

_RESERVED = "table_name string, batch string, first_id long, n_rows long, run_id string"


def reservations(spark: SparkSession, marks: str) -> DataFrame:
    """(table_name, batch, first_id, n_rows) of all reserved ranges."""
    held = read_published(spark, marks)
    return held if "table_name" in held.columns else spark.createDataFrame([], _RESERVED)


def reserve(spark: SparkSession, table: str, batch: str, n_rows: int, marks: str, column: str = "patient_id") -> int:
    """First id of the range of ``n_rows`` ids for ``batch``; the same one when asked again.

    Ranges start after the greatest one reserved and after the greatest id of the table, if there is such a table.
    """
    while True:
        mine = reservations(spark, marks).filter(F.col("table_name") == table)
        known = mine.filter(F.col("batch") == batch).first()
        if known:
            if known.n_rows != n_rows:
                raise ValueError(f"batch {batch} of {table} had {known.n_rows} rows, now {n_rows}")
            return known.first_id
        state = mine.agg(F.count("*").alias("n"), F.max(F.col("first_id") + F.col("n_rows") - 1).alias("top")).first()
        greatest = 0
        if spark.catalog.tableExists(table):
            greatest = spark.table(table).agg(F.coalesce(F.max(column), F.lit(0))).first()[0]
        first = max(state.top or 0, int(greatest)) + 1
        entry = spark.createDataFrame(
            [(table, batch, first, n_rows)], "table_name string, batch string, first_id long, n_rows long")
        if publish(entry, marks, f"{table}#{state.n}"):
            return first


def append_batch(df: DataFrame, order: list[str], table: str, batch: str, marks: str, column: str = "patient_id") -> bool:
    """Append ``df`` with ids in ``order`` to the catalog table ``table``; False if that batch is in it already.

    The table is made by its first batch.  A batch that failed between its reservation and its rows gets the same
    ids when it is repeated.
    """
    spark = df.sparkSession
    n_rows = df.count()
    first = reserve(spark, table, batch, n_rows, marks, column)
    if n_rows == 0 or (
        spark.catalog.tableExists(table)
        and spark.table(table).filter(F.col(column).between(first, first + n_rows - 1)).take(1)
    ):
        return False
    row_numbers(df, order, column, start=first).write.mode("append").saveAsTable(table)
    return True
