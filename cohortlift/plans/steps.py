"""Row counts and times of a run's steps, taken while their tables are written."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from cohortlift.operators.pinning import stage


class Steps:
    """What each step wrote and how long it took; all studies of a run share a step's time."""

    def __init__(self) -> None:
        self.seconds: dict[str, float] = {}
        self.rows: dict[str, dict[str, int]] = {}

    def stage(self, step: str, make: Callable[[], DataFrame], name: str, by: str | None = None) -> DataFrame:
        """Write the table that ``make`` plans.  Its rows are counted as they are written, not in a pass of
        their own."""
        started = time.monotonic()
        seen = Observation()
        counts = (F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("treatment") == 1).alias("n_treated"))
        table = stage(make().observe(seen, *counts), name, by)
        self._took(step, started)
        self.rows[step] = {key: value or 0 for key, value in seen.get.items()}
        return table

    def timed(self, step: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A table that ``make`` computes, with its time."""
        started = time.monotonic()
        table = make()
        self._took(step, started)
        return table

    def _took(self, step: str, started: float) -> None:
        self.seconds[step] = self.seconds.get(step, 0.0) + time.monotonic() - started

    def table(self, spark: SparkSession) -> DataFrame:
        """(step, n_rows, n_treated, seconds), counts null where a step writes no rows of patients."""
        rows = [
            (step, self.rows.get(step, {}).get("n_rows"), self.rows.get(step, {}).get("n_treated"), seconds)
            for step, seconds in self.seconds.items()
        ]
        return spark.createDataFrame(rows, "step string, n_rows long, n_treated long, seconds double")
