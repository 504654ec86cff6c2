"""Runs that leave their results, texts and logs in published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cohortlift.operators import report
from cohortlift.operators.pinning import pin
from cohortlift.plans.evaluate import PhasedRun
from cohortlift.sources.publish import is_published, publish, read_published


def record_results(
    results: DataFrame, config: DataFrame, folder: str, run_id: str, *, run_ts: str | None = None,
    bias_note: bool = True,
) -> bool:
    """Publish result rows under ``folder``/results and the texts of the newest ones under ``folder``/insights.

    False where the run was recorded before: nothing is computed again then.  A run that stopped between the two
    is completed, with texts for the results that stand.
    """
    spark = results.sparkSession
    tables = {name: f"{folder}/{name}" for name in ("results", "insights")}
    if all(is_published(spark, path, run_id) for path in tables.values()):
        return False
    if not is_published(spark, tables["results"], run_id):
        publish(pin(results), tables["results"], run_id)
    history = read_published(spark, tables["results"])
    texts = report.insights(history.drop("run_id"), config, run_ts, bias_note)
    ran = history.where(history.run_id == run_id).select("study_id")
    publish(texts.join(ran, "study_id", "left_semi"), tables["insights"], run_id)
    return True


def record_phases(run: PhasedRun, folder: str, run_id: str) -> bool:
    """Publish a phased run's results and step log; False where both were recorded before."""
    new = publish(run.results, f"{folder}/phase_results", run_id)
    return publish(run.step_log, f"{folder}/step_log", run_id) or new
