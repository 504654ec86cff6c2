"""Data quality per study and the gate that stops weak studies."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def clean(cohort: DataFrame) -> DataFrame:
    """Read a NaN risk score as missing."""
    return cohort.withColumn("risk_score", F.expr("nullif(risk_score, double('NaN'))"))


def baseline_rows(panel: DataFrame) -> DataFrame:
    """Period-0 rows, which the quality of a panel study is measured on."""
    return panel.filter("period = 0")


def missing_fraction(cohort: DataFrame) -> DataFrame:
    return cohort.groupBy("study_id").agg(
        F.expr("avg(cast(risk_score is null as int))").alias("missing_fraction")
    )


def arm_counts(cohort: DataFrame) -> DataFrame:
    return cohort.groupBy("study_id").agg(
        F.count("*").alias("n_total"),
        F.expr("count_if(treatment = 1)").alias("n_treated"),
        F.expr("count_if(treatment = 0)").alias("n_control"),
    )


_SCORE = (
    "round(0.6D * (1D - missing_fraction)"
    " + 0.4D * least(1D, least(n_treated, n_control) / 100D), 3)"
)


def _profile(rows: DataFrame, measured: str, outcome: str) -> DataFrame:
    """Counts, missing fraction and score over the ``measured`` rows, and the difference of mean
    ``outcome`` between the arms, in one pass."""
    means = (f"avg(if(treatment = {arm}, {outcome}, null))" for arm in (1, 0))
    return (
        rows.groupBy("study_id")
        .agg(
            F.expr(f"count_if({measured})").alias("n_total"),
            F.expr(f"count_if({measured} and treatment = 1)").alias("n_treated"),
            F.expr(f"count_if({measured} and treatment = 0)").alias("n_control"),
            F.expr(f"avg(if({measured}, cast(risk_score is null as int), null))").alias(
                "missing_fraction"
            ),
            F.expr(" - ".join(means)).alias("naive_estimate"),
        )
        .withColumn("quality_score", F.expr(_SCORE))
    )


def profile_cohort(cohort: DataFrame) -> DataFrame:
    """Quality score and naive contrast of every study.

    The score weighs completeness 0.6 and size adequacy 0.4; 100 rows per arm are adequate.
    """
    return _profile(cohort, "true", "post_outcome")


def profile_panel(panel: DataFrame) -> DataFrame:
    """As for cohorts: the score of the baseline rows, the contrast of all later periods."""
    return _profile(panel, "period = 0", "if(period >= 1, outcome, null)")


def quality_scores(cohort: DataFrame) -> DataFrame:
    return profile_cohort(cohort).drop("naive_estimate")


def gate(scores: DataFrame, config: DataFrame) -> DataFrame:
    """One row per configured study with ``quality_passed``; no data or no score fails."""
    return config.join(scores, "study_id", "left").withColumn(
        "quality_passed",
        F.expr(
            "coalesce(not isnan(quality_score) and quality_score >= min_quality_score, false)"
        ),
    )


def passing(status: DataFrame) -> DataFrame:
    return status.filter("quality_passed").select("study_id")


def failing(status: DataFrame) -> DataFrame:
    return status.filter("not quality_passed").select("study_id")
