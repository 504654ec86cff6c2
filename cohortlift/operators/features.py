"""Imputation and panel features."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortlift.operators.quality import baseline_rows
from cohortlift.operators.quantiles import exact_quantile

_FILL_GROUP = "if(feature_method = 'aggressive_impute', treatment, -1)"


def impute(cohort: DataFrame, methods: DataFrame) -> DataFrame:
    """Fill missing risk scores with a median: of the study, or of the arm for
    ``aggressive_impute``.  ``methods`` gives each study's feature_method."""
    keyed = cohort.join(methods.select("study_id", "feature_method"), "study_id").withColumn(
        "_fill_group", F.expr(_FILL_GROUP)
    )
    medians = exact_quantile(keyed, ["study_id", "_fill_group"], "risk_score", 0.5, "_median")
    return (
        keyed.join(medians, ["study_id", "_fill_group"], "left")
        .withColumn("risk_score", F.expr("coalesce(risk_score, _median)"))
        .select(*cohort.columns)
    )


def impute_global(cohort: DataFrame) -> DataFrame:
    """Fill missing risk scores with the study median."""
    medians = exact_quantile(cohort, ["study_id"], "risk_score", 0.5, "_median")
    return (
        cohort.join(medians, "study_id", "left")
        .withColumn("risk_score", F.expr("coalesce(risk_score, _median)"))
        .select(*cohort.columns)
    )


def impute_arm(cohort: DataFrame) -> DataFrame:
    """Fill missing risk scores with the median of the study's arm."""
    medians = exact_quantile(cohort, ["study_id", "treatment"], "risk_score", 0.5, "_median")
    return (
        cohort.join(medians, ["study_id", "treatment"], "left")
        .withColumn("risk_score", F.expr("coalesce(risk_score, _median)"))
        .select(*cohort.columns)
    )


def performance(panel: DataFrame, config: DataFrame) -> DataFrame:
    """Rows of each study's own performance window 1..performance_months."""
    windows = config.selectExpr("study_id", "performance_months")
    return (
        panel.filter("period >= 1").join(windows, "study_id")
        .filter("period <= performance_months").drop("performance_months")
    )


def period_split(panel: DataFrame, config: DataFrame) -> DataFrame:
    """Panel rows labelled ``baseline`` or ``performance``; later periods are left out."""
    windows = config.selectExpr("study_id", "performance_months")
    return (
        panel.join(windows, "study_id")
        .withColumn(
            "phase",
            F.expr(
                "case when period = 0 then 'baseline' "
                "when period >= 1 and period <= performance_months then 'performance' end"
            ),
        )
        .filter("phase is not null").drop("performance_months")
    )


def performance_mean(panel: DataFrame, config: DataFrame) -> DataFrame:
    return (
        performance(panel, config).groupBy("study_id", "patient_id")
        .agg(F.avg("outcome").alias("post_outcome"))
    )


def panel_periods(panel: DataFrame, config: DataFrame) -> DataFrame:
    """Long extract of the performance window."""
    return performance(panel, config).select(
        "study_id", "patient_id", "treatment", "period", "outcome"
    )


def panel_impute(panel: DataFrame, config: DataFrame) -> DataFrame:
    """Performance rows with missing risk filled by the study's baseline median."""
    medians = exact_quantile(baseline_rows(panel), ["study_id"], "risk_score", 0.5, "_median")
    rows = performance(panel, config)
    return (
        rows.join(medians, "study_id", "left")
        .withColumn("risk_score", F.expr("coalesce(risk_score, _median)"))
        .select(*rows.columns)
    )


def panel_features(panel: DataFrame, config: DataFrame) -> DataFrame:
    """One row per patient having a baseline and at least one performance period.

    ``post_outcome`` is the mean over the performance window and ``slope`` the least-squares
    slope through baseline and window, 0 where it is undefined.  Both come from the single
    aggregation that also picks the baseline columns, so the panel is shuffled once and no
    later stage has to join periods back.
    """
    medians = exact_quantile(baseline_rows(panel), ["study_id"], "risk_score", 0.5, "_median")
    windows = config.selectExpr("study_id", "performance_months")
    at_baseline = {
        name: F.expr(f"max(if(period = 0, {source}, null))").alias(name)
        for name, source in (
            ("treatment", "treatment"), ("age", "age"), ("risk_score", "risk_score"),
            ("prior_cost", "prior_cost"), ("pre_outcome", "outcome"),
        )
    }
    return (
        panel.join(windows, "study_id")
        .filter("period >= 0 and period <= performance_months")
        .groupBy("study_id", "patient_id")
        .agg(
            *at_baseline.values(),
            F.expr("avg(if(period >= 1, outcome, null))").alias("post_outcome"),
            F.expr("coalesce(regr_slope(outcome, period), 0D)").alias("slope"),
            F.expr("count_if(period = 0)").alias("_n_base"),
            F.expr("count_if(period >= 1)").alias("_n_perf"),
        )
        .filter("_n_base > 0 and _n_perf > 0")
        .join(medians, "study_id", "left")
        .selectExpr(
            "study_id", "patient_id", "treatment", "age",
            "coalesce(risk_score, _median) as risk_score", "prior_cost", "pre_outcome",
            "post_outcome", "slope",
        )
    )
