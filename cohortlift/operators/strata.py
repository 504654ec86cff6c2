"""Coarsening covariates into strata."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortlift.functions.bins import AGE_EDGES, RISK_EDGES, right_closed_bin

STRATUM = ["study_id", "age_b", "risk_b"]


def coarsen(features: DataFrame) -> DataFrame:
    """Add the age and risk bins ``age_b`` and ``risk_b``, null outside all bins."""
    return features.withColumns({
        "age_b": F.expr(right_closed_bin("age", AGE_EDGES)),
        "risk_b": F.expr(right_closed_bin("risk_score", RISK_EDGES)),
    })


def common_strata(features: DataFrame) -> DataFrame:
    """Strata holding both arms, with their label and arm sizes; at most 16 per study."""
    return (
        coarsen(features).filter("age_b is not null and risk_b is not null")
        .groupBy(*STRATUM)
        .agg(
            F.expr("count_if(treatment = 1)").alias("n_treated"),
            F.expr("count_if(treatment = 0)").alias("n_control"),
        )
        .filter("n_treated > 0 and n_control > 0")
        .withColumn("stratum", F.expr("concat_ws('_', age_b, risk_b)"))
    )
