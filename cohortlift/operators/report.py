"""Summaries, texts and logs built from results."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortlift.functions.text import grouped, utc_now


def latest_results(results: DataFrame) -> DataFrame:
    """Newest row of every study; an aggregation, so a long history is combined early."""
    others = [name for name in results.columns if name not in ("study_id", "run_ts")]
    row = F.struct("run_ts", *others)
    return (
        results.groupBy("study_id").agg(F.max(row).alias("_row"))
        .select("study_id", "_row.*").select(*results.columns)
    )


# Fixed texts of the two sentences below: their wording is part of the results.

def headline_sql() -> str:
    return (
        "concat(study_name, ' (', vendor, '): ', upper(model_method), ' on ', matching_method,"
        f" '-matched cohort estimates a ', {grouped('abs(estimate)', 0)}, ' ',"
        " case when estimate < 0 then 'reduction' else 'increase' end, ' in the outcome (',"
        " case when significant then 'statistically significant'"
        " else 'not statistically significant' end, ').')"
    )


def interpretation_sql(bias_note: bool) -> str:
    note = ", removing confounding bias. " if bias_note else ". "
    return (
        f"concat('Estimate ', {grouped('estimate', 1)}, ' (95% CI [', {grouped('ci_low', 1)},"
        f" ', ', {grouped('ci_high', 1)}, ']). Naive unadjusted comparison was ',"
        f" {grouped('naive_estimate', 1)}, '; matching/weighting shifted the estimate by ',"
        f" {grouped('estimate - naive_estimate', 1)}, '{note}n=', n_treated, ' treated / ',"
        " n_control, ' control.')"
    )


def insights(
    results: DataFrame, config: DataFrame, run_ts: str | None = None, bias_note: bool = True
) -> DataFrame:
    """Headline and interpretation of the newest result of every configured study."""
    stamp = utc_now(run_ts)
    latest = latest_results(results).drop("run_ts")
    named = latest.join(config.select("study_id", "study_name", "vendor"), "study_id")
    return named.selectExpr(
        "study_id", f"{stamp} as run_ts", f"{headline_sql()} as headline",
        f"{interpretation_sql(bias_note)} as interpretation",
    )


def matching_shift(results: DataFrame) -> DataFrame:
    """How far matching moved each estimate from the naive contrast."""
    return results.withColumn("shift", F.expr("estimate - naive_estimate"))


def cohort_summary(cohort: DataFrame) -> DataFrame:
    return (
        cohort.groupBy("study_id", "treatment")
        .agg(
            F.count("*").alias("n"),
            F.expr("round(avg(risk_score), 2)").alias("avg_risk"),
            F.expr("round(avg(post_outcome - pre_outcome), 1)").alias("avg_delta"),
        )
        .orderBy("study_id", "treatment")
    )


def panel_summary(panel: DataFrame) -> DataFrame:
    return (
        panel.groupBy("study_id", "treatment", "period")
        .agg(F.count("*").alias("n"), F.expr("round(avg(outcome), 0)").alias("avg_outcome"))
        .orderBy("study_id", "treatment", "period")
    )


def results_listing(results: DataFrame) -> DataFrame:
    return results.orderBy("source", "study_id")


def study_count(cohort: DataFrame) -> DataFrame:
    return cohort.agg(
        F.countDistinct("study_id").alias("n_studies"), F.count("*").alias("n_rows")
    )


#: Logarithm of a distinct-count sketch's size; its standard error is about 1.04 / sqrt(2 ** LOG_SIZE).
LOG_SIZE = 12


def distinct_sketches(df: DataFrame, keys: list[str], column: str, log_size: int = LOG_SIZE) -> DataFrame:
    """A distinct-count sketch of ``column`` per ``keys``, small enough to be stored beside results."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(column, F.lit(log_size)).alias("sketch"))


def approx_distinct(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Estimated distinct values per ``keys`` from stored sketches, without another look at the rows.

    Sketches of any finer grouping merge; nulls count nowhere.
    """
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_approx"))


def metric_rows(results: DataFrame) -> DataFrame:
    """Estimate and interval as one row per metric."""
    return results.selectExpr(
        "study_id",
        "stack(3, 'estimate', estimate, 'ci_low', ci_low, 'ci_high', ci_high) as (metric, value)",
    )
