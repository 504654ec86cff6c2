"""Matching and weighting: features in, features plus ``weight`` and ``unit_id`` out."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from cohortlift.operators.pinning import pin, stage
from cohortlift.operators.propensity import with_propensity
from cohortlift.operators.quantiles import exact_quantile
from cohortlift.operators.sharding import range_shards
from cohortlift.operators.strata import STRATUM, coarsen, common_strata

_UNIT = "concat('p:', patient_id)"
TRIM_QUANTILE = 0.99


def _features_of(df: DataFrame) -> list[str]:
    return [name for name in df.columns if name not in ("ps", "age_b", "risk_b", "weight")]


def match_none(features: DataFrame) -> DataFrame:
    """Every row with weight 1."""
    return features.selectExpr(*_features_of(features), "1D as weight", f"{_UNIT} as unit_id")


def match_exact(features: DataFrame) -> DataFrame:
    """Rows of strata holding both arms, weight 1."""
    strata = pin(common_strata(features).select(*STRATUM))
    kept = coarsen(features).join(strata, STRATUM, "left_semi")
    return kept.selectExpr(*_features_of(features), "1D as weight", f"{_UNIT} as unit_id")


def match_stratified(features: DataFrame) -> DataFrame:
    """Rows of strata holding both arms, each arm of a stratum weighing 1 in total."""
    strata = pin(common_strata(features).drop("stratum"))
    return coarsen(features).join(strata, STRATUM).selectExpr(
        *_features_of(features),
        "1D / if(treatment = 1, n_treated, n_control) as weight", f"{_UNIT} as unit_id",
    )


def ipw_raw(features: DataFrame) -> DataFrame:
    """Inverse-probability weights before trimming."""
    scored = with_propensity(features)
    return scored.selectExpr(
        *_features_of(scored), "if(treatment = 1, 1D / ps, 1D / (1D - ps)) as weight"
    )


def match_ipw(features: DataFrame) -> DataFrame:
    """Inverse-probability weights cut at the study's 0.99 quantile, both arms together; a row without a score
    has no weight and takes part in no sum."""
    weighted = ipw_raw(features)
    cuts = exact_quantile(weighted, ["study_id"], "weight", TRIM_QUANTILE, "_cut")
    return weighted.join(cuts, "study_id", "left").selectExpr(
        *_features_of(weighted), "if(weight is null, null, least(weight, _cut)) as weight", f"{_UNIT} as unit_id"
    )


def match_knn(features: DataFrame) -> DataFrame:
    """Each treated row with the control nearest in propensity score, with replacement.

    Rows are range-partitioned by study and score, so one study spreads over many tasks.  Inside
    a shard the nearest control on either side is a running maximum and minimum; controls of
    the neighbouring shards come from a table of one row per shard and study.  The control's
    columns travel with its score, so no join has to follow a control that is matched often.
    Ties go to the least patient_id.  Rows without a score are in no pair; ``unscored`` counts them.
    """
    scored = with_propensity(features)
    names = _features_of(scored)
    sharded = range_shards(scored.filter("ps is not null"), ["study_id", "ps", "patient_id"])
    columns = ", ".join(f"'{name}', {name}" for name in names)
    candidate = (
        "if(treatment = 0, named_struct('ps', ps, 'tie', {tie}, 'row', named_struct(" + columns
        + ")), null)"
    )
    below, above = candidate.format(tie="-patient_id"), candidate.format(tie="patient_id")

    edges = sharded.groupBy("study_id", "_shard").agg(
        F.expr(f"max({below})").alias("hi"), F.expr(f"min({above})").alias("lo")
    )
    shards = Window.partitionBy("study_id")
    whole = (Window.unboundedPreceding, -1)
    carried = stage(
        edges.select(
            "study_id", "_shard",
            F.max("hi").over(shards.orderBy("_shard").rowsBetween(*whole)).alias("left_edge"),
            F.min("lo").over(shards.orderBy(F.desc("_shard")).rowsBetween(*whole)).alias("right_edge"),
        ),
        "edges",
    )
    in_shard = Window.partitionBy("study_id", "_shard")
    upto = (Window.unboundedPreceding, Window.currentRow)
    nearest = (
        # Shuffled before the candidates are built: they repeat the row twice over.
        sharded.repartition("study_id", "_shard")
        .withColumn("lower", F.expr(below)).withColumn("upper", F.expr(above))
        .withColumn("lower", F.max("lower").over(in_shard.orderBy("ps").rangeBetween(*upto)))
        .withColumn("upper", F.min("upper").over(in_shard.orderBy(F.desc("ps")).rangeBetween(*upto)))
        .filter("treatment = 1")
        .join(carried, ["study_id", "_shard"])
        .selectExpr(
            *names, "ps", "greatest(lower, left_edge) as lower", "least(upper, right_edge) as upper"
        )
    )
    lower_wins = (
        "upper is null or ps - lower.ps < upper.ps - ps"
        " or (ps - lower.ps = upper.ps - ps and -lower.tie <= upper.tie)"
    )
    pair = (
        f"array(named_struct('member', named_struct({columns}),"
        " 'unit_id', concat('t:', patient_id)),"
        " named_struct('member', control, 'unit_id', concat('c:', patient_id)))"
    )
    return (
        nearest.withColumn("control", F.expr(f"if({lower_wins}, lower.row, upper.row)"))
        .filter("control is not null")
        .selectExpr(f"inline({pair})")
        .selectExpr("member.*", "1D as weight", "unit_id")
    )


def unscored(features: DataFrame) -> DataFrame:
    """Rows per study and arm that nearest matching cannot place, for want of a covariate or a fitted score."""
    scored = with_propensity(features)
    return scored.groupBy("study_id", "treatment").agg(
        F.count("*").alias("n"), F.count_if(F.col("ps").isNull()).alias("n_unscored")
    )


def matched_counts(matched: DataFrame) -> DataFrame:
    """Rows per arm after matching."""
    return matched.groupBy("study_id").agg(
        F.expr("count_if(treatment = 1)").alias("n_treated"),
        F.expr("count_if(treatment = 0)").alias("n_control"),
    )
