"""Paired tests on the treated rows: symmetry check, signed-rank and sign test."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cohortlift.functions.normal import two_sided_p
from cohortlift.operators.pinning import pin
from cohortlift.operators.quantiles import exact_quantile
from cohortlift.operators.sharding import range_shards, shard_offsets

#: Up to this many untied non-zero differences the signed-rank p-value is exact.
EXACT_LIMIT = 50


def paired_differences(features: DataFrame) -> DataFrame:
    """post - pre of the treated rows."""
    return features.filter("treatment = 1").selectExpr(
        "study_id", "patient_id", "post_outcome - pre_outcome as d"
    )


def skewness(differences: DataFrame) -> DataFrame:
    """Mean cubed z-score per study."""
    moments = pin(
        differences.groupBy("study_id").agg(F.avg("d").alias("mu"), F.stddev_pop("d").alias("sd"))
    )
    return (
        differences.join(moments, "study_id").groupBy("study_id")
        .agg(
            F.count("*").alias("n_treated"),
            F.expr("avg(power((d - mu) / (sd + 1e-9), 3))").alias("skew"),
        )
    )


def fallback_route(skews: DataFrame, config: DataFrame) -> DataFrame:
    """Where each study goes after the symmetry check; ``None`` ends its chain."""
    return skews.join(config.select("study_id", "model_type", "fallback_model"), "study_id").selectExpr(
        "study_id", "n_treated", "skew", "abs(skew) > 1 as routed",
        "case when abs(skew) > 1 then coalesce(nullif(fallback_model, ''), 'None')"
        " else concat('model_', model_type) end as model_phase",
    )


def sign_test(differences: DataFrame) -> DataFrame:
    """Two-sided normal sign test; zeros do not count, no p-value when nothing is left."""
    return (
        differences.groupBy("study_id")
        .agg(
            F.count("*").alias("n_treated"),
            F.expr("count_if(d > 0)").alias("n_pos"), F.expr("count_if(d < 0)").alias("n_neg"),
        )
        .selectExpr(
            "*", "try_divide(n_pos - (n_pos + n_neg) / 2D, sqrt((n_pos + n_neg) / 4D)) as z"
        )
        .selectExpr("study_id", "n_treated", "n_pos", "n_neg", f"{two_sided_p('z')} as p_value")
    )


def median_difference(differences: DataFrame) -> DataFrame:
    return exact_quantile(differences, ["study_id"], "d", 0.5, "estimate")


def _exact_table(spark: SparkSession) -> DataFrame:
    """Two-sided p of the smaller rank sum under the null, for every n up to the limit."""
    ways = [1]
    columns: dict[str, list] = {"n": [], "w_min": [], "p_exact": []}
    for n in range(1, EXACT_LIMIT + 1):
        grown = ways + [0] * n
        for total, number in enumerate(ways):
            grown[total + n] += number
        ways = grown
        below = 0
        for total in range(n * (n + 1) // 4 + 1):
            below += ways[total]
            columns["n"].append(n)
            columns["w_min"].append(float(total))
            columns["p_exact"].append(min(1.0, 2.0 * below / 2.0**n))
    return spark.createDataFrame(pa.table(columns))


def signed_rank(differences: DataFrame) -> DataFrame:
    """Two-sided Wilcoxon signed-rank test, zeros dropped.

    Exact for few untied differences, else normal with tie correction.  Equal absolute
    differences are counted before ranking, and ranks run shard by shard over all studies.
    """
    sizes = differences.groupBy("study_id").agg(
        F.count("*").alias("n_treated"), F.expr("count_if(d = 0)").alias("n_zero")
    )
    ties = (
        differences.filter("d <> 0").groupBy("study_id", F.expr("abs(d)").alias("size"))
        .agg(F.count("*").alias("c"), F.expr("count_if(d > 0)").alias("c_pos"))
    )
    sharded = range_shards(ties, ["study_id", "size"])
    offsets = shard_offsets(sharded, ["study_id"], F.sum("c"))
    upto = (
        Window.partitionBy("study_id", "_shard").orderBy("size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    sums = (
        sharded.withColumn("reached", F.sum("c").over(upto))
        .join(offsets, ["study_id", "_shard"])
        .withColumn("avg_rank", F.expr("_offset + reached - (c - 1) / 2D"))
        .groupBy("study_id")
        .agg(
            F.expr("cast(sum(c) as bigint)").alias("n"),
            F.expr("sum(c_pos * avg_rank)").alias("w_plus"),
            F.expr("sum(cast(c as double) * c * c - c)").alias("tie_term"),
        )
    )
    scored = (
        sizes.join(sums, "study_id", "left")
        .selectExpr(
            "*", "least(w_plus, cast(n as double) * (n + 1) / 2D - w_plus) as w_min",
            "try_divide(w_plus - cast(n as double) * (n + 1) / 4D,"
            " sqrt((cast(n as double) * (n + 1) * (2 * n + 1) - tie_term / 2D) / 24D)) as z",
        )
        .join(_exact_table(differences.sparkSession), ["n", "w_min"], "left")
    )
    return scored.selectExpr(
        "study_id", "n_treated", "n", "w_plus",
        f"if(n_zero = 0 and tie_term = 0 and p_exact is not null, p_exact, {two_sided_p('z')})"
        " as p_value",
    )


def rank_or_sign(features: DataFrame, config: DataFrame) -> DataFrame:
    """Signed-rank result of symmetric studies, sign-test result of the skewed ones.

    A skewed study whose fallback is not the sign test ends without a result.
    """
    differences = paired_differences(features)
    route = pin(fallback_route(skewness(differences), config))
    symmetric = differences.join(route.filter("not routed"), "study_id", "left_semi")
    skewed = differences.join(
        route.filter("model_phase = 'model_sign_test'"), "study_id", "left_semi"
    )
    tests = (
        signed_rank(symmetric).selectExpr("study_id", "'wilcoxon' as model_method", "p_value", "n_treated")
        .unionByName(
            sign_test(skewed).selectExpr("study_id", "'sign_test' as model_method", "p_value", "n_treated")
        )
    )
    return tests.join(median_difference(differences), "study_id").selectExpr(
        "study_id", "model_method", "estimate", "p_value", "n_treated"
    )
