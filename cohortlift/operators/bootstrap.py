"""Reproducible bootstrap of every study in one pass over its rows."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from cohortlift.functions.sums import bins, grids, largest
from cohortlift.operators import estimators
from cohortlift.operators.pinning import pin, stage
from cohortlift.operators.sharding import group_index

#: Modulus of the row hash, the Mersenne prime 2**31 - 1.
PRIME = 2147483647
#: A Poisson(1) count above this has a probability of 6e-11, less than a step of the 31-bit hash:
#: no hash value stands for it, at any number of rows.
MAX_COUNT = 12
#: The first pass aims this many standard deviations below the wanted sample size.
SHORTFALL = 5


@dataclass(frozen=True)
class Bootstrap:
    """Resampling scheme.

    ``by_arm`` resamples each arm to its own size, otherwise all rows of the study together.
    ``fixed_n`` draws exactly n rows of n; ``poisson`` gives each row an independent Poisson(1)
    count, which needs no row index.
    """

    reps: int = 300
    seed: int = 7
    by_arm: bool = True
    scheme: str = "fixed_n"

    def coefficients(self) -> tuple[str, str, str]:
        """Hash coefficients of the replicates: three SQL arrays, folded to constants."""
        digests = [
            hashlib.md5(f"{self.seed}|{rep}".encode()).hexdigest() for rep in range(self.reps)
        ]
        return tuple(
            "cast(split('{}', ' ') as array<bigint>)".format(
                " ".join(str(int(digest[at:at + 8], 16) % PRIME) for digest in digests)
            )
            for at in (0, 8, 16)
        )


def poisson_thresholds(rate: str) -> list[str]:
    """SQL for the hash values below which a Poisson count is at most 0, 1, 2, ..."""
    texts = []
    for top in range(MAX_COUNT + 1):
        series = "1.0e0"
        for k in range(top, 0, -1):
            series = f"(1.0e0 + {rate} / {k}.0e0 * {series})"
        texts.append(f"cast(floor(exp(-{rate}) * {series} * {PRIME}.0e0) as bigint)")
    return texts


def _hex_int(text: str, start: int, length: int) -> str:
    return f"cast(conv(substr({text}, {start}, {length}), 16, 10) as bigint)"


def _cubic(h: str) -> str:
    """SQL for a cubic polynomial hash of the draw number, with coefficients h0..h3."""
    text = f"{h}0"
    for i in range(1, 4):
        text = f"(({text} * draw + {h}{i}) % {PRIME})"
    return text


def resampled_sums(rows: DataFrame, moments: dict[str, str], spec: Bootstrap) -> DataFrame:
    """Sum of every moment per study, replicate and arm over the resampled rows.

    A replicate multiplies each row by a count derived from a hash of (study, unit) and the
    replicate's coefficients, so nothing is copied or shuffled but the sums.  For ``fixed_n``
    the counts are Poisson with a mean slightly under 1 and the few rows still missing to n
    are drawn uniformly: Poisson counts given their total are multinomial, hence so is the sum.
    A replicate whose counts exceed n drops them and draws all n rows uniformly.

    Sums are exact over binned moments (see ``functions.sums``), so a replicate does not depend on the order
    of rows or tasks.
    """
    pool = "treatment" if spec.by_arm else "-1"
    group = ["study_id", "pool"]
    raw = rows.selectExpr(
        "study_id", "unit_id", "treatment", f"{pool} as pool",
        *(f"{sql} as {name}" for name, sql in moments.items()),
    )
    limits = [f"t{k}" for k in range(MAX_COUNT + 1)]
    if spec.scheme == "poisson":
        rate = "1.0e0"
    elif spec.scheme == "fixed_n":
        rate = f"greatest(0D, 1D - {SHORTFALL}D / sqrt(n))"
    else:
        raise ValueError(f"unknown bootstrap scheme: {spec.scheme}")
    cells = pin(
        raw.groupBy(*group).agg(F.count("*").alias("n"), *(F.expr(largest(m)).alias(f"{m}_most") for m in moments))
        .selectExpr("*", f"{rate} as rate")
        .selectExpr(
            *group, "n", *(f"{sql} as {t}" for t, sql in zip(limits, poisson_thresholds("rate"))),
            *(f"{sql} as {name}" for m in moments for name, sql in grids(m, f"{m}_most", "n").items()),
        )
    )
    names = [f"{m}_{bin}" for m in moments for bin in ("high", "low")]
    base = raw.join(cells, group).selectExpr(
        "study_id", "unit_id", "treatment", "pool", *limits,
        *(f"{sql} as {name}" for m in moments for name, sql in bins(m).items()),
    )

    a, b, c = spec.coefficients()
    count = " + ".join(["1", *(f"if(u >= {t}, 1, 0)" for t in limits[1:])])
    counted = (
        # Dealt out evenly: each row unfolds into one for each replicate, and files differ in rows a byte.
        base.repartition(int(base.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        .withColumn("h", F.expr("md5(concat_ws('|', study_id, unit_id))"))
        .selectExpr(
            *group, "treatment", *names, *limits,
            f"{_hex_int('h', 1, 8)} % {PRIME} as x1", f"{_hex_int('h', 9, 8)} % {PRIME} as x2",
        )
        .selectExpr("*", f"explode(sequence(0, {spec.reps - 1})) as rep")
        .selectExpr(
            *group, "treatment", "rep", *names, *limits,
            f"({a}[rep] * x1 + {b}[rep] * x2 + {c}[rep]) % {PRIME} as u",
        )
        .filter("u >= t0")
        .selectExpr(*group, "treatment", "rep", *names, f"{count} as k")
        .groupBy(*group, "rep", "treatment")
        .agg(
            F.sum("k").alias("drawn"),
            *(F.expr(f"sum(k * {name})").alias(name) for name in names),
        )
    )
    if spec.scheme == "fixed_n":
        counted = stage(counted, "counts")
        so_far = stage(counted.groupBy(*group, "rep").agg(F.sum("drawn").alias("drawn")), "drawn")
        topped = _top_up(base, cells, so_far, names, spec)
        over = so_far.join(cells.select(*group, "n"), group).filter("drawn > n")
        counted = counted.join(over, [*group, "rep"], "left_anti").drop("drawn").unionByName(topped)
    return counted.groupBy("study_id", "rep", "treatment").agg(
        *(F.expr(f"sum({m}_high) + sum({m}_low)").alias(m) for m in moments)
    )


def _top_up(
    base: DataFrame, cells: DataFrame, so_far: DataFrame, names: list[str], spec: Bootstrap
) -> DataFrame:
    """Uniform draws that bring every replicate to its full size."""
    group = ["study_id", "pool"]
    # A fixed width: these rows are few but each unfolds into many, so they must not be coalesced.
    width = int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    draws = (
        cells.select(*group, "n").selectExpr("*", f"explode(sequence(0, {spec.reps - 1})) as rep")
        .join(so_far, [*group, "rep"], "left")
        .selectExpr(*group, "rep", "n", "if(drawn > n, n, n - coalesce(drawn, 0L)) as short")
        .filter("short > 0")
        .repartition(width, *group, "rep")
        .selectExpr(
            "*", f"md5(concat_ws('|', {spec.seed}, study_id, pool, rep, 'x')) as hx",
            f"md5(concat_ws('|', {spec.seed}, study_id, pool, rep, 'y')) as hy",
        )
        .selectExpr(
            *group, "rep", "n", "short",
            *(f"{_hex_int(h, 8 * i + 1, 8)} % {PRIME} as {h}{i}" for h in ("hx", "hy") for i in range(4)),
        )
        .selectExpr("*", "explode(sequence(1L, short)) as draw")
        .selectExpr(*group, "rep", f"({_cubic('hx')} * 2147483648 + {_cubic('hy')}) % n as idx")
    )
    indexed = group_index(base.select(*group, "unit_id", "treatment", *names), group, "unit_id", "idx")
    return (
        # Spark takes an explode to add no rows, so it would send all the draws through the driver as a broadcast.
        draws.hint("merge").join(indexed, [*group, "idx"])
        .groupBy(*group, "rep", "treatment")
        .agg(*(F.sum(name).alias(name) for name in names))
    )


def replicates(matched: DataFrame, model: str, spec: Bootstrap) -> DataFrame:
    """Estimate of every usable replicate: study_id, rep, estimate."""
    return replicates_of(matched, estimators.MODELS[model], spec)


def replicates_of(
    matched: DataFrame, model: estimators.Contrast | estimators.Adjusted, spec: Bootstrap
) -> DataFrame:
    keys = ["study_id", "rep"]
    if isinstance(model, estimators.Contrast):
        moments = estimators.contrast_moments(model.outcome)
        sums = resampled_sums(matched, moments, spec)
        estimates = estimators.finish_contrast(
            estimators.side_by_side(sums, keys, list(moments)), keys
        )
    else:
        moments = estimators.adjusted_moments(model.covariates)
        rows = estimators.centred(matched, ["study_id"], model.covariates)
        sums = resampled_sums(rows, moments, spec)
        estimates = estimators.finish_adjusted(
            estimators.side_by_side(sums, keys, list(moments)), keys, len(model.covariates)
        )
    return estimates.select("study_id", "rep", "estimate").filter("estimate is not null")


def intervals(estimates: DataFrame) -> DataFrame:
    """Standard error and percentile interval from the replicates of each study."""
    return (
        estimates.groupBy("study_id")
        .agg(
            F.count("*").alias("n_reps"),
            F.stddev_pop("estimate").alias("std_error"),
            F.expr("percentile(estimate, array(0.025D, 0.975D))").alias("bounds"),
        )
        .selectExpr(
            "study_id", "n_reps", "std_error", "bounds[0] as ci_low", "bounds[1] as ci_high"
        )
    )


def with_intervals(points: DataFrame, estimates: DataFrame) -> DataFrame:
    """Point estimates with standard error and interval; without replicates 0 and the point."""
    return points.join(intervals(estimates), "study_id", "left").selectExpr(
        *points.columns, "coalesce(n_reps, 0L) as n_reps",
        "coalesce(std_error, 0D) as std_error",
        "coalesce(ci_low, estimate) as ci_low", "coalesce(ci_high, estimate) as ci_high",
    )


def confidence(matched: DataFrame, model: str, spec: Bootstrap) -> DataFrame:
    """Estimate, standard error and interval of ``model`` per study."""
    return confidence_of(matched, estimators.MODELS[model], spec)


def confidence_of(
    matched: DataFrame, model: estimators.Contrast | estimators.Adjusted, spec: Bootstrap
) -> DataFrame:
    return with_intervals(
        estimators.effect_of(matched, model), replicates_of(matched, model, spec)
    )
