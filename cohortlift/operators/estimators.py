"""Treatment effects as functions of weighted sums per arm."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from cohortlift.functions import linalg
from cohortlift.operators.pinning import pin
from cohortlift.operators.propensity import COVARIATES

#: A pivot this small against its diagonal means the covariates do not identify the effect.
PIVOT_FLOOR = 1e-12


@dataclass(frozen=True)
class Contrast:
    """Weighted mean of ``outcome`` over treated minus that over control rows."""

    outcome: str


@dataclass(frozen=True)
class Adjusted:
    """Coefficient of treatment in weighted least squares of post_outcome on ``covariates``."""

    covariates: tuple[str, ...]


MODELS: dict[str, Contrast | Adjusted] = {
    "att": Contrast("post_outcome"),
    "ate": Contrast("post_outcome"),
    "did": Contrast("post_outcome - pre_outcome"),
    "gee": Adjusted(COVARIATES),
    "mixed": Adjusted(("pre_outcome", *COVARIATES)),
    "lme_mixed": Contrast("post_outcome - pre_outcome"),
    "lme_growth": Contrast("slope"),
}


def contrast_moments(outcome: str) -> dict[str, str]:
    """Sums of a weighted mean; a row whose outcome is null takes part in neither."""
    return {"w": f"if(({outcome}) is null, null, weight)", "wy": f"weight * ({outcome})"}


def adjusted_moments(covariates: Sequence[str]) -> dict[str, str]:
    """Sums needed for the regression, of columns already centred as c_<name>.

    ``centred`` leaves all of them null in a row that misses one, so such a row takes part in no sum.
    """
    z = [f"c_{name}" for name in covariates]
    moments = {"w": "if(c_post_outcome is null, null, weight)", "wy": "weight * c_post_outcome"}
    for i, zi in enumerate(z):
        moments[f"wz{i}"] = f"weight * {zi}"
        moments[f"wzy{i}"] = f"weight * {zi} * c_post_outcome"
        for j in range(i + 1):
            moments[f"wzz{i}_{j}"] = f"weight * {zi} * {z[j]}"
    return moments


def centred(matched: DataFrame, keys: Sequence[str], covariates: Sequence[str]) -> DataFrame:
    """Add ``c_<name>`` for covariates and outcome: the value less its group mean over complete rows,
    null in a row that misses any of them.

    The effect does not depend on the shift; the sums lose far fewer digits with it.  The mean is cut to single
    precision, which takes away the last digits, where it depends on the order of rows.
    """
    names = [*covariates, "post_outcome"]
    complete = " and ".join(f"{n} is not null" for n in names)
    means = pin(matched.groupBy(*keys).agg(*(F.expr(f"cast(cast(avg(if({complete}, {n}, null)) as float) as double)").alias(f"_m_{n}") for n in names)))
    return matched.join(means, list(keys)).selectExpr(
        *matched.columns, *(f"if({complete}, {n} - _m_{n}, null) as c_{n}" for n in names)
    )


def arm_sums(matched: DataFrame, keys: Sequence[str], moments: dict[str, str]) -> DataFrame:
    """Sum of every moment per group and arm."""
    return matched.groupBy(*keys, "treatment").agg(
        *(F.expr(f"sum({sql})").alias(name) for name, sql in moments.items())
    )


def side_by_side(sums: DataFrame, keys: Sequence[str], moments: Sequence[str]) -> DataFrame:
    """Sums of both arms in one row: ``<moment>_t`` and ``<moment>_c``."""
    return sums.groupBy(*keys).agg(
        *(
            F.expr(f"sum(if(treatment = {arm}, {name}, null))").alias(f"{name}_{suffix}")
            for name in moments for arm, suffix in ((1, "t"), (0, "c"))
        )
    )


def finish_contrast(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    return sums.selectExpr(
        *keys, "try_divide(wy_t, w_t) as mean_treated", "try_divide(wy_c, w_c) as mean_control",
        "try_divide(wy_t, w_t) - try_divide(wy_c, w_c) as estimate",
    )


def finish_adjusted(sums: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """Effect from within-arm covariances: difference of means less the part covariates explain."""

    def within(product: str, a: str, b: str) -> str:
        return " + ".join(
            f"({product}_{arm} - try_divide({a}_{arm} * {b}_{arm}, w_{arm}))" for arm in "tc"
        )

    def gap(total: str) -> str:
        return f"(try_divide({total}_t, w_t) - try_divide({total}_c, w_c))"

    matrix = {
        f"s{i}_{j}": within(f"wzz{i}_{j}", f"wz{i}", f"wz{j}")
        for i in range(size) for j in range(i + 1)
    }
    cross = {f"q{i}": within(f"wzy{i}", f"wz{i}", "wy") for i in range(size)}
    gaps = {f"g{i}": gap(f"wz{i}") for i in range(size)}
    steps = [("gap_y", gap("wy")), *(matrix | cross | gaps).items()]
    steps += linalg.factor(size, lambda i, j: f"s{i}_{j}", PIVOT_FLOOR)
    steps += linalg.forward([f"q{i}" for i in range(size)], "u")
    steps += linalg.forward([f"g{i}" for i in range(size)], "v")
    explained = " + ".join(f"try_divide(u{i} * v{i}, _d{i})" for i in range(size))
    steps.append(("estimate", f"gap_y - ({explained})"))
    solved = sums.selectExpr(*keys, *linalg.select_list(steps)).select(*keys, "estimate")
    # One row per key already: this aggregation shuffles nothing, but stops later filters from
    # being pushed into the solver, where every step would be substituted into the next.
    return solved.groupBy(*keys).agg(F.max("estimate").alias("estimate"))


def effect(matched: DataFrame, model: str, keys: Sequence[str] = ("study_id",)) -> DataFrame:
    """Point estimate of ``model`` per group."""
    return effect_of(matched, MODELS[model], keys)


def effect_of(
    matched: DataFrame, spec: Contrast | Adjusted, keys: Sequence[str] = ("study_id",)
) -> DataFrame:
    if isinstance(spec, Contrast):
        moments = contrast_moments(spec.outcome)
        sums = side_by_side(arm_sums(matched, keys, moments), keys, list(moments))
        return finish_contrast(sums, keys).select(*keys, "estimate")
    moments = adjusted_moments(spec.covariates)
    rows = centred(matched, keys, spec.covariates)
    sums = side_by_side(arm_sums(rows, keys, moments), keys, list(moments))
    return finish_adjusted(sums, keys, len(spec.covariates))


def weighted_means(matched: DataFrame, column: str, keys: Sequence[str] = ("study_id",)) -> DataFrame:
    """Weighted mean of ``column`` per group and arm; null where the weights sum to 0."""
    return arm_sums(matched, keys, contrast_moments(column)).selectExpr(
        *keys, "treatment", "try_divide(wy, w) as weighted_mean"
    )


def naive_effect(cohort: DataFrame) -> DataFrame:
    """Unweighted difference of raw post outcomes."""
    return _raw_contrast(cohort, "post_outcome")


def naive_panel(panel: DataFrame) -> DataFrame:
    """Unweighted difference of outcomes over all periods after baseline."""
    return _raw_contrast(panel.filter("period >= 1"), "outcome")


def _raw_contrast(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy("study_id").agg(
        F.expr(
            f"avg(if(treatment = 1, {column}, null)) - avg(if(treatment = 0, {column}, null))"
        ).alias("naive_estimate")
    )
