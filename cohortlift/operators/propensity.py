"""Propensity scores of all studies at once by Newton's method on summed statistics."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from cohortlift.functions import linalg
from cohortlift.operators.pinning import pin

COVARIATES = ("age", "risk_score", "prior_cost")

# Fixed values of the fit: step limit, weight floor, Hessian ridge, score clip.
MAX_STEPS = 25
WEIGHT_FLOOR = "1e-6"
RIDGE = "1e-6"
CLIP = ("0.01D", "0.99D")

_SIZE = len(COVARIATES) + 1


def covariate_moments(features: DataFrame) -> DataFrame:
    """Mean and population standard deviation of each covariate per study."""
    return features.groupBy("study_id").agg(
        *(F.avg(c).alias(f"mean_{c}") for c in COVARIATES),
        *(F.stddev_pop(c).alias(f"sd_{c}") for c in COVARIATES),
    )


def _z(covariate: str) -> str:
    return f"({covariate} - mean_{covariate}) / (sd_{covariate} + 1e-9)"


def standardize(features: DataFrame) -> DataFrame:
    """Add ``z_<covariate>`` columns, standardised within the study."""
    moments = pin(covariate_moments(features))
    return features.join(moments, "study_id").selectExpr(
        *features.columns, *(f"{_z(c)} as z_{c}" for c in COVARIATES)
    )


def fit_propensity(features: DataFrame, max_iter: int = MAX_STEPS, tol: float = 1e-12) -> DataFrame:
    """Logistic regression of treatment on the covariates: one coefficient row per study.

    Each step is one aggregation of 14 sums per study followed by a 4x4 solve on those sums;
    a study stops moving once its own largest step is below ``tol``, so its fit does not
    depend on which other studies run beside it.
    """
    rows = features.select("study_id", "treatment", *COVARIATES).persist(
        StorageLevel.MEMORY_AND_DISK
    )
    try:
        state = pin(
            covariate_moments(rows).selectExpr(
                "*", *(f"0D as b{i}" for i in range(_SIZE)), "true as moving"
            )
        )
        for _ in range(max_iter):
            if not state.filter("moving").take(1):
                break
            state = pin(_newton_step(rows, state, tol))
    finally:
        rows.unpersist()
    return state.drop("moving")


def _newton_step(rows: DataFrame, state: DataFrame, tol: float) -> DataFrame:
    z = ["1D", *(f"z{i}" for i in range(1, _SIZE))]
    eta = " + ".join(["b0", *(f"b{i} * z{i}" for i in range(1, _SIZE))])
    scored = (
        rows.join(state.filter("moving"), "study_id")
        .selectExpr(
            "study_id", "treatment", *(f"b{i}" for i in range(_SIZE)),
            *(f"{_z(c)} as z{i}" for i, c in enumerate(COVARIATES, 1)),
        )
        .selectExpr("*", f"1D / (1D + exp(-({eta}))) as p")
        .selectExpr("*", f"greatest(p * (1D - p), {WEIGHT_FLOOR}) as w", "treatment - p as r")
    )
    sums = {f"g{i}": f"sum(r * {z[i]})" for i in range(_SIZE)}
    sums |= {f"h{i}_{j}": f"sum(w * {z[i]} * {z[j]})" for i in range(_SIZE) for j in range(i + 1)}
    totals = scored.groupBy("study_id").agg(*(F.expr(sql).alias(n) for n, sql in sums.items()))

    def entry(i: int, j: int) -> str:
        return f"(h{i}_{j} + {RIDGE})" if i == j else f"h{i}_{j}"

    steps = linalg.factor(_SIZE, entry) + linalg.solve([f"g{i}" for i in range(_SIZE)], "s")
    solved = totals.selectExpr("study_id", *linalg.select_list(steps)).select(
        "study_id", *(f"s{i}" for i in range(_SIZE))
    )
    largest = ", ".join(f"abs(s{i})" for i in range(_SIZE))
    fixed = [c for c in state.columns if c != "moving" and c not in {f"b{i}" for i in range(_SIZE)}]
    return state.join(solved, "study_id", "left").selectExpr(
        *fixed, *(f"if(moving, b{i} + s{i}, b{i}) as b{i}" for i in range(_SIZE)),
        f"moving and coalesce(greatest({largest}) >= {tol!r}D, false) as moving",
    )


def score(features: DataFrame, coefficients: DataFrame) -> DataFrame:
    """Add the clipped propensity score ``ps``; null where a covariate is missing or the study has no fit."""
    eta = " + ".join(["b0", *(f"b{i} * ({_z(c)})" for i, c in enumerate(COVARIATES, 1))])
    return features.join(coefficients, "study_id").selectExpr(
        *features.columns,
        # Without the test a missing score would be clipped to the lower end.
        f"if(({eta}) is null, null, least(greatest(1D / (1D + exp(-({eta}))), {CLIP[0]}), {CLIP[1]})) as ps",
    )


def with_propensity(features: DataFrame) -> DataFrame:
    """``features`` with ``ps``, fitted here unless already present."""
    return features if "ps" in features.columns else score(features, fit_propensity(features))
