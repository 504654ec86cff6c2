"""Small frames of set values, and yardsticks that state what a right answer satisfies."""

from bisect import bisect_left

import numpy as np
import pandas as pd

from cohortlift.schemas import COHORT, PANEL

COVARIATES = ["age", "risk_score", "prior_cost"]


def study(name, n_treated, n_control, seed, effect=-10.0):
    """Rows laid out on low-discrepancy steps (multiples of square roots, fractions kept); ``seed`` shifts them."""
    n = n_treated + n_control
    at = np.arange(1, n + 1)

    def spread(root):
        return (at * np.sqrt(root) + seed / 97) % 1

    treatment = (at <= n_treated).astype("int32")
    age = 30 + 50 * spread(2) + 4 * treatment
    risk = 0.4 + 2 * spread(3) ** 2 + 0.2 * treatment
    cost = 2000 + 11000 * spread(5) + 700 * treatment
    pre = 2500 + 0.3 * cost + 300 * risk + 900 * (spread(7) + spread(11) - 1)
    post = 0.9 * pre + 5 * age + effect * treatment + 800 * (spread(13) + spread(17) - 1)
    return pd.DataFrame({
        "study_id": name, "patient_id": np.argsort(np.argsort(spread(19))) + 1, "treatment": treatment, "age": age,
        "risk_score": risk, "prior_cost": cost, "pre_outcome": pre, "post_outcome": post,
    })


def cohort(spark, pdf):
    return spark.createDataFrame(pdf[[f.name for f in COHORT]], COHORT)


def panel(spark, rows):
    return spark.createDataFrame(rows, PANEL)


def score_gaps(pdf, ps):
    """How far propensities are from a logistic fit: their logits must be linear in the covariates, and
    residuals orthogonal to each of them.  Returns both gaps, each relative to its scale."""
    x = pdf[COVARIATES].to_numpy(float)
    x = np.column_stack([np.ones(len(x)), (x - x.mean(axis=0)) / x.std(axis=0)])
    logits = np.log(ps / (1 - ps))
    linear = logits - x @ np.linalg.pinv(x) @ logits
    residual = pdf["treatment"].to_numpy(float) - ps
    return np.abs(linear).max(), np.abs(x.T @ residual).max() / len(pdf)


def nearest_controls(pdf, ps):
    """control patient_id for each treated patient_id by search in sorted scores, ties to the least id."""
    scored = sorted(zip(ps, pdf.patient_id, pdf.treatment))
    controls = [(score, int(pid)) for score, pid, arm in scored if arm == 0]
    keys = [score for score, _ in controls]
    found = {}
    for score, pid, arm in scored:
        if arm == 1:
            at = bisect_left(keys, score)
            near = []
            if at < len(keys):
                near.append((keys[at] - score, controls[at][1]))
            if at:  # the first of the equal scores below
                first = bisect_left(keys, keys[at - 1])
                near.append((score - keys[at - 1], controls[first][1]))
            found[int(pid)] = min(near)[1]
    return found


def wls_effect(pdf, covariates):
    """Effect by residualising: treatment and outcome less what covariates explain of them, weighted."""
    weight = pdf["weight"].to_numpy(float)
    design = np.column_stack([np.ones(len(pdf)), pdf[covariates].to_numpy(float)])
    gram = design.T @ (design * weight[:, None])

    def rest(values):
        return values - design @ np.linalg.solve(gram, design.T @ (weight * values))

    treated = rest(pdf["treatment"].to_numpy(float))
    return float(np.sum(weight * treated * pdf["post_outcome"].to_numpy(float)) / np.sum(weight * treated**2))
