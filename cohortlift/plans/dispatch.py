"""Applying each study's methods: one pass per distinct method, not per study."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from cohortlift.operators import bootstrap as boot
from cohortlift.operators import estimators, features as feats
from cohortlift.operators.pinning import pin, stage
from cohortlift.operators.propensity import with_propensity
from cohortlift.operators.selection import study_slice
from cohortlift.plans.registry import IMPUTATIONS, Registry
from cohortlift.schemas import FEATURES
from cohortlift.sources.sinks import conform

_SCORED = ("knn", "ipw")


def _names(methods: DataFrame, column: str) -> list[str]:
    return sorted(row[0] or "" for row in methods.select(column).distinct().collect())


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def dispatch_features(
    cohort: DataFrame, panel: DataFrame | None, methods: DataFrame, registry: Registry
) -> DataFrame:
    """Feature rows of all studies, imputed or built by each study's feature_method."""
    names = _names(methods, "feature_method")
    registry.reject_unknown("feature", names)
    if panel is None and "panel" in names:
        raise ValueError("panel studies need a panel table")
    parts = []
    imputed = [n for n in names if n in IMPUTATIONS and n not in registry.feature]
    if imputed:
        chosen = methods.filter(F.col("feature_method").isin(imputed))
        parts.append(feats.impute(study_slice(cohort, chosen), chosen))
    for name in names:
        chosen = methods.filter(F.col("feature_method") == name)
        if name in registry.feature:
            parts.append(registry.run("feature", name, study_slice(cohort, chosen)))
        elif name == "panel":
            parts.append(feats.panel_features(study_slice(panel, chosen), chosen))
    if not parts:
        parts.append(cohort.limit(0))
    return _union([conform(part, FEATURES) for part in parts])


def dispatch_matching(features: DataFrame, methods: DataFrame, registry: Registry) -> DataFrame:
    """Matched rows of all studies; knn and ipw share one propensity fit.

    Features staged with their ``matching_method`` are read once in total: each method scans
    only its own partitions.
    """
    names = _names(methods, "matching_method")
    registry.reject_unknown("matching", names)

    def rows_of(table: DataFrame, *wanted: str) -> DataFrame:
        if "matching_method" in table.columns:
            return table.filter(F.col("matching_method").isin(*wanted)).drop("matching_method")
        return study_slice(table, methods.filter(F.col("matching_method").isin(*wanted)))

    users = [name for name in names if name in _SCORED]
    scored = with_propensity(rows_of(features, *users)) if users else None
    parts = []
    for name in names:
        if name not in users:
            source = rows_of(features, name)
        elif len(users) == 1:
            source = scored
        else:
            source = study_slice(scored, methods.filter(F.col("matching_method") == name))
        parts.append(registry.run("matching", name, source))
    if not parts:
        parts.append(registry.run("matching", "none", features.limit(0).drop("matching_method")))
    return _union(parts)


def labelled_features(features: DataFrame, methods: DataFrame) -> DataFrame:
    """Feature rows with the matching method of their study."""
    return features.join(methods.select("study_id", "matching_method"), "study_id")


def stage_features(features: DataFrame, methods: DataFrame) -> DataFrame:
    """Feature rows as a table partitioned by the matching method of their study."""
    return stage(labelled_features(features, methods), "features", by="matching_method")


def dispatch_model(
    matched: DataFrame, methods: DataFrame, registry: Registry, spec: boot.Bootstrap | None
) -> DataFrame:
    """One row per study: estimate with interval, or without when ``spec`` is None.

    All models that contrast weighted means run in one pass over their studies.
    """
    names = _names(methods, "model_method")
    registry.reject_unknown("model", names)
    own = [n for n in names if n in registry.model]
    contrasts = [
        n for n in names if n not in own and isinstance(estimators.MODELS[n], estimators.Contrast)
    ]
    jobs: list[tuple[DataFrame, estimators.Contrast | estimators.Adjusted]] = []
    if contrasts:
        chosen = methods.filter(F.col("model_method").isin(contrasts))
        cases = " ".join(
            f"when '{name}' then {estimators.MODELS[name].outcome}" for name in contrasts
        )
        rows = matched.join(chosen.select("study_id", "model_method"), "study_id").withColumn(
            "_outcome", F.expr(f"case model_method {cases} end")
        )
        jobs.append((rows, estimators.Contrast("_outcome")))
    for name in names:
        if name not in own and name not in contrasts:
            chosen = methods.filter(F.col("model_method") == name)
            jobs.append((study_slice(matched, chosen), estimators.MODELS[name]))
    parts = []
    for rows, model in jobs:
        if spec is None:
            parts.append(
                estimators.effect_of(rows, model).selectExpr(
                    "*", *(f"cast(null as double) as {c}" for c in ("std_error", "ci_low", "ci_high"))
                )
            )
        else:
            parts.append(boot.confidence_of(rows, model, spec).drop("n_reps"))
    for name in own:
        chosen = methods.filter(F.col("model_method") == name)
        leaf = registry.run("model", name, study_slice(matched, chosen))
        parts.append(leaf.select("study_id", "estimate", "std_error", "ci_low", "ci_high"))
    if not parts:
        parts.append(estimators.effect(matched, "att").selectExpr(
            "*", *(f"cast(null as double) as {c}" for c in ("std_error", "ci_low", "ci_high"))))
    return pin(_union(parts)).join(methods.select("study_id", "model_method"), "study_id")
