"""Choosing studies and the methods each of them uses."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

_DEFAULTS = {"active": "true", "performance_months": "3L", "model_family": "'standard'"}


def with_defaults(config: DataFrame) -> DataFrame:
    """Add columns an older config table may lack: active studies, three performance periods."""
    missing = [name for name in _DEFAULTS if name not in config.columns]
    return config.selectExpr("*", *(f"{_DEFAULTS[name]} as {name}" for name in missing))


def select_studies(config: DataFrame, study_ids: str | None = None) -> DataFrame:
    """Active studies, or exactly the comma-separated ``study_ids`` whatever their flag."""
    config = with_defaults(config)
    wanted = [name.strip() for name in (study_ids or "").split(",") if name.strip()]
    return config.filter(F.col("study_id").isin(wanted) if wanted else F.col("active"))


def with_family(config: DataFrame) -> DataFrame:
    """Replace a null or empty model family by ``standard``."""
    return with_defaults(config).withColumn(
        "model_family", F.expr("coalesce(nullif(model_family, ''), 'standard')")
    )


def family_split(config: DataFrame) -> DataFrame:
    """Studies of each family as a sorted list, with their number."""
    return (
        with_family(config).groupBy("model_family")
        .agg(F.count("*").alias("n_studies"), F.sort_array(F.collect_list("study_id")).alias("studies"))
    )


def family_flags(config: DataFrame) -> DataFrame:
    """One row saying which families have work."""
    return with_family(config).agg(
        *(
            F.expr(f"coalesce(bool_or(model_family = '{family}'), false)").alias(f"has_{family}")
            for family in ("standard", "lme_mixed", "lme_growth")
        )
    )


def with_methods(config: DataFrame) -> DataFrame:
    """Columns feature_method, matching_method and model_method from any of the config layouts.

    A leaf name such as ``model_att`` names the method ``att``.  The two panel families bring
    their own features and model; the stratified matching leaf brings its own method.
    """
    config = with_family(config)
    columns = config.columns
    family_is_panel = "model_family in ('lme_mixed', 'lme_growth')"
    if "feature_method" in columns:
        feature = "feature_method"
    elif "feature_nb" in columns:
        feature = "regexp_replace(feature_nb, '^feature_', '')"
    else:
        feature = "'standard'"
    if "model_method" in columns:
        model = "model_method"
    elif "model_nb" in columns:
        model = "regexp_replace(model_nb, '^model_', '')"
    else:
        model = "model_type"
    matching = "matching_method"
    if "matching_nb" in columns:
        matching = (
            "if(matching_nb in ('matching_standard', 'matching_lme_mixed', 'matching_lme_growth'), "
            "matching_method, regexp_replace(matching_nb, '^matching_', ''))"
        )
    if "needs_matching" in columns:
        matching = f"if(needs_matching, {matching}, 'none')"
    return config.withColumns({
        "feature_method": F.expr(f"if({family_is_panel}, 'panel', {feature})"),
        "matching_method": F.expr(matching),
        "model_method": F.expr(f"if({family_is_panel}, model_family, {model})"),
    })


def study_methods(config: DataFrame) -> DataFrame:
    """The three method names of every study."""
    return with_methods(config).select(
        "study_id", "feature_method", "matching_method", "model_method"
    )


def missing_config(studies: DataFrame, config: DataFrame) -> DataFrame:
    """Studies that have data but no config row."""
    return studies.select("study_id").distinct().join(config, "study_id", "left_anti")


def config_of(studies: DataFrame, config: DataFrame) -> DataFrame:
    """Config row of each given study; raises when one has none."""
    absent = sorted(row.study_id or "null" for row in missing_config(studies, config).collect())
    if absent:
        raise LookupError(f"no config row for {', '.join(absent)}")
    return studies.select("study_id").distinct().join(config, "study_id")


def study_slice(table: DataFrame, studies: DataFrame, performance_only: bool = False) -> DataFrame:
    """Rows of the chosen studies; of a panel optionally without the baseline period."""
    if performance_only:
        table = table.filter("period >= 1")
    return table.join(studies.select("study_id"), "study_id", "left_semi")
