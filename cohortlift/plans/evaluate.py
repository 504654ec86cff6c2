"""Whole runs: all studies from raw rows to result tables."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import NullType

from cohortlift.functions.text import utc_now
from cohortlift.operators import quality, ranks, routing, selection
from cohortlift.operators.bootstrap import Bootstrap
from cohortlift.operators.matching import matched_counts
from cohortlift.operators.pinning import pin, stage
from cohortlift.plans.dispatch import (
    dispatch_features, dispatch_matching, dispatch_model, labelled_features, stage_features,
)
from cohortlift.plans.registry import Registry
from cohortlift.plans.steps import Steps
from cohortlift.schemas import (
    EVALUATION_RESULTS, EVALUATION_RESULTS_BASE, PE_EVALUATION_RESULTS, PE_STEP_LOG,
)
from cohortlift.sources.sinks import conform
from cohortlift.sources.stamps import stamp_value

#: Resampling of the two tracks: within arms, and over all matched rows.
AFTER_BOOTSTRAP = Bootstrap(seed=7, by_arm=True)
MODULAR_BOOTSTRAP = Bootstrap(seed=0, by_arm=False)

_PANEL = "model_family in ('lme_mixed', 'lme_growth')"


@dataclass
class Run:
    """Stage tables of one run."""

    status: DataFrame
    features: DataFrame
    matched: DataFrame
    counts: DataFrame = field(init=False)

    def __post_init__(self) -> None:
        self.counts = pin(matched_counts(self.matched))


def stage_rows(table: DataFrame | None, studies: DataFrame | None, name: str) -> DataFrame | None:
    """The rows of ``studies``, or all, written once: status, stamps, medians and features each read them,
    and the table given may be the plan of a long derivation."""
    if table is None:
        return None
    rows = table if studies is None else selection.study_slice(table, studies)
    void = [f.name for f in rows.schema if isinstance(f.dataType, NullType)]  # which no file can hold
    return stage(rows.withColumns({c: F.col(c).cast("string") for c in void}), name)


def build_status(cohort: DataFrame, panel: DataFrame | None, config: DataFrame) -> DataFrame:
    """Config, method names, quality score, naive contrast and gate decision of every study."""
    methods = pin(selection.with_methods(config))
    singles = selection.study_slice(cohort, methods.filter(f"not {_PANEL}"))
    scores = quality.profile_cohort(quality.clean(singles))
    if panel is not None:
        longitudinal = selection.study_slice(panel, methods.filter(_PANEL))
        scores = scores.unionByName(quality.profile_panel(quality.clean(longitudinal)))
    return pin(quality.gate(scores, methods))


def prepare(
    cohort: DataFrame, panel: DataFrame | None, config: DataFrame, registry: Registry
) -> Run:
    """Gate, features and matching of all studies; stages are written once and read back."""
    status = build_status(cohort, panel, config)
    methods = status.filter("quality_passed")
    clean_panel = None if panel is None else quality.clean(panel)
    features = stage_features(
        dispatch_features(quality.clean(cohort), clean_panel, methods, registry), methods
    )
    matched = stage(dispatch_matching(features, methods, registry), "matched")
    return Run(status, features, matched)


def evaluate(
    cohort: DataFrame, panel: DataFrame | None, config: DataFrame, *,
    study_ids: str | None = None, bootstrap: Bootstrap = AFTER_BOOTSTRAP,
    registry: Registry | None = None, source: str = "after", run_ts: str | None = None,
    job_run_id: str | None = None, stamped: bool = False,
) -> DataFrame:
    """Result rows of every selected study that passes the gate."""
    registry = registry or Registry()
    selected = pin(selection.select_studies(config, study_ids))
    # A stamp is one of the whole table.
    cohort = stage_rows(cohort, None if stamped else selected, "cohort")
    panel = stage_rows(panel, None if stamped else selected, "panel")
    run = prepare(cohort, panel, selected, registry)
    methods = run.status.filter("quality_passed")
    effects = dispatch_model(run.matched, methods, registry, bootstrap)
    config_version = stamp_value(config) if stamped else None
    cohort_version = stamp_value(cohort) if stamped else None
    panel_version = stamp_value(panel) if stamped else None
    rows = (
        effects.join(methods.select("study_id", "matching_method", "model_family", "naive_estimate"), "study_id")
        .join(run.counts, "study_id", "left")
        .withColumn("config_version", F.lit(config_version))
        .withColumn(
            "data_version", F.when(F.expr(_PANEL), F.lit(panel_version)).otherwise(F.lit(cohort_version))
        )
        .withColumn("job_run_id", F.lit(job_run_id))
        .selectExpr(
            "study_id", f"{utc_now(run_ts)} as run_ts", "matching_method", "model_method",
            "coalesce(n_treated, 0L) as n_treated", "coalesce(n_control, 0L) as n_control",
            "round(estimate, 3) as estimate", "round(std_error, 3) as std_error",
            "round(ci_low, 3) as ci_low", "round(ci_high, 3) as ci_high",
            # The growth model has no naive contrast of its own and repeats the estimate.
            "round(if(model_method = 'lme_growth', estimate, naive_estimate), 3) as naive_estimate",
            "ci_low > 0 or ci_high < 0 as significant", f"'{source}' as source",
            "config_version", "data_version", "job_run_id",
        )
    )
    return conform(rows, EVALUATION_RESULTS if stamped or source == "modular" else EVALUATION_RESULTS_BASE)


def evaluate_before(
    cohort: DataFrame, config: DataFrame, *, run_ts: str | None = None
) -> DataFrame:
    """Estimates without intervals, for the studies one of the four fixed branches covers."""
    registry = Registry()
    config = pin(config)
    cohort = stage_rows(cohort, config, "cohort")
    # This track always fills with the study median, whatever the configured feature method.
    status = build_status(cohort, None, config).withColumn("feature_method", F.lit("standard"))
    methods = pin(routing.route_before(status).filter("branch is not null"))
    features = stage_features(
        dispatch_features(quality.clean(cohort), None, methods, registry), methods
    )
    matched = stage(dispatch_matching(features, methods, registry), "matched")
    rows = (
        dispatch_model(matched, methods, registry, None)
        .join(methods.select("study_id", "matching_method"), "study_id")
        .join(matched_counts(matched), "study_id", "left")
        .selectExpr(
            "study_id", f"{utc_now(run_ts)} as run_ts", "matching_method", "model_method",
            "coalesce(n_treated, 0L) as n_treated", "coalesce(n_control, 0L) as n_control",
            "round(estimate, 3) as estimate", "'before' as source",
        )
    )
    return conform(rows, EVALUATION_RESULTS_BASE)


@dataclass
class PhasedRun:
    """Outcome of the phase router for all its studies."""

    results: DataFrame
    step_log: DataFrame
    traces: DataFrame
    steps: Steps


def evaluate_phases(
    cohort: DataFrame, config: DataFrame, *, bootstrap: Bootstrap = MODULAR_BOOTSTRAP,
    run_id: str = "manual", environment: str = "dev", run_ts: str | None = None,
) -> PhasedRun:
    """Run the feature, matching and model phases each study's config and data lead it to."""
    registry, steps = Registry(), Steps()
    config = pin(config)
    _reject_unknown_phases(config)
    rows = steps.timed("features", lambda: stage_rows(cohort, config, "cohort"))
    status = steps.timed("features", lambda: pin(routing.next_phase(build_status(rows, None, config))))
    passed = status.filter("quality_passed")
    features = steps.stage("features", lambda: labelled_features(
        dispatch_features(quality.clean(rows), None, passed, registry), passed
    ), "features", by="matching_method")
    differences = ranks.paired_differences(
        selection.study_slice(features, passed.filter("model_type = 'wilcoxon'"))
    )
    routes = steps.timed("ranks", lambda: pin(ranks.fallback_route(ranks.skewness(differences), passed)))
    # Skewed studies go on with the effect model that their fallback names.
    rerouted = routes.filter("routed and model_phase in ('model_att', 'model_did')").selectExpr(
        "study_id", "substr(model_phase, 7) as model_method"
    )
    effects_of = pin(
        passed.filter("model_type in ('att', 'did')").unionByName(
            passed.drop("model_method").join(rerouted, "study_id"), allowMissingColumns=True
        )
    )
    to_match = pin(
        passed.filter("nextphase = 'matching'").select("study_id").union(effects_of.select("study_id")).distinct()
        .join(passed, "study_id")
    )
    matched = steps.stage("matching", lambda: dispatch_matching(
        selection.study_slice(features, to_match), to_match, registry
    ), "matched")
    counts = steps.timed("matching", lambda: pin(matched_counts(matched)))
    effects = steps.timed("effects", lambda: pin(
        dispatch_model(
            selection.study_slice(matched, effects_of), effects_of, registry, bootstrap
        ).join(effects_of.select("study_id", "matching_method"), "study_id").join(counts, "study_id", "left")
    ))

    ranked = steps.timed("ranks", lambda: pin(
        ranks.rank_or_sign(
            selection.study_slice(features, passed.filter("model_type = 'wilcoxon'")), passed
        ).unionByName(_sign_only(features, passed.filter("model_type = 'sign_test'")))
    ))
    results = effects.selectExpr(
        "study_id", "model_method", "matching_method", "round(estimate, 3) as estimate",
        "round(std_error, 3) as std_error", "round(ci_low, 3) as ci_low",
        "round(ci_high, 3) as ci_high", "cast(null as double) as p_value",
        "n_treated", "n_control",
    ).unionByName(
        ranked.selectExpr(
            "study_id", "model_method", "'none' as matching_method",
            "round(estimate, 3) as estimate", "cast(null as double) as std_error",
            "cast(null as double) as ci_low", "cast(null as double) as ci_high",
            "round(p_value, 5) as p_value", "n_treated", "cast(null as bigint) as n_control",
        )
    )
    stamp = (
        f"'{run_id}' as run_id", f"'{environment}' as pe_environment", f"{utc_now(run_ts)} as ts",
    )
    results = conform(results.selectExpr("*", *stamp), PE_EVALUATION_RESULTS)
    log = step_rows(status, counts, effects, routes, ranked, len(cohort.columns), steps.seconds)
    return PhasedRun(
        results, conform(log.selectExpr("*", *stamp), PE_STEP_LOG),
        routing.phase_trace(status, routes), steps,
    )


_PHASES = ("att", "did", "wilcoxon", "sign_test")


def _reject_unknown_phases(config: DataFrame) -> None:
    """Every model_type must be a known one, and every fallback a known model other than the rank test."""
    known = F.coalesce(F.col("model_type").isin(*_PHASES), F.lit(False))
    fallback = F.coalesce(F.nullif(F.col("fallback_model"), F.lit("")), F.lit("None"))
    ends = fallback.isin("None", "model_att", "model_did", "model_sign_test")
    bad = config.filter(~known | ((F.col("model_type") == "wilcoxon") & ~ends)).select("study_id").collect()
    if bad:
        raise ValueError(f"unknown model_type or fallback_model: {', '.join(sorted(str(r.study_id) for r in bad))}")


def _sign_only(features: DataFrame, chosen: DataFrame) -> DataFrame:
    differences = ranks.paired_differences(selection.study_slice(features, chosen))
    return (
        ranks.sign_test(differences)
        .join(ranks.median_difference(differences), "study_id")
        .selectExpr(
            "study_id", "'sign_test' as model_method", "estimate", "p_value", "n_treated"
        )
    )


def step_rows(
    status: DataFrame, counts: DataFrame, effects: DataFrame, routes: DataFrame,
    ranked: DataFrame, n_columns: int, seconds: dict[str, float],
) -> DataFrame:
    """One row per study and phase: what it did, on how many rows, for how long, where it went next.

    A step runs for all studies at once, so its studies share its ``seconds``.  Step names and descriptions are fixed texts: their wording is part of the results.
    """
    null_text, null_count = "cast(null as string)", "cast(null as bigint)"
    first = status.selectExpr(
        "study_id", "'1' as step_id", "'Feature Engineering & Data Standardization' as step_name",
        "if(quality_passed, 'PASS', 'FAIL') as status",
        "concat('quality=', coalesce(cast(quality_score as string), 'nan'), ' threshold=',"
        " min_quality_score, '; nextphase=', nextphase) as pass_description",
        "if(quality_passed, null, concat('quality ', coalesce(cast(quality_score as string), 'nan'),"
        " ' below ', min_quality_score)) as error_msg",
        "coalesce(n_total, 0L) as n_input", "coalesce(n_treated, 0L) as n_treated",
        f"{n_columns} as n_columns",
    )
    second = (
        status.filter("nextphase = 'matching'")
        .select("study_id", "matching_method", "n_total")
        .join(counts, "study_id", "left")
        .selectExpr(
            "study_id", "'2' as step_id", "'Matching' as step_name", "'PASS' as status",
            "concat('method=', matching_method, '; matched ', coalesce(n_treated, 0L),"
            " ' treated / ', coalesce(n_control, 0L), ' control') as pass_description",
            f"{null_text} as error_msg", "n_total as n_input",
            "coalesce(n_treated, 0L) as n_treated", "cast(null as int) as n_columns",
        )
    )
    third = effects.join(routes.filter("routed").select("study_id", "routed"), "study_id", "left").selectExpr(
        "study_id", "if(routed, '3b', '3') as step_id", "concat('Modeling (', model_method, ')') as step_name",
        "'PASS' as status",
        "concat(if(model_method = 'att', 'ATT', 'DiD'), ' estimate=',"
        " coalesce(format_number(estimate, 2), 'n/a'), ' CI[', coalesce(format_number(ci_low, 1), 'n/a'),"
        " ',', coalesce(format_number(ci_high, 1), 'n/a'), ']') as pass_description",
        f"{null_text} as error_msg", f"{null_count} as n_input", "n_treated",
        "cast(null as int) as n_columns",
    )
    routed = routes.filter("routed").selectExpr(
        "study_id", "'3' as step_id", "'Modeling (wilcoxon)' as step_name", "'ROUTED' as status",
        "concat('symmetry assumption violated (skew=', format_number(skew, 2),"
        " '); routing to ', model_phase) as pass_description",
        f"{null_text} as error_msg", f"{null_count} as n_input", "n_treated",
        "cast(null as int) as n_columns",
    )
    tested = ranked.selectExpr(
        "study_id", "if(model_method = 'wilcoxon', '3', '3b') as step_id",
        "if(model_method = 'wilcoxon', 'Modeling (wilcoxon)',"
        " 'Modeling (sign_test, fallback)') as step_name",
        "'PASS' as status",
        "concat('median diff=', format_number(estimate, 1), ' p=',"
        " coalesce(format_number(p_value, 5), 'None'),"
        " if(model_method = 'wilcoxon', '', ' (fallback from wilcoxon)')) as pass_description",
        f"{null_text} as error_msg", f"{null_count} as n_input", "n_treated",
        "cast(null as int) as n_columns",
    )
    parts = (("features", first), ("matching", second), ("effects", third), ("ranks", routed), ("ranks", tested))
    timed = [part.withColumn("execution_time", F.lit(float(seconds[step]))) for step, part in parts]
    return reduce(lambda a, b: a.unionByName(b), timed)
