"""One query per operator over the tables of a scale-factor folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType

from cohortlift import schemas
from cohortlift.operators import (
    bootstrap as boot, estimators, features as feats, matching, propensity, quality, ranks, report,
    routing, selection, strata,
)
from cohortlift.operators.bootstrap import Bootstrap
from cohortlift.operators.pinning import pin, stage
from cohortlift.plans import evaluate as runs
from cohortlift.plans import record
from cohortlift.plans.dispatch import dispatch_features, dispatch_matching, dispatch_model
from cohortlift.plans.registry import Registry
from cohortlift.session import shared_dir
from cohortlift.sources import ids, manifests, publish, sinks, stamps, tables
from cohortlift.sources.studies import StudyTable
from workload import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]

RUN_TS = "2026-01-01T00:00:00+00:00"
KEYED = ("study_id", "patient_id")
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round doubles, so that only the order of float additions is hidden.

    Amounts are multiples of 0.0001; their means need more digits to stay clear of ties.
    """
    return df.select(
        *(
            F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, DoubleType) else F.col(f.name)
            for f in df.schema
        )
    )


def near(df: DataFrame, name: str, digits: int) -> DataFrame:
    """Round one column by steps that both engines compute alike, also for a value half-way between two."""
    return df.withColumn(name, F.expr(f"floor({name} * 1e{digits} + 0.5e0) / 1e{digits}"))


# --- shared inputs -------------------------------------------------------------------------

def seg_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.build_status(fx.cohorts(spark, sf_dir), None, fx.study_config(spark, sf_dir))


def seg_features(spark: SparkSession, sf_dir: str, name: str = "seg") -> DataFrame:
    """Imputed features of the segment studies that pass their gate."""
    methods = seg_status(spark, sf_dir).filter("quality_passed")
    cohort = fx.cohorts(spark, sf_dir)
    return stage(dispatch_features(cohort, None, methods, Registry()), name).drop("slope")


def panel_studies(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = selection.with_methods(fx.modular_config(spark, sf_dir))
    return pin(config.filter("model_family in ('lme_mixed', 'lme_growth')"))


def matched_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feats.panel_features(fx.panel(spark, sf_dir), panel_studies(spark, sf_dir))
    return stage(matching.match_knn(stage(rows, "panel")), "matched-panel")


def method_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The passing segment studies matched by each of the four methods."""
    rows = seg_features(spark, sf_dir)
    scored = propensity.with_propensity(rows)
    parts = {
        "exact": matching.match_exact(rows), "stratified": matching.match_stratified(rows),
        "ipw": matching.match_ipw(scored), "knn": matching.match_knn(scored),
    }
    return stage(
        reduce(
            lambda a, b: a.unionByName(b),
            (df.withColumn("matching_method", F.lit(name)) for name, df in parts.items()),
        ),
        "grid",
    )


def pe_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feats.impute_global(fx.pe_cohorts(spark, sf_dir))


def pe_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranks.paired_differences(fx.pe_cohorts(spark, sf_dir))


def simple_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over all segment studies without matching: att first, did a day later."""
    cohort = fx.cohorts(spark, sf_dir)
    matched = stage(matching.match_none(cohort), "unmatched")
    spec = Bootstrap(reps=300, seed=3, by_arm=True, scheme="poisson")
    counts = matching.matched_counts(matched)
    naive = estimators.naive_effect(cohort)
    parts = [
        boot.confidence(matched, model, spec).withColumns(
            {"model_method": F.lit(model), "run_ts": F.lit(f"2026-01-0{day}T00:00:00+00:00")}
        )
        for day, model in ((1, "att"), (2, "did"))
    ]
    rows = (
        reduce(lambda a, b: a.unionByName(b), parts)
        .join(counts, "study_id").join(naive, "study_id")
        .selectExpr(
            "study_id", "run_ts", "'none' as matching_method", "model_method", "n_treated",
            "n_control", "round(estimate, 3) as estimate", "round(std_error, 3) as std_error",
            "round(ci_low, 3) as ci_low", "round(ci_high, 3) as ci_high",
            "round(naive_estimate, 3) as naive_estimate",
            "ci_low > 0 or ci_high < 0 as significant", "'after' as source",
        )
    )
    return sinks.conform(rows, schemas.EVALUATION_RESULTS_BASE)


# --- sources and sinks ---------------------------------------------------------------------

@query
def config_scan(spark, sf_dir):
    return sinks.conform(fx.modular_config(spark, sf_dir), schemas.STUDY_CONFIG_MODULAR)


@query
def config_lookup(spark, sf_dir):
    config = fx.study_config(spark, sf_dir)
    return selection.config_of(fx.cohorts(spark, sf_dir), config).select(
        "study_id", "feature_method", "matching_method", "model_method", "min_quality_score"
    )


@query
def cohort_slice(spark, sf_dir):
    chosen = fx.study_config(spark, sf_dir).filter("matching_method = 'knn'")
    return rounded(selection.study_slice(fx.cohorts(spark, sf_dir), pin(chosen)))


@query
def panel_slice(spark, sf_dir):
    chosen = panel_studies(spark, sf_dir).filter("model_family = 'lme_mixed'")
    return rounded(selection.study_slice(fx.panel(spark, sf_dir), chosen, performance_only=True))


@query
def sink_overwrite(spark, sf_dir):
    """Write all studies, overwrite one of them with doubled costs, read everything back."""
    path = f"{shared_dir(spark)}/sinks/{uuid.uuid4().hex}"
    rows = fx.cohorts(spark, sf_dir)
    sinks.save_partitioned(rows, path)
    again = rows.filter("study_id = 'SEG_BUILDING'").withColumn("prior_cost", F.expr("prior_cost * 2"))
    sinks.save_partitioned(again, path)
    return rounded(
        tables.read_table(spark, path).groupBy("study_id")
        .agg(F.count("*").alias("n"), F.sum("prior_cost").alias("total_cost")), 2
    )


@query
def results_union(spark, sf_dir):
    base = simple_results(spark, sf_dir)
    older = base.filter("model_method = 'att'")
    newer = sinks.conform(
        base.filter("model_method = 'did'").withColumns(
            {"source": F.lit("modular"), "config_version": F.lit(1), "data_version": F.lit(2),
             "job_run_id": F.lit("run-1")}
        ),
        schemas.EVALUATION_RESULTS,
    )
    return sinks.union_results(older, newer)


@query
def publish_runs(spark, sf_dir):
    """Two runs of different columns and a repetition of the first, read under all their columns."""
    path = f"{shared_dir(spark)}/published/{uuid.uuid4().hex}"
    base = pin(simple_results(spark, sf_dir))
    first = base.filter("model_method = 'att'")
    second = sinks.conform(
        base.filter("model_method = 'did'").withColumns(
            {"source": F.lit("modular"), "config_version": F.lit(1), "data_version": F.lit(2),
             "job_run_id": F.lit("run-1")}
        ),
        schemas.EVALUATION_RESULTS,
    )
    committed = [publish.publish(rows, path, run_id) for rows, run_id in (
        (first, "run-a"), (second, "run-b"), (first.withColumn("estimate", F.lit(0.0)), "run-a")
    )]
    return publish.read_published(spark, path).filter(F.lit(committed == [True, True, False]))


@query
def record_run(spark, sf_dir):
    """Two recorded runs, one of them twice: headlines of the later one, and the results per study."""
    folder = f"{shared_dir(spark)}/recorded/{uuid.uuid4().hex}"
    base, config = pin(simple_results(spark, sf_dir)), fx.study_config(spark, sf_dir)
    for method, run_id in (("att", "monday"), ("did", "tuesday"), ("att", "monday")):
        record.record_results(base.filter(F.col("model_method") == method), config, folder, run_id, run_ts=RUN_TS)
    texts = publish.read_published(spark, f"{folder}/insights").filter("run_id = 'tuesday'")
    history = publish.read_published(spark, f"{folder}/results")
    return texts.selectExpr("study_id", "'headline' as part", "headline as text", "1L as n").unionByName(
        history.groupBy("study_id").agg(
            F.lit("results").alias("part"), F.array_join(F.array_sort(F.collect_set("model_method")), ",").alias("text"),
            F.count("*").alias("n"),
        )
    )


@query
def study_intermediate(spark, sf_dir):
    """The matched rows of chosen studies, read from the table of all studies' matched rows."""
    matched = StudyTable.save(matching.match_exact(seg_features(spark, sf_dir)), unit="unit_id", buckets=4)
    chosen = fx.study_config(spark, sf_dir).filter("model_method = 'att' and matching_method = 'exact'")
    rows = rounded(matched.rows_of(pin(chosen)))
    return rows.select(*fx._COHORT, "weight", "unit_id")


@query
def result_rows(spark, sf_dir):
    effects = estimators.naive_effect(fx.cohorts(spark, sf_dir)).selectExpr(
        "study_id", "'before' as source", "round(naive_estimate, 3) as estimate"
    )
    return sinks.conform(effects, schemas.EVALUATION_RESULTS)


@query
def assign_ids(spark, sf_dir):
    """Append the panel's patients to the cohort table, numbered after its greatest id."""
    incoming = fx.panel(spark, sf_dir).filter("period = 0").selectExpr(
        "study_id", "patient_id as source_id"
    )
    return tables.assign_ids(
        incoming, ["study_id", "source_id"], fx.cohorts(spark, sf_dir)
    ).select("study_id", "source_id", "patient_id")


@query
def ids_by_name(spark, sf_dir):
    """Two batches of patients appended to a table by its name, the first one twice."""
    table = f"patients_{uuid.uuid4().hex}"
    marks = f"{shared_dir(spark)}/marks/{uuid.uuid4().hex}"
    incoming = fx.panel(spark, sf_dir).filter("period = 0").selectExpr("study_id", "patient_id as source_id")
    (fx.cohorts(spark, sf_dir).selectExpr("study_id", "patient_id as source_id", "patient_id")
     .write.option("path", f"{shared_dir(spark)}/tables/{table}").saveAsTable(table))
    for study in ("LME_MIXED", "LME_GROWTH", "LME_MIXED"):
        ids.append_batch(incoming.filter(F.col("study_id") == study), ["source_id"], table, study, marks)
    rows = stage(spark.table(table).filter("study_id like 'LME%'"), "ids")
    spark.sql(f"drop table {table}")
    return rows


@query
def config_defaults(spark, sf_dir):
    return selection.with_defaults(fx.study_config(spark, sf_dir)).select(
        "study_id", "model_family", "active", "performance_months"
    )


@query
def data_stamp(spark, sf_dir):
    return stamps.content_stamp(fx.cohorts(spark, sf_dir))


@query
def stamp_manifest(spark, sf_dir):
    """Stamps of a stored table: at first, after one study changed, and after no change."""
    base = f"{shared_dir(spark)}/stamped/{uuid.uuid4().hex}"
    rows = fx.cohorts(spark, sf_dir)
    sinks.save_partitioned(rows, f"{base}/table")
    taken = [manifests.restamp(spark, f"{base}/table", f"{base}/manifest")]
    changed = rows.filter("study_id = 'SEG_BUILDING'").withColumn("prior_cost", F.expr("prior_cost * 2"))
    sinks.save_partitioned(changed, f"{base}/table")
    taken += [manifests.restamp(spark, f"{base}/table", f"{base}/manifest") for _ in range(2)]
    return spark.createDataFrame(
        [(i, t.n_rows, t.stamp, len(t.reread)) for i, t in enumerate(taken, 1)],
        "step int, n_rows long, stamp long, n_reread long",
    )


# --- selection and routing -----------------------------------------------------------------

@query
def select_active(spark, sf_dir):
    return selection.select_studies(fx.modular_config(spark, sf_dir)).select("study_id", "active")


@query
def select_subset(spark, sf_dir):
    chosen = selection.select_studies(fx.modular_config(spark, sf_dir), " SEG_ARCHIVED, ,SEG_BUILDING ,")
    return chosen.select("study_id", "active")


@query
def family_split(spark, sf_dir):
    return selection.family_split(fx.modular_config(spark, sf_dir)).selectExpr(
        "model_family", "n_studies", "array_join(studies, ',') as studies"
    )


@query
def family_flags(spark, sf_dir):
    return selection.family_flags(selection.select_studies(fx.modular_config(spark, sf_dir)))


@query
def study_methods(spark, sf_dir):
    return selection.study_methods(fx.modular_config(spark, sf_dir))


def _modular_status(spark, sf_dir):
    return runs.build_status(
        fx.cohorts(spark, sf_dir), fx.panel(spark, sf_dir), fx.modular_config(spark, sf_dir)
    )


@query
def gate_pass(spark, sf_dir):
    status = _modular_status(spark, sf_dir)
    cohort = fx.cohorts(spark, sf_dir)
    kept = selection.study_slice(cohort, quality.passing(status))
    return rounded(
        kept.groupBy("study_id").agg(F.count("*").alias("n"), F.sum("post_outcome").alias("total")), 2
    )


@query
def gate_fail(spark, sf_dir):
    return _modular_status(spark, sf_dir).filter("not quality_passed").select(
        "study_id", "n_total", "n_treated", "n_control", "quality_score", "min_quality_score"
    )


@query
def route_before(spark, sf_dir):
    return routing.route_before(seg_status(spark, sf_dir)).selectExpr(
        "study_id", "matching_method as chosen_matching", "model_method as chosen_model",
        "quality_passed", "branch",
    )


def _pe_status(spark, sf_dir):
    return runs.build_status(fx.pe_cohorts(spark, sf_dir), None, fx.pe_config(spark, sf_dir))


@query
def next_phase(spark, sf_dir):
    return routing.next_phase(_pe_status(spark, sf_dir)).select(
        "study_id", "quality_passed", "nextphase"
    )


def _pe_routes(spark, sf_dir):
    chosen = _pe_status(spark, sf_dir).filter("model_type = 'wilcoxon'")
    skews = ranks.skewness(
        selection.study_slice(pe_differences(spark, sf_dir), chosen)
    )
    return pin(ranks.fallback_route(skews, chosen))


@query
def fallback_route(spark, sf_dir):
    return rounded(_pe_routes(spark, sf_dir))


@query
def phase_trace(spark, sf_dir):
    return routing.phase_trace(_pe_status(spark, sf_dir), _pe_routes(spark, sf_dir)).select(
        "study_id", "trace"
    )


@query
def phase_chain(spark, sf_dir):
    """Chains of up to five phases from a table of transitions."""
    chains = routing.phase_chain(fx.phase_steps(spark, sf_dir))
    return chains.select("study_id", "trace", F.size("phases").cast("long").alias("n_phases"))


# --- features and quality ------------------------------------------------------------------

@query
def missing_fraction(spark, sf_dir):
    return rounded(quality.missing_fraction(fx.cohorts(spark, sf_dir)))


@query
def arm_counts(spark, sf_dir):
    return quality.arm_counts(fx.cohorts(spark, sf_dir))


@query
def quality_score(spark, sf_dir):
    return rounded(quality.quality_scores(fx.cohorts(spark, sf_dir)))


@query
def impute_global(spark, sf_dir):
    return rounded(feats.impute_global(fx.cohorts(spark, sf_dir)).select(*KEYED, "risk_score"))


@query
def impute_arm(spark, sf_dir):
    return rounded(feats.impute_arm(fx.cohorts(spark, sf_dir)).select(*KEYED, "risk_score"))


@query
def period_split(spark, sf_dir):
    split = feats.period_split(fx.panel(spark, sf_dir), panel_studies(spark, sf_dir))
    return split.select(*KEYED, "period", "phase")


@query
def performance_mean(spark, sf_dir):
    return rounded(feats.performance_mean(fx.panel(spark, sf_dir), panel_studies(spark, sf_dir)), 6)


@query
def panel_features(spark, sf_dir):
    rows = feats.panel_features(fx.panel(spark, sf_dir), panel_studies(spark, sf_dir))
    return rounded(rows.drop("slope"), 6)


@query
def panel_periods(spark, sf_dir):
    return rounded(feats.panel_periods(fx.panel(spark, sf_dir), panel_studies(spark, sf_dir)))


@query
def panel_impute(spark, sf_dir):
    rows = feats.panel_impute(fx.panel(spark, sf_dir), panel_studies(spark, sf_dir))
    return rounded(rows.select(*KEYED, "period", "risk_score"))


# --- matching ------------------------------------------------------------------------------

@query
def coarsen(spark, sf_dir):
    return strata.coarsen(fx.cohorts(spark, sf_dir)).select(*KEYED, "age_b", "risk_b")


@query
def common_strata(spark, sf_dir):
    return strata.common_strata(fx.cohorts(spark, sf_dir))


@query
def standardize(spark, sf_dir):
    rows = propensity.standardize(seg_features(spark, sf_dir))
    return rounded(rows.select(*KEYED, "z_age", "z_risk_score", "z_prior_cost"))


@query
def propensity_scores(spark, sf_dir):
    rows = propensity.with_propensity(seg_features(spark, sf_dir))
    return rounded(rows.select(*KEYED, "treatment", "ps"), 6)


def _matched_rows(df):
    return rounded(df.select(*KEYED, "treatment", "post_outcome", "weight", "unit_id"))


@query
def match_exact(spark, sf_dir):
    return _matched_rows(matching.match_exact(seg_features(spark, sf_dir)))


@query
def match_stratified(spark, sf_dir):
    return _matched_rows(matching.match_stratified(seg_features(spark, sf_dir)))


@query
def match_knn(spark, sf_dir):
    return _matched_rows(matching.match_knn(seg_features(spark, sf_dir)))


@query
def unscored_rows(spark, sf_dir):
    """Rows without a risk score have no propensity score either."""
    return matching.unscored(fx.pe_cohorts(spark, sf_dir))


@query
def ipw_raw(spark, sf_dir):
    return rounded(matching.ipw_raw(seg_features(spark, sf_dir)).select(*KEYED, "weight"))


@query
def match_ipw(spark, sf_dir):
    return _matched_rows(matching.match_ipw(seg_features(spark, sf_dir)))


@query
def match_none(spark, sf_dir):
    return _matched_rows(matching.match_none(pe_features(spark, sf_dir)))


@query
def matched_counts(spark, sf_dir):
    return matching.matched_counts(matching.match_exact(pe_features(spark, sf_dir)))


@query
def dispatch_matching_methods(spark, sf_dir):
    methods = seg_status(spark, sf_dir).filter("quality_passed")
    rows = dispatch_features(fx.cohorts(spark, sf_dir), None, methods, Registry())
    matched = dispatch_matching(stage(rows, "dispatch"), methods, Registry())
    return rounded(
        matched.groupBy("study_id", "treatment")
        .agg(F.count("*").alias("n"), F.sum("weight").alias("total_weight"))
    )


@query
def dispatch_model_methods(spark, sf_dir):
    methods = seg_status(spark, sf_dir).filter("quality_passed").withColumn(
        "model_method",
        F.expr("case matching_method when 'exact' then 'gee' when 'ipw' then 'mixed' else model_method end"),
    )
    matched = matching.match_none(seg_features(spark, sf_dir).withColumn("slope", F.lit(0.0)))
    return rounded(
        dispatch_model(stage(matched, "dispatch"), methods, Registry(), None)
        .select("study_id", "model_method", "estimate")
    )


@query
def plugin_contract(spark, sf_dir):
    """A matching method registered from outside, used by every passing study."""
    registry = Registry()
    registry.register("matching", "balanced_strata", matching.match_stratified)
    methods = seg_status(spark, sf_dir).filter("quality_passed").withColumn(
        "matching_method", F.lit("balanced_strata")
    )
    rows = stage(dispatch_features(fx.cohorts(spark, sf_dir), None, methods, registry), "plugin")
    return rounded(
        dispatch_matching(rows, methods, registry).groupBy("study_id", "treatment")
        .agg(F.count("*").alias("n"), F.sum("weight").alias("total_weight"))
    )


# --- estimators ----------------------------------------------------------------------------

@query
def weighted_means(spark, sf_dir):
    matched = matching.match_stratified(seg_features(spark, sf_dir))
    return rounded(estimators.weighted_means(matched, "post_outcome"))


def _grid_effect(model: str) -> Query:
    def run(spark, sf_dir):
        keys = ["study_id", "matching_method"]
        return rounded(estimators.effect(method_grid(spark, sf_dir), model, keys))
    return run


for _model in ("att", "ate", "did", "gee", "mixed"):
    _QUERIES[f"effect_{_model}"] = _grid_effect(_model)


@query
def effect_lme_mixed(spark, sf_dir):
    matched = matched_panel(spark, sf_dir).filter("study_id = 'LME_MIXED'")
    return rounded(estimators.effect(matched, "lme_mixed"))


@query
def patient_slopes(spark, sf_dir):
    rows = feats.panel_features(fx.panel(spark, sf_dir), panel_studies(spark, sf_dir))
    return rounded(rows.select(*KEYED, "slope"), 6)


@query
def effect_lme_growth(spark, sf_dir):
    matched = matched_panel(spark, sf_dir).filter("study_id = 'LME_GROWTH'")
    return rounded(estimators.effect(matched, "lme_growth"))


@query
def naive_effect(spark, sf_dir):
    return rounded(estimators.naive_effect(fx.cohorts(spark, sf_dir)))


@query
def naive_panel(spark, sf_dir):
    return rounded(estimators.naive_panel(fx.panel(spark, sf_dir)))


@query
def bootstrap_by_arm(spark, sf_dir):
    matched = stage(matching.match_stratified(seg_features(spark, sf_dir)), "boot")
    return near(boot.replicates(matched, "did", Bootstrap(seed=7, by_arm=True)), "estimate", 6)


@query
def bootstrap_rows(spark, sf_dir):
    matched = stage(matching.match_exact(seg_features(spark, sf_dir)), "boot")
    return near(boot.replicates(matched, "att", Bootstrap(seed=0, by_arm=False)), "estimate", 6)


@query
def bootstrap_panel(spark, sf_dir):
    # A slope's last digits depend on the order of its periods.
    matched = near(matched_panel(spark, sf_dir), "slope", 9)
    return near(boot.replicates(matched, "lme_growth", Bootstrap(seed=0, by_arm=False)), "estimate", 6)


@query
def bootstrap_poisson(spark, sf_dir):
    matched = stage(matching.match_exact(seg_features(spark, sf_dir)), "boot")
    return near(boot.replicates(matched, "att", Bootstrap(seed=11, scheme="poisson")), "estimate", 6)


@query
def bootstrap_ci(spark, sf_dir):
    matched = stage(matching.match_stratified(seg_features(spark, sf_dir)), "boot")
    return rounded(boot.confidence(matched, "did", Bootstrap(seed=7, by_arm=True)))


@query
def interval_gee(spark, sf_dir):
    matched = stage(matching.match_exact(seg_features(spark, sf_dir)), "boot")
    return rounded(boot.confidence(matched, "gee", Bootstrap(seed=5, scheme="poisson")))


@query
def interval_mixed(spark, sf_dir):
    matched = stage(matching.match_stratified(seg_features(spark, sf_dir)), "boot")
    return rounded(boot.confidence(matched, "mixed", Bootstrap(seed=9, by_arm=False)))


@query
def skew_check(spark, sf_dir):
    return rounded(ranks.skewness(pe_differences(spark, sf_dir)))


@query
def wilcoxon(spark, sf_dir):
    return rounded(ranks.signed_rank(pe_differences(spark, sf_dir)), 6)


@query
def sign_test(spark, sf_dir):
    return rounded(ranks.sign_test(pe_differences(spark, sf_dir)), 6)


@query
def median_diff(spark, sf_dir):
    return rounded(ranks.median_difference(pe_differences(spark, sf_dir)))


@query
def rank_or_sign(spark, sf_dir):
    config = fx.pe_config(spark, sf_dir).filter("model_type = 'wilcoxon'")
    rows = selection.study_slice(pe_features(spark, sf_dir), pin(config))
    return rounded(ranks.rank_or_sign(rows, config), 5)


# --- whole runs ----------------------------------------------------------------------------

@query
def evaluate_all(spark, sf_dir):
    return runs.evaluate(
        fx.cohorts(spark, sf_dir), fx.panel(spark, sf_dir), fx.modular_config(spark, sf_dir),
        source="modular", bootstrap=runs.MODULAR_BOOTSTRAP, run_ts=RUN_TS, job_run_id="run-1",
        stamped=True,
    )


@query
def evaluate_after(spark, sf_dir):
    return runs.evaluate(
        fx.cohorts(spark, sf_dir), None, fx.study_config(spark, sf_dir), run_ts=RUN_TS
    )


@query
def evaluate_before(spark, sf_dir):
    return runs.evaluate_before(
        fx.cohorts(spark, sf_dir), fx.study_config(spark, sf_dir), run_ts=RUN_TS
    )


def _phases(spark, sf_dir):
    return runs.evaluate_phases(
        fx.pe_cohorts(spark, sf_dir), fx.pe_config(spark, sf_dir), run_id="run-1", run_ts=RUN_TS
    )


@query
def evaluate_phases(spark, sf_dir):
    return _phases(spark, sf_dir).results


@query
def step_log(spark, sf_dir):
    log = _phases(spark, sf_dir).step_log
    return log.withColumn("timed", F.expr("execution_time > 0")).drop("execution_time")


@query
def observed_steps(spark, sf_dir):
    """Rows that the steps of a run counted while they wrote them."""
    steps = _phases(spark, sf_dir).steps.table(spark)
    return steps.filter("n_rows is not null and seconds > 0").select("step", "n_rows", "n_treated")


@query
def evaluate_phase_models(spark, sf_dir):
    """Difference in differences as a phase, the sign test as a phase, a skewed study that falls back to the former."""
    run = runs.evaluate_phases(
        fx.phase_cohorts(spark, sf_dir), fx.phase_config(spark, sf_dir), run_id="run-1", run_ts=RUN_TS
    )
    return run.results.join(run.traces.select("study_id", "trace"), "study_id")


# --- reporting -----------------------------------------------------------------------------

@query
def latest_result(spark, sf_dir):
    return report.latest_results(simple_results(spark, sf_dir))


@query
def headline(spark, sf_dir):
    texts = report.insights(simple_results(spark, sf_dir), fx.study_config(spark, sf_dir), RUN_TS)
    return texts.select("study_id", "run_ts", "headline")


@query
def interpretation(spark, sf_dir):
    texts = report.insights(
        simple_results(spark, sf_dir), fx.study_config(spark, sf_dir), RUN_TS, bias_note=True
    )
    return texts.select("study_id", "interpretation")


@query
def interpretation_plain(spark, sf_dir):
    """The second wording of the interpretation."""
    texts = report.insights(
        simple_results(spark, sf_dir), fx.study_config(spark, sf_dir), RUN_TS, bias_note=False
    )
    return texts.select("study_id", "interpretation")


@query
def matching_shift(spark, sf_dir):
    rows = report.matching_shift(simple_results(spark, sf_dir))
    return rounded(rows.select("study_id", "model_method", "estimate", "naive_estimate", "shift"), 3)


@query
def cohort_summary(spark, sf_dir):
    return report.cohort_summary(fx.cohorts(spark, sf_dir))


@query
def panel_summary(spark, sf_dir):
    return report.panel_summary(fx.panel(spark, sf_dir))


@query
def results_listing(spark, sf_dir):
    return report.results_listing(
        simple_results(spark, sf_dir).select("source", "study_id", "model_method", "estimate")
    )


@query
def study_count(spark, sf_dir):
    return report.study_count(fx.cohorts(spark, sf_dir))


@query
def approx_distinct(spark, sf_dir):
    """Distinct patients from stored sketches, by study and in all, against the exact counts."""
    cohort = fx.cohorts(spark, sf_dir)
    sketches = stage(report.distinct_sketches(cohort, ["study_id", "treatment"], "patient_id"), "sketches")
    parts = []
    for key in (F.col("study_id"), F.lit("all")):
        exact = cohort.groupBy(key.alias("study_id")).agg(F.countDistinct("patient_id").alias("n_exact"))
        near = report.approx_distinct(sketches.withColumn("study_id", key), ["study_id"])
        parts.append(exact.join(near, "study_id"))
    # Three standard errors.
    return parts[0].unionByName(parts[1]).selectExpr(
        "study_id", "n_exact", "abs(n_approx - n_exact) <= 0.05e0 * n_exact as is_near"
    )


@query
def metric_rows(spark, sf_dir):
    return report.metric_rows(
        simple_results(spark, sf_dir).filter("model_method = 'did'")
    )


for _name, _key in (
    ("propensity_scores", "propensity"), ("dispatch_matching_methods", "dispatch_matching"),
    ("dispatch_model_methods", "dispatch_model"),
):
    _QUERIES[_key] = _QUERIES.pop(_name)
