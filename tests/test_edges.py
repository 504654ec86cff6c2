import math

import pandas as pd
import pytest

from cohortlift import schemas
from cohortlift.operators import (
    estimators, features, matching, quality, ranks, report, selection, strata,
)
from cohortlift.operators.bootstrap import Bootstrap, confidence
from cohortlift.plans.evaluate import evaluate
from cohortlift.plans.registry import ContractError, Registry
from cohortlift.sources import sinks, tables
from tests.frames import cohort, panel, study


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


def test_bins_are_right_closed(spark):
    rows = [("age", a, 1.2) for a in (0.0, 50.0, 50.1, 60.0, 70.0, 200.0, 201.0)]
    rows += [("risk", 55.0, r) for r in (0.0, 1.0, 1.5, 2.0, 100.0)]
    frame = spark.createDataFrame(rows, "kind string, age double, risk_score double")
    got = strata.coarsen(frame).collect()
    assert {r.age: r.age_b for r in got if r.kind == "age"} == {
        0.0: None, 50.0: 0, 50.1: 1, 60.0: 1, 70.0: 2, 200.0: 3, 201.0: None}
    assert {r.risk_score: r.risk_b for r in got if r.kind == "risk"} == {
        0.0: None, 1.0: 0, 1.5: 1, 2.0: 2, 100.0: 3}


@pytest.mark.parametrize("method", ["exact", "stratified", "knn", "none"])
def test_planted_effect_is_recovered(spark, method):
    base = [(float(40 + i), 0.5 + i / 20, 1000.0 * i, 100.0 * i) for i in range(1, 31)]
    rows = []
    for i, (age, risk, cost, pre) in enumerate(base):
        rows.append(("S", 2 * i, 1, age, risk, cost, pre, pre + 5 - 10))
        rows.append(("S", 2 * i + 1, 0, age, risk, cost, pre, pre + 5))
    frame = spark.createDataFrame(rows, schemas.COHORT)
    matched = getattr(matching, f"match_{method}")(frame)
    # Identical arms give every row the same score, so knn pairs arbitrarily: only did is planted.
    if method != "knn":
        assert estimators.effect(matched, "att").first().estimate == pytest.approx(-10)
    assert estimators.effect(matched, "did").first().estimate == pytest.approx(-10)


def test_one_arm_only(spark):
    rows = [("S", i, 1, 50.0 + i, 1.2, 10.0 * i, 1.0, 2.0) for i in range(5)]
    frame = spark.createDataFrame(rows, schemas.COHORT)
    scores = quality.quality_scores(frame).first()
    assert (scores.n_control, scores.quality_score) == (0, 0.6)
    assert strata.common_strata(frame).count() == 0
    for name in ("exact", "stratified", "knn"):
        assert getattr(matching, f"match_{name}")(frame).count() == 0
    alone = estimators.effect(matching.match_none(frame), "att").first()
    assert alone.estimate is None


def test_all_risk_missing(spark):
    rows = [("S", i, i % 2, 50.0, None if i < 2 else math.nan, 1.0, 1.0, 2.0) for i in range(4)]
    frame = quality.clean(spark.createDataFrame(rows, schemas.COHORT))
    assert quality.missing_fraction(frame).first().missing_fraction == 1.0
    assert {r.risk_score for r in features.impute_global(frame).collect()} == {None}


def test_single_stratum_weights(spark):
    rows = [("S", i, 1 if i < 3 else 0, 55.0, 1.2, 1.0, 1.0, 2.0) for i in range(5)]
    weights = matching.match_stratified(spark.createDataFrame(rows, schemas.COHORT)).collect()
    assert {r.treatment: r.weight for r in weights} == {1: pytest.approx(1 / 3), 0: 0.5}


def test_score_tie_goes_to_least_id(spark):
    rows = [("S", 1, 1, 0.50), ("S", 9, 0, 0.25), ("S", 4, 0, 0.75), ("S", 2, 0, 0.75)]
    frame = spark.createDataFrame(rows, "study_id string, patient_id long, treatment int, ps double")
    got = by(matching.match_knn(frame), "unit_id")
    assert got["c:1"].patient_id == 2 and got["t:1"].patient_id == 1


def test_repeated_control_keeps_one_row_per_treated(spark):
    rows = [("S", i, 1, 0.4 + i / 10) for i in range(3)] + [("S", 7, 0, 0.1)]
    frame = spark.createDataFrame(rows, "study_id string, patient_id long, treatment int, ps double")
    got = matching.match_knn(frame)
    assert matching.matched_counts(got).first().n_control == 3
    assert got.select("unit_id").distinct().count() == 6


def test_zero_differences(spark):
    rows = [("S", i, 1, 50.0, 1.0, 1.0, 5.0, 5.0) for i in range(4)]
    diffs = ranks.paired_differences(spark.createDataFrame(rows, schemas.COHORT))
    assert ranks.sign_test(diffs).first().p_value is None
    assert ranks.median_difference(diffs).first().estimate == 0.0
    assert ranks.signed_rank(diffs).first().p_value is None


def test_growth_of_straight_lines(spark):
    rows = []
    for pid in range(6):
        treated = pid % 2
        for period in range(4):
            rows.append(("G", pid, treated, 50.0, 1.0, 1.0, period, 2.0 * period * treated))
    rows.append(("G", 99, 1, 50.0, 1.0, 1.0, 0, 7.0))  # no performance period: dropped
    config = spark.createDataFrame([("G", 3)], "study_id string, performance_months long")
    feats = features.panel_features(panel(spark, rows), config)
    assert feats.count() == 6
    matched = matching.match_none(feats)
    assert estimators.effect(matched, "lme_growth").first().estimate == pytest.approx(2)


def test_performance_window_is_per_study(spark):
    rows = [(s, 1, 1, 50.0, 1.0, 1.0, p, float(p)) for s in ("A", "B") for p in range(4)]
    config = spark.createDataFrame([("A", 1), ("B", 3)], "study_id string, performance_months long")
    got = by(features.performance_mean(panel(spark, rows), config), "study_id")
    assert (got["A"].post_outcome, got["B"].post_outcome) == (1.0, 2.0)


def test_study_without_rows_fails_the_gate(spark):
    frame = cohort(spark, study("A", 120, 130, 1))
    config = spark.createDataFrame(
        [("A", 0.9), ("EMPTY", 0.0)], "study_id string, min_quality_score double")
    status = by(quality.gate(quality.quality_scores(frame), config), "study_id")
    assert status["A"].quality_passed is True and status["EMPTY"].quality_passed is False


def _config(spark, **changes):
    row = dict(study_id="A", study_name="Program A", vendor="V", feature_method="standard",
               matching_method="exact", model_method="att", min_quality_score=0.5) | changes
    return tables.seed_config(spark, [tuple(row.values())], schemas.STUDY_CONFIG)


@pytest.mark.parametrize("kind", ["feature", "matching", "model"])
def test_unknown_method_is_rejected_before_work(spark, kind):
    frame = cohort(spark, study("A", 40, 40, 1))
    with pytest.raises(ValueError, match=f"Unknown {kind}_method"):
        evaluate(frame, None, _config(spark, **{f"{kind}_method": "magic"}))


def test_plugins_and_their_contract(spark):
    registry = Registry()
    registry.register("matching", "treated_only_weight", lambda df: matching.match_none(df))
    registry.register("matching", "broken", lambda df: df)
    registry.register(
        "model", "constant",
        lambda df: df.select("study_id").distinct().selectExpr(
            "study_id", "1D as estimate", "0D as std_error", "1D as ci_low", "1D as ci_high"),
    )
    frame = cohort(spark, study("A", 40, 40, 1))
    got = evaluate(
        frame, None, _config(spark, matching_method="treated_only_weight", model_method="constant"),
        registry=registry,
    ).first()
    assert (got.estimate, got.model_method, got.n_treated) == (1.0, "constant", 40)
    with pytest.raises(ContractError, match="weight"):
        evaluate(frame, None, _config(spark, matching_method="broken"), registry=registry)


def test_selection_by_flag_and_by_list(spark):
    config = spark.createDataFrame([("A", True), ("B", False)], "study_id string, active boolean")
    pick = lambda ids: {r.study_id for r in selection.select_studies(config, ids).collect()}
    assert pick(None) == {"A"} and pick("") == {"A"} and pick(" B ,,") == {"B"}
    old = config.drop("active")
    assert {r.study_id for r in selection.select_studies(old).collect()} == {"A", "B"}


def test_missing_config_row_is_an_error(spark):
    frame = cohort(spark, study("A", 3, 3, 1))
    with pytest.raises(LookupError, match="A"):
        selection.config_of(frame, _config(spark, study_id="B"))


def test_interval_of_study_without_replicates_is_its_point(spark):
    rows = [("S", i, 1, 50.0, 1.0, 1.0, 1.0, 3.0) for i in range(5)]
    matched = matching.match_none(spark.createDataFrame(rows, schemas.COHORT))
    got = confidence(matched, "att", Bootstrap(reps=5)).first()
    assert (got.estimate, got.n_reps, got.std_error, got.ci_low) == (None, 0, 0.0, None)


def test_texts_survive_null_intervals(spark):
    row = ("A", "2026", "exact", "att", 3, 4, -1234.5, None, None, None, None, None, "before")
    results = spark.createDataFrame([row], schemas.EVALUATION_RESULTS_BASE)
    text = report.insights(results, _config(spark), "2026").first()
    assert text.headline == (
        "Program A (V): ATT on exact-matched cohort estimates a 1,234 reduction in the outcome "
        "(not statistically significant).")
    assert text.interpretation.startswith("Estimate -1,234.5 (95% CI [n/a, n/a]).")
    assert text.interpretation.endswith("removing confounding bias. n=3 treated / 4 control.")


def test_latest_result_wins(spark):
    rows = [("A", f"2026-0{m}", "exact", "att", 3, 4, float(m), None, None, None, None, None, "x")
            for m in (2, 3, 1)]
    results = spark.createDataFrame(rows, schemas.EVALUATION_RESULTS_BASE)
    assert report.latest_results(results).first().estimate == 3.0


def test_append_grows_columns_and_overwrite_keeps_other_studies(spark, tmp_path):
    path = str(tmp_path / "results")
    older = spark.createDataFrame([("A", 1.0)], "study_id string, estimate double")
    sinks.append(older, path)
    sinks.append(older.selectExpr("*", "'r' as job_run_id"), path)
    assert {r.job_run_id for r in tables.read_results(spark, path).collect()} == {None, "r"}
    parts = str(tmp_path / "parts")
    sinks.save_partitioned(spark.createDataFrame([("A", 1), ("B", 1)], "study_id string, v int"), parts)
    sinks.save_partitioned(spark.createDataFrame([("B", 2)], "study_id string, v int"), parts)
    assert by(tables.read_table(spark, parts), "study_id")["A"].v == 1
    assert by(tables.read_table(spark, parts), "study_id")["B"].v == 2


def test_ids_continue_after_the_greatest(spark, many_shards):
    new = spark.range(1000).selectExpr("concat('s', id % 3) as study_id", "id as k")
    old = spark.createDataFrame([(41,)], "patient_id long")
    got = tables.assign_ids(new, ["study_id", "k"], old).toPandas().sort_values(["study_id", "k"])
    assert got.patient_id.tolist() == list(range(42, 1042))
    assert tables.assign_ids(new, ["study_id", "k"], "no_such_table").toPandas().patient_id.min() == 1


def test_run_with_failed_gate_and_two_methods(spark):
    pdf = pd.concat([study("A", 150, 150, 1), study("B", 160, 140, 2), study("C", 20, 20, 3)])
    rows = [("A", "Program A", "V", "standard", "exact", "att", 0.9),
            ("B", "Program B", "W", "aggressive_impute", "ipw", "mixed", 0.9),
            ("C", "Program C", "X", "standard", "exact", "att", 0.9)]
    got = by(
        evaluate(cohort(spark, pdf), None, tables.seed_config(spark, rows, schemas.STUDY_CONFIG),
                 bootstrap=Bootstrap(reps=30)),
        "study_id")
    assert set(got) == {"A", "B"}
    assert got["B"].ci_low < got["B"].estimate < got["B"].ci_high


def test_null_outcomes_take_no_part_in_any_mean(spark):
    from cohortlift.operators import estimators

    frame = spark.createDataFrame(
        [("S", 1, 1.0, 10.0), ("S", 1, 1.0, None), ("S", 0, 1.0, 10.0)],
        "study_id string, treatment int, weight double, post_outcome double")
    assert estimators.effect(frame, "att").first().estimate == 0.0


def test_stamps_see_repeated_rows_small_changes_and_nan(spark):
    from cohortlift.sources.stamps import stamp_value

    def stamp(*values):
        return stamp_value(spark.createDataFrame([(v,) for v in values], "x double"))

    values = [(1.0,), (1.0, 1.0, 1.0), (1.00001,), (1.00002,), (math.nan,), (None,), (math.inf,), (1e15,), (1e300,), ()]
    assert len({stamp(*v) for v in values}) == len(values)
    assert stamp(1.0, 2.0) == stamp(2.0, 1.0) and stamp(0.0) == stamp(-0.0)


def test_null_model_type_and_unknown_fallback_are_rejected(spark):
    from cohortlift.plans.evaluate import evaluate_phases

    rows = cohort(spark, study("S", 20, 20, 1))
    for model, fallback in ((None, None), ("wilcoxon", "model_other"), ("wilcoxon", "model_wilcoxon")):
        config = spark.createDataFrame(
            [("S", "S", model, False, "none", fallback, 6, 6, 0.1, "x")], schemas.PE_STUDY_CONFIG)
        with pytest.raises(ValueError, match="unknown model_type or fallback_model: S"):
            evaluate_phases(rows, config)


def test_skewed_study_goes_on_with_the_effect_model_it_names(spark):
    from cohortlift.plans.evaluate import evaluate_phases

    pdf = study("S", 40, 40, 1)
    jump = (pdf.index < 2) * 9500.0
    pdf.loc[pdf.treatment == 1, "post_outcome"] = pdf.pre_outcome + jump
    config = spark.createDataFrame(
        [("S", "S", "wilcoxon", False, "none", "model_did", 6, 6, 0.1, "x")], schemas.PE_STUDY_CONFIG)
    run = evaluate_phases(cohort(spark, pdf), config, bootstrap=Bootstrap(reps=20))
    result = run.results.first()
    assert result.model_method == "did" and result.estimate is not None
    assert run.traces.first().trace.endswith("model_wilcoxon -> model_did")
    assert {r.step_id for r in run.step_log.collect()} == {"1", "3", "3b"}
