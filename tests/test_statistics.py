"""Against plain numpy, and properties that must hold whatever the data."""

import itertools
import re

import numpy as np
import pandas as pd
import pytest

from cohortlift.operators import estimators, matching, propensity, ranks
from cohortlift.operators.bootstrap import Bootstrap, confidence, replicates, resampled_sums
from cohortlift.operators.quantiles import exact_quantile
from cohortlift.operators.pinning import pin, stage
from cohortlift.operators.sharding import group_index, range_shards
from tests.frames import COVARIATES, cohort, nearest_controls, score_gaps, study, wls_effect


@pytest.fixture(scope="module")
def two_studies():
    return pd.concat([study("A", 120, 90, 1), study("B", 60, 110, 2)], ignore_index=True)


def scores_of(df):
    return {(r.study_id, r.patient_id): r.ps for r in df.collect()}


def some_scores(pdf):
    """Scores from 0.05 to 0.95 that rise with age."""
    return (0.05 + 0.9 * (pdf.age - pdf.age.min()) / (pdf.age.max() - pdf.age.min())).to_numpy()


def test_propensity_solves_its_score_equations(spark, two_studies):
    got = scores_of(propensity.with_propensity(cohort(spark, two_studies)))
    for name, part in two_studies.groupby("study_id"):
        have = np.array([got[name, pid] for pid in part.patient_id])
        assert 0.01 < have.min() and have.max() < 0.99
        linear, residual = score_gaps(part, have)
        assert linear < 1e-6 and residual < 1e-6


def test_score_equations_and_independence_of_studies(spark, two_studies):
    both = scores_of(propensity.with_propensity(cohort(spark, two_studies)))
    alone = scores_of(
        propensity.with_propensity(cohort(spark, two_studies[two_studies.study_id == "A"])))
    assert all(abs(both[key] - value) < 1e-13 for key, value in alone.items())
    part = two_studies[two_studies.study_id == "A"]
    residual = part.treatment - [both["A", pid] for pid in part.patient_id]
    assert abs(residual.sum()) < 1e-6


def test_separable_arms_stay_finite(spark):
    pdf = study("A", 50, 50, 3)
    pdf["age"] = np.where(pdf.treatment == 1, 80.0, 30.0) + np.arange(100) / 100
    got = scores_of(propensity.with_propensity(cohort(spark, pdf)))
    assert min(got.values()) >= 0.01 and max(got.values()) <= 0.99


@pytest.mark.parametrize("clipped", [False, True])
def test_knn_over_many_shards_equals_brute_force(spark, many_shards, two_studies, clipped):
    pdf = two_studies.copy()
    ps = np.concatenate([some_scores(part) for _, part in pdf.groupby("study_id")])
    # A third of all rows on one score, controls among them, and a coarse grid full of ties.
    ps = np.where(np.arange(len(ps)) % 3 == 0, 0.99, np.round(ps, 2)) if clipped else ps
    scored = spark.createDataFrame(pdf.assign(ps=ps)).repartition(7)
    assert range_shards(scored, ["study_id", "ps", "patient_id"]).select("_shard").distinct().count() > 4
    rows = matching.match_knn(scored).collect()
    controls = {(r.study_id, int(r.unit_id[2:])): r.patient_id for r in rows if r.unit_id[0] == "c"}
    for name, part in pdf.assign(ps=ps).groupby("study_id"):
        want = nearest_controls(part, part.ps)
        assert {t: c for (s, t), c in controls.items() if s == name} == want
    assert sum(r.treatment for r in rows) == len(rows) / 2


def test_stratified_weights_sum_to_one(spark, two_studies):
    from cohortlift.operators.strata import coarsen
    sums = coarsen(matching.match_stratified(cohort(spark, two_studies))).groupBy(
        "study_id", "age_b", "risk_b", "treatment").agg({"weight": "sum"}).collect()
    assert sums and all(r[-1] == pytest.approx(1) for r in sums)


def test_ipw_trim_equals_numpy_quantile(spark, two_studies):
    got = matching.match_ipw(cohort(spark, two_studies)).toPandas()
    scores = scores_of(propensity.with_propensity(cohort(spark, two_studies)))
    for name, part in two_studies.groupby("study_id"):
        ps = np.array([scores[name, pid] for pid in part.patient_id])
        raw = np.where(part.treatment == 1, 1 / ps, 1 / (1 - ps))
        want = np.minimum(raw, np.quantile(raw, 0.99))
        have = got[got.study_id == name].set_index("patient_id").weight.loc[part.patient_id]
        assert np.allclose(want, have, rtol=1e-10)


@pytest.mark.parametrize("model", ["gee", "mixed"])
def test_adjusted_effects_equal_least_squares(spark, two_studies, model):
    matched = matching.match_ipw(cohort(spark, two_studies))
    got = {r.study_id: r.estimate for r in estimators.effect(matched, model).collect()}
    extra = COVARIATES if model == "gee" else ["pre_outcome", *COVARIATES]
    for name, part in matched.toPandas().groupby("study_id"):
        assert got[name] == pytest.approx(wls_effect(part, extra), rel=1e-9)


def test_adjusted_effect_is_null_when_covariates_are_collinear(spark, two_studies):
    pdf = two_studies.assign(prior_cost=two_studies.age * 2)
    got = estimators.effect(matching.match_none(cohort(spark, pdf)), "gee").collect()
    assert [r.estimate for r in got] == [None, None]


def test_did_ignores_a_constant_shift_and_row_order(spark, two_studies):
    base = estimators.effect(matching.match_exact(cohort(spark, two_studies)), "did").collect()
    moved = two_studies.assign(
        pre_outcome=two_studies.pre_outcome + 500, post_outcome=two_studies.post_outcome + 500,
    ).sample(frac=1, random_state=4)
    again = estimators.effect(
        matching.match_exact(cohort(spark, moved).repartition(5)), "did").collect()
    want = {r.study_id: r.estimate for r in base}
    assert all(r.estimate == pytest.approx(want[r.study_id]) for r in again)


@pytest.mark.parametrize("by_arm", [True, False])
@pytest.mark.parametrize("scheme", ["fixed_n", "poisson"])
def test_bootstrap_error_is_close_to_the_closed_form(spark, by_arm, scheme):
    pdf = study("A", 400, 300, 5)
    matched = matching.match_none(cohort(spark, pdf))
    got = confidence(matched, "att", Bootstrap(reps=1500, seed=2, by_arm=by_arm, scheme=scheme)).first()
    t, c = (pdf[pdf.treatment == arm].post_outcome for arm in (1, 0))
    closed = np.sqrt(t.var(ddof=0) / len(t) + c.var(ddof=0) / len(c))
    assert got.n_reps == 1500
    assert got.std_error == pytest.approx(closed, rel=0.08)
    assert got.ci_low == pytest.approx(got.estimate - 1.96 * closed, abs=0.25 * closed)
    assert got.ci_high == pytest.approx(got.estimate + 1.96 * closed, abs=0.25 * closed)


def test_fixed_n_draws_exactly_n(spark):
    matched = matching.match_none(cohort(spark, study("A", 70, 400, 5)))
    by_arm = resampled_sums(matched, {"one": "1D"}, Bootstrap(reps=50, by_arm=True)).collect()
    assert {(r.treatment, r.one) for r in by_arm} == {(1, 70.0), (0, 400.0)}
    rows = resampled_sums(matched, {"one": "1D"}, Bootstrap(reps=50, by_arm=False)).toPandas()
    assert set(rows.groupby("rep").one.sum()) == {470.0}
    assert rows[rows.treatment == 1].one.nunique() > 5


def test_adjusted_bootstrap_refits_every_replicate(spark, two_studies):
    matched = matching.match_none(cohort(spark, two_studies))
    got = replicates(matched, "gee", Bootstrap(reps=200)).toPandas().groupby("study_id").estimate
    point = {r.study_id: r.estimate for r in estimators.effect(matched, "gee").collect()}
    for name, values in got:
        assert len(values) == 200 and abs(values.mean() - point[name]) < values.std()


def test_adding_a_study_changes_no_other_replicate(spark, two_studies):
    spec = Bootstrap(reps=20)
    both = replicates(matching.match_none(cohort(spark, two_studies)), "did", spec).toPandas()
    alone = replicates(
        matching.match_none(cohort(spark, two_studies[two_studies.study_id == "B"])), "did", spec
    ).toPandas()
    want = both[both.study_id == "B"].sort_values("rep").estimate.to_numpy()
    assert np.allclose(want, alone.sort_values("rep").estimate.to_numpy(), rtol=1e-12)


def differences(spark, values, name="S"):
    return spark.createDataFrame(
        [(name, i, float(v)) for i, v in enumerate(values)], "study_id string, patient_id long, d double")


def test_signed_rank_statistic_with_ties_and_zeros(spark, many_shards):
    values = np.random.default_rng(3).integers(-12, 15, 400)
    got = ranks.signed_rank(differences(spark, values)).first()
    kept = pd.Series(values[values != 0].astype(float))
    assert got.w_plus == pytest.approx(kept.abs().rank()[kept > 0].sum())
    n, ties = len(kept), kept.abs().value_counts()
    z = (got.w_plus - n * (n + 1) / 4) / np.sqrt(
        (n * (n + 1) * (2 * n + 1) - (ties**3 - ties).sum() / 2) / 24)
    from math import erfc, sqrt
    assert got.p_value == pytest.approx(erfc(abs(z) / sqrt(2)), rel=1e-9)


def test_small_signed_rank_is_exact(spark):
    values = [1.5, -2.0, 3.1, 4.2, -0.3, 6.0, 7.7]
    order = np.argsort(np.argsort(np.abs(values))) + 1
    w_plus = sum(r for r, v in zip(order, values) if v > 0)
    sums = [sum(r for r, s in zip(range(1, 8), signs) if s) for signs in itertools.product((0, 1), repeat=7)]
    w_min = min(w_plus, 28 - w_plus)
    want = min(1.0, 2 * sum(s <= w_min for s in sums) / len(sums))
    assert ranks.signed_rank(differences(spark, values)).first().p_value == pytest.approx(want)


def test_sign_test_equals_erf(spark):
    from math import erfc, sqrt
    values = [1.0] * 33 + [-1.0] * 17 + [0.0] * 5
    got = ranks.sign_test(differences(spark, values)).first()
    assert got.p_value == pytest.approx(erfc(abs((33 - 25) / sqrt(12.5)) / sqrt(2)), rel=1e-12)


def test_skewness_equals_numpy(spark):
    values = np.random.default_rng(8).exponential(3, 300)
    z = (values - values.mean()) / (values.std() + 1e-9)
    assert ranks.skewness(differences(spark, values)).first().skew == pytest.approx((z**3).mean(), rel=1e-9)


@pytest.mark.parametrize("prob", [0.0, 0.5, 0.99, 1.0])
@pytest.mark.parametrize("max_rows", [20, 1_000_000])
def test_quantiles_with_and_without_narrowing(spark, prob, max_rows):
    rng = np.random.default_rng(9)
    groups = {
        "hot": rng.normal(0, 1, 6000), "tied": np.where(rng.random(3000) < 0.6, 4.0, rng.random(3000) * 9),
        "wide": rng.lognormal(0, 6, 2000), "one": np.array([3.0]), "two": np.array([1.0, 2.0]),
    }
    pdf = pd.concat([pd.DataFrame({"g": g, "v": v}) for g, v in groups.items()])
    frame = spark.createDataFrame(pdf).repartition(6)
    got = {r.g: r.q for r in exact_quantile(frame, ["g"], "v", prob, "q", max_rows=max_rows).collect()}
    assert got == {g: pytest.approx(np.quantile(v, prob), rel=1e-12) for g, v in groups.items()}


def test_group_index_over_many_shards_follows_unit_order(spark, many_shards):
    frame = spark.range(5000).selectExpr("if(id < 4000, 'big', 'small') as g", "concat('u', id) as u").repartition(5)
    got = group_index(frame, ["g"], "u", "idx").toPandas()
    for _, part in got.groupby("g"):
        assert part.sort_values("u").idx.tolist() == list(range(len(part)))


def test_replicates_over_n_are_drawn_anew(spark, monkeypatch):
    from cohortlift.operators import bootstrap

    monkeypatch.setattr(bootstrap, "SHORTFALL", 0)  # about half of the first passes exceed n
    rows = spark.range(40).selectExpr(
        "'S' as study_id", "concat('t:', id) as unit_id", "cast(id % 2 as int) as treatment", "1D as weight")
    sums = resampled_sums(rows, {"w": "weight"}, Bootstrap(reps=60, by_arm=True)).collect()
    assert {r.w for r in sums} == {20.0} and len(sums) == 120


@pytest.mark.parametrize("by_arm", [True, False])
def test_draws_never_pass_through_the_driver(spark, by_arm):
    """They grow with the rows, but Spark's estimate of them does not: no plan may broadcast them."""
    matched = matching.match_none(cohort(spark, study("S", 70, 50, seed=4)))
    sums = resampled_sums(matched, {"one": "1D"}, Bootstrap(reps=20, by_arm=by_arm))
    assert sum(row.one for row in sums.collect()) == 20 * 120
    plan = sums._jdf.queryExecution().executedPlan().toString()
    joins = re.findall(r"(\w+Join)[^\[\n]* \[study_id#\d+, pool#\d+, idx#\d+L\]", plan)
    assert set(joins) == {"SortMergeJoin"}


def test_pin_computes_once_on_either_side_of_its_limit(spark):
    for limit in (10, 1000):
        seen = spark.sparkContext.accumulator(0)

        def count(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        frame = spark.range(200).repartition(4).mapInArrow(count, "id long")
        kept = pin(frame, max_rows=limit)
        assert kept.count() == 200 and kept.count() == 200
        assert seen.value == 200


def test_pin_keeps_every_row_beyond_its_limit(spark):
    frame = spark.range(50).selectExpr("id", "named_struct('a', id, 'b', concat('x', id)) as s")
    assert pin(frame, max_rows=10).count() == 50
    kept = pin(frame, max_rows=50)
    assert "LocalTableScan" in kept._jdf.queryExecution().executedPlan().toString()
    assert stage(frame, "t").count() == 50
