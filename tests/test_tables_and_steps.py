"""Published runs, per-study tables, stamps by manifest, phase chains, observed steps, order-free sums."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cohortlift import schemas
from cohortlift.functions import sums
from cohortlift.operators import bootstrap as boot
from cohortlift.operators import matching, report, routing
from cohortlift.operators.quantiles import exact_quantile
from cohortlift.plans import record
from cohortlift.plans.evaluate import evaluate
from cohortlift.plans.steps import Steps
from cohortlift.sources import ids, manifests, publish, sinks, stamps, tables
from cohortlift.sources.studies import StudyTable
from tests.frames import cohort, study


def test_a_run_is_published_once(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert publish.read_published(spark, path).count() == 0
    first = spark.createDataFrame([("a", 1.0)], "study_id string, estimate double")
    other = spark.createDataFrame([("b", 2.0, "x")], "study_id string, estimate double, note string")
    assert publish.publish(first, path, "run/1") and publish.publish(other, path, "run 2")
    assert not publish.publish(first.withColumn("estimate", F.lit(9.0)), path, "run/1")
    rows = sorted((r.run_id, r.study_id, r.estimate, r.note) for r in publish.read_published(spark, path).collect())
    assert rows == [("run 2", "b", 2.0, "x"), ("run/1", "a", 1.0, None)]
    assert sorted(r.run_id for r in publish.published_runs(spark, path).collect()) == ["run 2", "run/1"]


def test_the_second_of_two_racing_writers_does_not_commit(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    rows = spark.createDataFrame([(1,)], "v int")
    real, seen = publish.is_published, []

    def late(session, where, run_id):  # the first look comes before the other writer's commit
        seen.append(run_id)
        return False if len(seen) == 1 else real(session, where, run_id)

    assert publish.publish(rows, path, "r")
    monkeypatch.setattr(publish, "is_published", late)
    assert not publish.publish(rows.withColumn("v", F.lit(2)), path, "r")
    assert [r.v for r in publish.read_published(spark, path).collect()] == [1]


def test_rows_without_an_entry_are_not_read(spark, tmp_path):
    path = f"{tmp_path}/t"
    publish.publish(spark.createDataFrame([(1,)], "v int"), path, "r")
    spark.createDataFrame([(2, "lost")], "v int, run_id string").write.parquet(f"{path}/data/attempt-that-failed")
    assert publish.read_published(spark, path).count() == 1


RESULT = ("study_id string, run_ts string, matching_method string, model_method string, n_treated long, n_control long,"
          " estimate double, std_error double, ci_low double, ci_high double, naive_estimate double, significant boolean,"
          " source string")


def test_a_recorded_run_leaves_results_and_texts_once(spark, tmp_path):
    config = spark.createDataFrame([("S", "Study", "V")], "study_id string, study_name string, vendor string")
    results = spark.createDataFrame(
        [("S", "2026-01-01", "exact", "att", 2, 3, 1.5, 0.1, 1.0, 2.0, 2.5, True, "after")], RESULT)
    folder = f"{tmp_path}/f"
    assert record.record_results(results, config, folder, "r1", bias_note=False)
    assert not record.record_results(results, config, folder, "r1")
    texts = publish.read_published(spark, f"{folder}/insights").collect()
    assert len(texts) == 1 and "shifted the estimate by -1.0. n=2" in texts[0].interpretation
    assert publish.read_published(spark, f"{folder}/results").count() == 1
    assert texts[0].run_ts[:4].isdigit() and texts[0].run_ts.endswith("+00:00")


def test_a_studys_rows_are_pruned_and_not_shuffled(spark):
    rows = spark.range(4000).selectExpr("concat('S', id % 7) as study_id", "id as patient_id", "id * 2 as v")
    table = StudyTable.save(rows, buckets=3)
    chosen = spark.createDataFrame([("S1", 1), ("S4", 0)], "study_id string, keep int").filter("keep = 1")
    found = table.rows_of(chosen)
    plan = found._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "dynamicpruning" in plan
    assert sorted(r.patient_id for r in found.collect()) == list(range(1, 4000, 7))
    assert found.select(F.input_file_name()).distinct().count() <= 3
    other = StudyTable.save(rows.withColumnRenamed("v", "w"), buckets=3)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.requireAllClusterKeysForCoPartition": "false"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = table.rows().join(other.rows(), ["study_id", "patient_id"])
        assert joined.count() == 4000
        text = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text and text.count("Exchange hashpartitioning") == 0
    finally:
        for key in settings:
            spark.conf.unset(key)
    table.drop(), other.drop()


def test_restamping_rereads_what_changed(spark, tmp_path):
    path, manifest = f"{tmp_path}/t", f"{tmp_path}/m"
    rows = spark.range(300).selectExpr("concat('s ', id % 5, ':') as study_id", "id", "id / 7 as x", "cast(null as string) as n")
    sinks.save_partitioned(rows, path)

    def full():
        return tuple(stamps.content_stamp(spark.read.parquet(path)).first())

    first = manifests.restamp(spark, path, manifest)
    assert len(first.reread) == 5 and (first.n_rows, first.stamp) == full()
    assert manifests.restamp(spark, path, manifest).reread == []
    sinks.save_partitioned(rows.filter("id % 5 = 3").withColumn("x", F.lit(0.5)), path)
    second = manifests.restamp(spark, path, manifest)
    assert len(second.reread) == 1 and (second.n_rows, second.stamp) == full() and second.stamp != first.stamp
    sinks.save_partitioned(rows.selectExpr("'new' as study_id", "id", "x", "n"), path)
    third = manifests.restamp(spark, path, manifest)
    assert len(third.reread) == 1 and (third.n_rows, third.stamp) == full() and third.n_rows == 600


def steps_of(spark, *pairs, study="s"):
    return spark.createDataFrame([(study, a, b) for a, b in pairs], "study_id string, phase string, nextphase string")


def test_phase_chains_of_any_length(spark):
    pairs = [("feature_engineering", "a"), ("a", " b "), ("b", "c"), ("c", "d"), ("d", "None")]
    assert routing.phase_chain(steps_of(spark, *pairs)).first().trace == "feature_engineering -> a -> b -> c -> d"
    assert routing.phase_chain(steps_of(spark, *pairs), max_steps=3).first().phases == ["feature_engineering", "a", "b"]
    long = [("feature_engineering", "p0")] + [(f"p{i}", f"p{i + 1}") for i in range(30)]
    assert len(routing.phase_chain(steps_of(spark, *long)).first().phases) == 12
    none = steps_of(spark, ("feature_engineering", None), ("x", ""))
    assert routing.phase_chain(none).first().phases == ["feature_engineering"]


@pytest.mark.parametrize("pairs", [
    [("feature_engineering", "a"), ("a", "feature_engineering")],
    [("feature_engineering", "a"), ("a", "b"), ("b", "a")],
    [("feature_engineering", "a"), ("feature_engineering", "b")],
])
def test_circles_and_forks_of_phases_are_errors(spark, pairs):
    with pytest.raises(PySparkException):
        routing.phase_chain(steps_of(spark, *pairs)).collect()


def test_steps_count_rows_while_they_are_written(spark):
    steps = Steps()
    rows = spark.range(10).selectExpr("id", "cast(id % 3 = 0 as int) as treatment")
    assert steps.stage("one", lambda: rows, "observed").count() == 10
    steps.stage("none", lambda: rows.limit(0), "observed")
    steps.timed("two", lambda: rows)
    found = {r.step: r for r in steps.table(spark).collect()}
    assert (found["one"].n_rows, found["one"].n_treated) == (10, 4) and found["none"].n_rows == 0
    assert found["two"].n_rows is None and all(r.seconds > 0 for r in found.values() if r.step != "two")


@pytest.mark.parametrize("stamped", [False, True])
def test_a_run_derives_its_rows_once(spark, stamped):
    derived = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def seen(x):
        derived.add(1)
        return x

    rows = cohort(spark, pd.concat([study("A", 60, 70, 1), study("B", 50, 50, 2)]))
    rows = rows.withColumn("risk_score", seen("risk_score")).withColumn("note", F.lit(None))
    config = tables.seed_config(
        spark, [("A", "Program A", "V", "standard", "exact", "att", 0.5), ("B", "Program B", "V", "standard", "ipw", "ate", 0.5)],
        schemas.STUDY_CONFIG)
    spec = boot.Bootstrap(reps=5)
    assert evaluate(rows, None, config, bootstrap=spec, stamped=stamped).count() == 2
    assert derived.value == 230


def test_binned_sums_do_not_depend_on_order(spark):
    rng = random.Random(5)
    values = [rng.uniform(-1, 1) * 10.0 ** rng.randint(-9, 9) for _ in range(5000)] + [0.1] * 64 + [0.0]
    exact = sum(map(__import__("fractions").Fraction, values))
    found = set()
    for _ in range(5):
        rng.shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "x double").repartition(rng.randint(1, 9))
        bounds = df.selectExpr(f"{sums.largest('x')} as most", "count(*) as n")
        grid = bounds.selectExpr(*(f"{sql} as {name}" for name, sql in sums.grids("x", "most", "n").items()))
        bins = df.crossJoin(grid).selectExpr(*(f"{sql} as {name}" for name, sql in sums.bins("x").items()))
        found.add(bins.selectExpr("sum(x_high) + sum(x_low)").first()[0])
    assert len(found) == 1 and abs(found.pop() - float(exact)) <= abs(float(exact)) * 1e-15 + 1e-12


def test_replicates_do_not_depend_on_the_order_of_rows(spark):
    rng = random.Random(6)
    rows = [("s", i, i % 2, rng.uniform(20, 90), rng.uniform(0, 3), rng.uniform(0, 1e4), rng.uniform(0, 1e4), rng.uniform(0, 1e4))
            for i in range(60)]
    seen = set()
    for turn in range(20):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "study_id string, patient_id long, treatment int, age double, risk_score double,"
                                   " prior_cost double, pre_outcome double, post_outcome double").repartition(1 + turn % 5)
        matched = matching.match_none(df)
        found = boot.replicates(matched, "did", boot.Bootstrap(reps=6, by_arm=bool(turn % 2)))
        seen.add((turn % 2, tuple(sorted((r.rep, r.estimate) for r in found.collect()))))
    assert len(seen) == 2


def test_ids_by_name_survive_repeated_batches(spark, tmp_path):
    marks, table = f"{tmp_path}/marks", "ids_by_name_test"
    spark.sql(f"drop table if exists {table}")
    first = spark.createDataFrame([("b",), ("a",)], "name string")
    second = spark.createDataFrame([("c",)], "name string")
    assert ids.append_batch(first, ["name"], table, "one", marks)
    assert ids.append_batch(second, ["name"], table, "two", marks)
    assert not ids.append_batch(first, ["name"], table, "one", marks)
    assert {(r.name, r.patient_id) for r in spark.table(table).collect()} == {("a", 1), ("b", 2), ("c", 3)}
    assert ids.reserve(spark, table, "three", 5, marks) == 4 and ids.reserve(spark, table, "three", 5, marks) == 4
    assert ids.reserve(spark, table, "four", 1, marks) == 9
    with pytest.raises(ValueError):
        ids.reserve(spark, table, "four", 2, marks)
    spark.sql(f"drop table {table}")


def test_two_batches_cannot_reserve_the_same_ids(spark, tmp_path, monkeypatch):
    marks = f"{tmp_path}/marks"
    real, turn = ids.publish, []

    def raced(entry, path, run_id):  # another batch commits just before
        if not turn:
            turn.append(run_id)
            other = spark.createDataFrame([("t", "other", 1, 10)], "table_name string, batch string, first_id long, n_rows long")
            assert real(other, path, run_id)
        return real(entry, path, run_id)

    monkeypatch.setattr(ids, "publish", raced)
    assert ids.reserve(spark, "t", "mine", 3, marks) == 11


@pytest.mark.parametrize("max_rows,slack", [(10**6, 0.0025), (20, 0.0025), (20, 0.02), (10**6, 1e-9)])
def test_quantiles_of_ties_nan_and_wide_ranges(spark, max_rows, slack):
    rng = random.Random(3)
    groups = {
        "ties": [1.0] * 400 + [2.0] * 300 + [3.0] * 301, "one": [5.0], "wide": [rng.uniform(-1, 1) * 10 ** rng.randint(-300, 300) for _ in range(999)],
        "inf": [float("-inf"), 1.0, 2.0, float("inf")], "even": [float(i) for i in range(1000)],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("nan", float("nan"))] * 3 + [("half", v) for v in (1.0, 2.0, float("nan"))]
    frame = spark.createDataFrame(rows + [("even", None), ("none", None)], "g string, v double").repartition(5)
    got = {r.g: r.q for r in exact_quantile(frame, ["g"], "v", 0.25, "q", max_rows=max_rows, size=64, slack=slack).collect()}
    for g, values in groups.items():
        if g != "inf":
            assert got[g] == pytest.approx(np.quantile(values, 0.25), rel=1e-12)
    assert np.isnan(got["nan"]) and got["half"] == 1.5 and "none" not in got


def test_rows_without_a_score_have_no_pair_and_no_weight(spark):
    rows = [("S", i, i % 2, 40.0 + (7 * i) % 31, None if i in (3, 4) else 0.5 + i / 20, 100.0 * ((3 * i) % 11), 1.0, 2.0 + i % 2) for i in range(30)]
    frame = spark.createDataFrame(rows, schemas.COHORT)
    assert {(r.treatment, r.n, r.n_unscored) for r in matching.unscored(frame).collect()} == {(0, 15, 1), (1, 15, 1)}
    assert not {r.patient_id for r in matching.match_knn(frame).collect()} & {3, 4}
    weights = {r.patient_id: r.weight for r in matching.match_ipw(frame).collect()}
    assert weights[3] is None and weights[4] is None and sum(w is not None for w in weights.values()) == 28


def test_distinct_sketches_merge(spark):
    df = spark.range(60000).selectExpr("id % 3 as g", "id % 2 as h", "id % 20000 as v")
    kept = report.distinct_sketches(df, ["g", "h"], "v")
    near = {r.g: r.n_approx for r in report.approx_distinct(kept, ["g"]).collect()}
    assert len(near) == 3 and all(abs(n - 20000) < 0.05 * 20000 for n in near.values())
    assert report.distinct_sketches(df.limit(0), ["g"], "v").count() == 0
