"""A cross-section of the queries beside their SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from check import canonical, difference, oracle_rows
from workload.oracles import all_oracles
from workload.queries import all_queries

SF = "/root/testdata/sf0.001"
CHOSEN = (
    "config_scan", "sink_overwrite", "results_union", "assign_ids", "data_stamp", "select_subset",
    "family_split", "gate_fail", "phase_trace", "quality_score", "impute_arm", "panel_features",
    "common_strata", "match_knn", "match_ipw", "effect_mixed", "effect_lme_growth",
    "bootstrap_panel", "publish_runs", "record_run", "study_intermediate", "stamp_manifest", "phase_chain", "observed_steps",
    "rank_or_sign", "wilcoxon", "headline", "interpretation", "step_log",
)


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_its_oracle(spark, name):
    df = contract.queries()[name](spark, SF)
    columns, _, expected = oracle_rows(SF, contract.oracle_sql()[name])
    assert sorted(df.columns) == sorted(columns)
    rows = [tuple(row) for row in df.collect()]
    assert difference(canonical(df.columns, rows), canonical(columns, expected)) is None


def test_entry_returns_result_rows(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 6 and all(row.ci_low <= row.ci_high for row in rows)
