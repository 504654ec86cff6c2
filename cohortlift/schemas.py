"""Declared schemas of every table the library reads or writes."""

from pyspark.sql.types import (
    BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
)

_TYPES = {
    kind.simpleString(): kind
    for kind in (StringType(), DoubleType(), LongType(), IntegerType(), BooleanType())
}


def _ddl(text: str) -> StructType:
    """A schema from its DDL text; Spark's own parser would need a session at import."""
    columns = (column.split() for column in text.split(","))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in columns])


# Names and types of the tables' columns.
STUDY_CONFIG = _ddl(
    "study_id string, study_name string, vendor string, feature_method string, "
    "matching_method string, model_method string, min_quality_score double"
)
STUDY_CONFIG_MODULAR = _ddl(
    "study_id string, study_name string, vendor string, model_family string, feature_nb string, "
    "matching_nb string, matching_method string, model_nb string, min_quality_score double, "
    "active boolean, baseline_months bigint, performance_months bigint"
)
PE_STUDY_CONFIG = _ddl(
    "study_id string, study_name string, model_type string, needs_matching boolean, "
    "matching_method string, fallback_model string, baseline_months bigint, "
    "performance_months bigint, min_quality_score double, experiment_name string"
)
COHORT = _ddl(
    "study_id string, patient_id bigint, treatment int, age double, risk_score double, "
    "prior_cost double, pre_outcome double, post_outcome double"
)
PANEL = _ddl(
    "study_id string, patient_id bigint, treatment int, age double, risk_score double, "
    "prior_cost double, period int, outcome double"
)
FEATURES = _ddl(
    "study_id string, patient_id bigint, treatment int, age double, risk_score double, "
    "prior_cost double, pre_outcome double, post_outcome double, slope double"
)
EVALUATION_RESULTS_BASE = _ddl(
    "study_id string, run_ts string, matching_method string, model_method string, n_treated bigint, "
    "n_control bigint, estimate double, std_error double, ci_low double, ci_high double, "
    "naive_estimate double, significant boolean, source string"
)
EVALUATION_RESULTS = _ddl(
    "study_id string, run_ts string, matching_method string, model_method string, n_treated bigint, "
    "n_control bigint, estimate double, std_error double, ci_low double, ci_high double, "
    "naive_estimate double, significant boolean, source string, config_version bigint, "
    "data_version bigint, job_run_id string"
)
EVALUATION_INSIGHTS = _ddl(
    "study_id string, run_ts string, headline string, interpretation string"
)
PE_EVALUATION_RESULTS = _ddl(
    "run_id string, study_id string, model_method string, matching_method string, estimate double, "
    "std_error double, ci_low double, ci_high double, p_value double, n_treated int, n_control int, "
    "pe_environment string, ts string"
)
PE_STEP_LOG = _ddl(
    "run_id string, study_id string, step_id string, step_name string, status string, "
    "pass_description string, error_msg string, n_input int, n_treated int, n_columns int, "
    "execution_time double, pe_environment string, ts string"
)
