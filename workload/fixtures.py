"""Study tables derived from customers and their orders.

One patient is one customer.  Orders before 1998 give covariates and treatment (an urgent order),
1997 is the pre-period and 1998 the post-period.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

INDEX_DATE = "timestamp '1998-01-01 00:00:00'"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def covariates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer from a single aggregation of the orders."""
    before = f"o_orderdate < {INDEX_DATE}"
    history = (
        _read(spark, sf_dir, "orders")
        .filter("o_orderdate < timestamp '1999-01-01 00:00:00'")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.expr(f"count_if({before})").alias("n"),
            # Sums of exact amounts, so that no order of rows shows in the last digits.
            F.expr(f"cast(sum(if({before}, cast(o_totalprice as decimal(18, 4)), null)) as double)").alias("s"),
            F.expr(f"max(if({before} and o_orderpriority = '1-URGENT', 1, 0))").alias("u"),
            F.expr("cast(sum(if(year(o_orderdate) = 1997, cast(o_totalprice as decimal(18, 4)), null)) as double)").alias("pre"),
            F.expr("cast(sum(if(year(o_orderdate) = 1998, cast(o_totalprice as decimal(18, 4)), null)) as double)").alias("post"),
        )
    )
    return (
        _read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
        .join(history, "c_custkey", "left")
        .selectExpr(
            "c_custkey as patient_id", "c_mktsegment as segment",
            "coalesce(u, 0) as treatment",
            "40.0e0 + (c_acctbal + 1000.0e0) / 11000.0e0 * 50.0e0 as age",
            "nullif(n, 0) / 3.0e0 as risk_score",
            "coalesce(s, 0.0e0) / 100.0e0 as prior_cost",
            "coalesce(pre, 0.0e0) / 100.0e0 as pre_outcome",
            "coalesce(post, 0.0e0) / 100.0e0 as post_outcome",
        )
    )


_COHORT = (
    "study_id", "patient_id", "treatment", "age", "risk_score", "prior_cost", "pre_outcome",
    "post_outcome",
)


def cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covariates(spark, sf_dir).withColumn(
        "study_id", F.expr("concat('SEG_', segment)")
    ).select(*_COHORT)


def pe_cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        covariates(spark, sf_dir)
        .withColumn(
            "study_id",
            F.expr(
                "case patient_id % 3 when 0 then 'PE_ATT' when 1 then 'PE_RANK' else 'PE_SKEW' end"
            ),
        )
        .withColumn(
            "post_outcome",
            F.expr(
                "if(patient_id % 3 = 2, post_outcome * post_outcome / 1000.0e0, post_outcome)"
            ),
        )
        .select(*_COHORT)
    )


def phase_cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as studies of the models that the phased studies above leave out."""
    return pe_cohorts(spark, sf_dir).withColumn(
        "study_id", F.expr("case study_id when 'PE_ATT' then 'PF_DID' when 'PE_RANK' then 'PF_SIGN' else 'PF_FALL' end")
    )


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    yearly = (
        _read(spark, sf_dir, "orders")
        .filter(
            "o_orderdate >= timestamp '1997-01-01 00:00:00'"
            " and o_orderdate < timestamp '2001-01-01 00:00:00'"
        )
        .groupBy(F.col("o_custkey").alias("patient_id"), F.expr("year(o_orderdate) - 1997").alias("period"))
        .agg(F.expr("cast(sum(cast(o_totalprice as decimal(18, 4))) as double) / 100.0e0").alias("outcome"))
    )
    return covariates(spark, sf_dir).join(yearly, "patient_id").selectExpr(
        "if(patient_id % 2 = 0, 'LME_MIXED', 'LME_GROWTH') as study_id", "patient_id", "treatment",
        "age", "if(patient_id % 29 = 0, null, risk_score) as risk_score", "prior_cost",
        "cast(period as int) as period", "outcome",
    )


# Config rows follow the studies found in the customer table; plain SQL for both engines.
STUDY_CONFIG_SQL = """
select concat('SEG_', s) as study_id, concat('Program SEG_', s) as study_name,
       concat('Vendor ', right(s, 1)) as vendor,
       case when s = 'FURNITURE' then 'aggressive_impute' else 'standard' end as feature_method,
       case s when 'BUILDING' then 'knn' when 'FURNITURE' then 'ipw'
              when 'HOUSEHOLD' then 'stratified' else 'exact' end as matching_method,
       case s when 'BUILDING' then 'did' when 'FURNITURE' then 'ate' else 'att' end as model_method,
       case when s = 'MACHINERY' then 0.9985e0 else 0.6e0 end as min_quality_score
from (select distinct c_mktsegment as s from customer) segments
"""

MODULAR_CONFIG_SQL = """
select concat('SEG_', s) as study_id, concat('Program SEG_', s) as study_name,
       concat('Vendor ', right(s, 1)) as vendor,
       case when s = 'BUILDING' then null when s = 'HOUSEHOLD' then '' else 'standard' end as model_family,
       case when s = 'FURNITURE' then 'feature_aggressive_impute' else 'feature_standard' end as feature_nb,
       case when s = 'HOUSEHOLD' then 'matching_stratified' else 'matching_standard' end as matching_nb,
       case s when 'BUILDING' then 'knn' when 'FURNITURE' then 'ipw'
              when 'HOUSEHOLD' then 'stratified' else 'exact' end as matching_method,
       case s when 'BUILDING' then 'model_did' when 'FURNITURE' then 'model_ate' else 'model_att' end as model_nb,
       case when s = 'MACHINERY' then 0.9985e0 else 0.6e0 end as min_quality_score,
       s <> 'ARCHIVED' as active, cast(12 as bigint) as baseline_months,
       cast(1 as bigint) as performance_months
from (select distinct c_mktsegment as s from customer
      union all select 'ARCHIVED' as s from customer having count(*) > 0) segments
union all
select study_id, concat('Program ', study_id) as study_name, concat('Vendor ', right(study_id, 1)) as vendor,
       lower(study_id) as model_family, concat('feature_', lower(study_id)) as feature_nb,
       concat('matching_', lower(study_id)) as matching_nb, 'knn' as matching_method,
       concat('model_', lower(study_id)) as model_nb, 0.6e0 as min_quality_score, true as active,
       cast(12 as bigint) as baseline_months,
       cast(case when study_id = 'LME_MIXED' then 3 else 2 end as bigint) as performance_months
from (select distinct case when c_custkey % 2 = 0 then 'LME_MIXED' else 'LME_GROWTH' end as study_id
      from customer) families
"""

PE_CONFIG_SQL = """
select study_id, concat('Program ', study_id) as study_name,
       case when study_id = 'PE_ATT' then 'att' else 'wilcoxon' end as model_type,
       study_id = 'PE_ATT' as needs_matching,
       case when study_id = 'PE_ATT' then 'exact' else '' end as matching_method,
       case when study_id = 'PE_ATT' then 'None' else 'model_sign_test' end as fallback_model,
       cast(12 as bigint) as baseline_months, cast(6 as bigint) as performance_months,
       0.6e0 as min_quality_score, '' as experiment_name
from (select distinct case c_custkey % 3 when 0 then 'PE_ATT' when 1 then 'PE_RANK' else 'PE_SKEW' end
             as study_id from customer) studies
"""

PHASE_CONFIG_SQL = """
select study_id, concat('Program ', study_id) as study_name,
       case study_id when 'PF_DID' then 'did' when 'PF_SIGN' then 'sign_test' else 'wilcoxon' end as model_type,
       study_id = 'PF_DID' as needs_matching, case when study_id = 'PF_SIGN' then '' else 'exact' end as matching_method,
       case when study_id = 'PF_FALL' then 'model_did' else 'None' end as fallback_model,
       cast(12 as bigint) as baseline_months, cast(6 as bigint) as performance_months,
       0.6e0 as min_quality_score, '' as experiment_name
from (select distinct case c_custkey % 3 when 0 then 'PF_DID' when 1 then 'PF_SIGN' else 'PF_FALL' end
             as study_id from customer) studies
"""

#: What follows each phase, per study; for both engines.
PHASES_SQL = """
select study_id, phase, nextphase from (
  select study_id, 'feature_engineering' as phase, case when needs_matching then 'matching' else 'screening' end as nextphase
  from phase_config union all
  select study_id, 'screening', 'model_' || model_type from phase_config union all
  select study_id, 'matching', 'model_' || model_type from phase_config union all
  select study_id, 'model_' || model_type, case when fallback_model = 'None' then ' none ' else fallback_model end from phase_config union all
  select study_id, 'model_sign_test', 'review' from phase_config union all
  select study_id, 'review', case when study_id = 'PE_SKEW' then 'publication' end from phase_config
) steps"""

#: The same chains by recursion: ``phase_config`` is the config table.
PHASES_WALK_SQL = f"""
with recursive phase_config as ({PE_CONFIG_SQL}),
steps as (
  select study_id, phase, trim(nextphase) as nextphase from ({PHASES_SQL}) s where lower(trim(nextphase)) <> 'none'),
walk as (
  select study_id, 'feature_engineering' as phase, 'feature_engineering' as trace, cast(1 as bigint) as n_phases
  from phase_config
  union all
  select w.study_id, s.nextphase, w.trace || ' -> ' || s.nextphase, w.n_phases + 1
  from walk w join steps s on s.study_id = w.study_id and s.phase = w.phase where w.n_phases < 12)
select study_id, trace, n_phases from walk qualify row_number() over (partition by study_id order by n_phases desc) = 1
"""


def _config(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    return spark.sql(text.replace("from customer", "from {customer}"),
                     customer=_read(spark, sf_dir, "customer"))


def study_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _config(spark, sf_dir, STUDY_CONFIG_SQL)


def modular_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _config(spark, sf_dir, MODULAR_CONFIG_SQL)


def pe_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _config(spark, sf_dir, PE_CONFIG_SQL)


def phase_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(PHASES_SQL.replace("from phase_config", "from {phase_config}"), phase_config=pe_config(spark, sf_dir))


def phase_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _config(spark, sf_dir, PHASE_CONFIG_SQL)
