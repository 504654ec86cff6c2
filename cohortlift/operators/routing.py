"""Routing decisions as columns of the status table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def route_before(status: DataFrame) -> DataFrame:
    """The matching x model branch each study takes; null where none exists or the gate failed."""
    return status.withColumn(
        "branch",
        F.expr(
            "case when quality_passed and matching_method in ('exact', 'knn')"
            " and model_method in ('att', 'did')"
            " then concat_ws('_', 'model', matching_method, model_method) end"
        ),
    )


def next_phase(status: DataFrame) -> DataFrame:
    """Phase after features: None on failure, else matching or directly the model."""
    return status.withColumn(
        "nextphase",
        F.expr(
            "case when not quality_passed then 'None' when needs_matching then 'matching'"
            " else concat('model_', model_type) end"
        ),
    )


def phase_chain(
    transitions: DataFrame, start: str = "feature_engineering", max_steps: int = 12
) -> DataFrame:
    """(study_id, phases, trace): the phases each study runs through, however they are configured.

    ``transitions`` says, per study, which ``nextphase`` follows a ``phase``; null, blank and 'none' in any case
    end the chain, and so does a phase without a transition.  At most ``max_steps`` phases run.  A phase that
    comes up a second time, or has two transitions, is an error.  A study's transitions are its configuration,
    so they are few, and the walk needs no join.
    """
    ends = "nextphase is null or lower(trim(nextphase)) in ('', 'none')"
    steps = transitions.filter(f"not ({ends})").selectExpr("study_id", "phase", "trim(nextphase) as nextphase")
    known = transitions.select("study_id").distinct().join(
        steps.groupBy("study_id").agg(
            F.map_from_entries(F.collect_list(F.struct("phase", "nextphase"))).alias("follows")
        ), "study_id", "left",
    )

    def further(path, _):
        following = F.try_element_at("follows", F.element_at(path, -1))
        cycle = F.raise_error(F.concat(
            F.lit("phases run in a circle: "), F.concat_ws(" -> ", path), F.lit(" -> "), following
        ))
        return F.when(following.isNull(), path).when(
            F.array_contains(path, following), cycle.cast("array<string>")
        ).otherwise(F.concat(path, F.array(following)))

    walked = F.aggregate(F.sequence(F.lit(1), F.lit(max_steps)), F.array(F.lit(start)), further)
    return known.select("study_id", F.slice(walked, 1, max_steps).alias("phases")).withColumn(
        "trace", F.concat_ws(" -> ", "phases")
    )


def phase_transitions(status: DataFrame, fallbacks: DataFrame) -> DataFrame:
    """(study_id, phase, nextphase) of every study: what its config, gate and data lead to."""
    routed = fallbacks.filter("routed").selectExpr("study_id", "model_phase")
    rows = next_phase(status).join(routed, "study_id", "left")
    return rows.selectExpr(
        "study_id",
        "inline(array(named_struct('phase', 'feature_engineering', 'nextphase', nextphase),"
        " named_struct('phase', 'matching', 'nextphase', concat('model_', model_type)),"
        " named_struct('phase', concat('model_', model_type), 'nextphase',"
        " if(model_type = 'wilcoxon', model_phase, null))))",
    )


def phase_trace(status: DataFrame, fallbacks: DataFrame) -> DataFrame:
    """The status of each study with the chain of phases it runs through, joined by arrows."""
    chains = phase_chain(phase_transitions(status, fallbacks))
    return next_phase(status).join(chains.select("study_id", "trace"), "study_id")
