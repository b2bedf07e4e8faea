"""The figures of each step, as small DataFrames and as JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame

from waitline.operators import marts, quality, scenarios
from waitline.plans.pipeline import Pipeline
from waitline.sources.tables import write_json


def raw_quality(pipeline: Pipeline) -> dict[str, DataFrame]:
    inputs, profile = pipeline.inputs, pipeline.case_profile
    return {
        "counts": quality.row_counts(
            {
                "raw.cases": inputs.cases,
                "raw.events_log": inputs.events_log,
                "raw.calendar_dim": inputs.calendar,
                "raw.staffing_schedule": inputs.staffing,
            }
        ),
        "intake_coverage": quality.intake_coverage(inputs.cases),
        "event_rates": quality.event_rates(inputs.events_log),
        "duplicate_groups": quality.duplicate_groups(inputs.events_log),
        "events_per_case": quality.events_per_case(profile),
        "status_coverage": quality.status_coverage(profile),
        "triage_before_intake": quality.triage_before_intake(profile),
        "triage_before_intake_canonical": quality.triage_before_intake(
            profile, "event_ts_canonical"
        ),
        "cancelled_and_resolved": quality.cancelled_and_resolved(profile),
    }


def staging(pipeline: Pipeline) -> dict[str, DataFrame]:
    return {
        "dedup_reconciliation": quality.dedup_reconciliation(
            pipeline.inputs.events_log, pipeline.events_deduped
        ),
        "triage_before_intake_after_repair": quality.triage_before_intake_after_repair(
            pipeline.case_milestones
        ),
        "clean_event_anomalies": quality.clean_event_anomalies(pipeline.events_clean),
    }


def sla(pipeline: Pipeline) -> dict[str, DataFrame]:
    table = pipeline.case_sla_metrics
    return {
        "counts": quality.row_counts(
            {
                "business_minutes_dim": pipeline.clock.minute_spine(),
                "case_sla_metrics": table,
            }
        ),
        "breach_rates": quality.breach_rates(table),
        "triage_before_intake": quality.sla_triage_before_intake(table),
        "percentiles": marts.sla_percentiles(table),
    }


def mart_figures(pipeline: Pipeline) -> dict[str, DataFrame]:
    names = (
        "sla_daily",
        "sla_by_tier_case_type",
        "staffing_daily",
        "backlog_daily_proxy",
        "congestion_daily",
    )
    return {
        "counts": quality.row_counts({f"mart_{n}": getattr(pipeline, n) for n in names}),
        "daily_breach_means": quality.daily_breach_means(pipeline.sla_daily),
        "congestion_summary": quality.congestion_summary(pipeline.congestion_daily),
    }


def driver_figures(pipeline: Pipeline) -> dict[str, DataFrame]:
    names = (
        "case_stage_durations",
        "driver_congestion_buckets",
        "driver_reopen_impact",
        "driver_stage_durations",
        "driver_summary",
    )
    return {
        "counts": quality.row_counts({n: getattr(pipeline, n) for n in names}),
        "driver_summary": pipeline.driver_summary,
        "bottleneck_stage": pipeline.bottleneck_stage,
    }


def scenario_figures(pipeline: Pipeline) -> dict[str, DataFrame]:
    results = pipeline.scenario_results
    return {
        "counts": quality.row_counts(
            {"reopen_penalty_rows": pipeline.reopen_penalty, "scenario_results_rows": results}
        ),
        "scenario_results": scenarios.scenario_headline(results),
    }


STEPS = {
    "raw_quality": raw_quality,
    "staging": staging,
    "sla": sla,
    "marts": mart_figures,
    "drivers": driver_figures,
    "scenarios": scenario_figures,
}


def write_figures(pipeline: Pipeline, folder: str) -> list[str]:
    """Write every figure to ``<folder>/<step>/<figure>`` as JSON; the paths below the folder."""
    written = []
    for step, figures in STEPS.items():
        for name, df in figures(pipeline).items():
            write_json(df, f"{folder}/{step}/{name}")
            written.append(f"{step}/{name}")
    return written
