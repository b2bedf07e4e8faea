"""Time the steps of the analysis; prints one line of JSON.

Every step writes the table it makes, as the baseline's steps do, and reads the
tables before it; those that the pipeline stores itself are written once, by it. Two runs over the same data come first and are not counted: they
hold the start of the JVM and its compilation, which a session pays once.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

import fixture  # noqa: E402
from waitline.operators import marts, quality  # noqa: E402
from waitline.plans.pipeline import Inputs, Pipeline  # noqa: E402
from waitline.plans.store import Store  # noqa: E402


def run(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    store = Store(spark)
    seconds: dict[str, float] = {}

    def timed(name: str, step) -> None:
        start = time.perf_counter()
        step()
        seconds[name] = round(time.perf_counter() - start, 3)

    def stored(name: str, table: str | None = None):
        return lambda: store.keep(f"out_{name}", getattr(pipeline, table or name))

    def collected(frames: Callable[[], list[DataFrame]]):
        return lambda: [frame.collect() for frame in frames()]

    holder: list[Inputs] = []
    timed(
        "load",
        lambda: holder.append(
            fixture.inputs_from_orders(spark.read.parquet(f"{sf_dir}/orders.parquet"), store)
        ),
    )
    inputs = holder[0]
    pipeline = Pipeline(inputs, store)
    log = inputs.events_log
    timed(
        "raw_quality",
        collected(lambda: [
            quality.row_counts({"cases": inputs.cases, "events_log": log}),
            quality.intake_coverage(inputs.cases),
            quality.event_rates(log),
            quality.duplicate_groups(log),
            quality.events_per_case(pipeline.case_profile),
            quality.status_coverage(pipeline.case_profile),
            quality.triage_before_intake(pipeline.case_profile),
            quality.triage_before_intake(pipeline.case_profile, "event_ts_canonical"),
            quality.cancelled_and_resolved(pipeline.case_profile),
        ]),
    )
    timed("w1_p2_events_clean", lambda: pipeline.events_clean)
    timed("a5_wait_minutes", lambda: pipeline.wait_minutes)
    timed("a2_case_milestones", stored("case_milestones"))
    timed("m3_staffing_daily", lambda: pipeline.staffing_daily)
    timed("m4_backlog_daily_proxy", lambda: pipeline.backlog_daily_proxy)
    timed("m5_congestion_daily", stored("congestion_daily"))
    timed("m6_congestion_daily_v2", stored("congestion_daily_v2"))
    timed("a7_a8_a11_case_facts", lambda: pipeline.case_facts)
    timed("m1_sla_daily", lambda: pipeline.sla_daily)
    timed("m2_sla_by_tier_case_type", lambda: pipeline.sla_by_tier_case_type)
    timed("q14_q16_sla_headline", collected(lambda: [
        quality.breach_rates(pipeline.case_sla_metrics),
        marts.sla_percentiles(pipeline.case_sla_metrics),
    ]))
    timed("w2_case_deciles", lambda: pipeline.case_deciles)
    timed("m7_driver_congestion_buckets", stored("driver_congestion_buckets"))
    timed("m8_driver_reopen_impact", lambda: pipeline.driver_reopen_impact)
    timed("m9_driver_stage_durations", lambda: pipeline.driver_stage_durations)
    timed("m10_driver_summary", stored("driver_summary"))
    timed("a10_reopen_penalty", lambda: pipeline.reopen_penalty)
    timed("m11_scenario_results", stored("scenario_results"))
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        # The steps have more generated classes than the default cache of 100 holds.
        .config("spark.sql.codegen.cache.maxEntries", "5000")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for _ in range(2):
        run(spark, sf_dir)
    seconds = run(spark, sf_dir)
    print(
        json.dumps(
            {
                "metric": "sla_analysis_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
