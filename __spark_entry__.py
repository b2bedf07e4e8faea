
from __future__ import annotations

import datetime as dt
import importlib
import sys
import uuid
from collections.abc import Callable
from functools import cache, reduce
from importlib.util import find_spec
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HERE = str(Path(__file__).resolve().parent)
sys.path.insert(0, HERE)

import fixture  # noqa: E402
import oracles  # noqa: E402
from waitline import schemas  # noqa: E402
from waitline.functions.clock import micros_since_1970, to_team_time  # noqa: E402
from waitline.functions.zones import in_team_time  # noqa: E402
from waitline.operators import (  # noqa: E402
    events,
    marts,
    milestones,
    periods,
    quality,
    scenarios,
    sla,
    timejoin,
)
from waitline.plans import observed, reports  # noqa: E402
from waitline.plans.pipeline import REPORT_ORDER, Inputs, Pipeline  # noqa: E402
from waitline.plans.refresh import Refresh  # noqa: E402
from waitline.plans.store import Store  # noqa: E402
from waitline.plans.zones import zoned_sla_metrics  # noqa: E402
from waitline.settings import Settings, WorkingHours  # noqa: E402
from waitline.sources import calendar as calendars  # noqa: E402
from waitline.sources import staffing, tables  # noqa: E402
from waitline.streaming import dedup  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]

_VARIANTS = {
    "default": Settings(),
    "left": Settings(sla_mode="left"),
    "all": Settings(stages_require_wait=False),
    "short": Settings(exposure_days=2, hours=WorkingHours(9, 12)),
}


@cache
def _shared(application: str, sf_dir: str, variant: str) -> Pipeline:
    """One pipeline per session, data folder and variant, so its stored tables are made once."""
    if variant != "default":
        base = _shared(application, sf_dir, "default")
        return Pipeline(base.inputs, base.store, _VARIANTS[variant])
    spark = SparkSession.active()
    store = Store(spark)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return Pipeline(fixture.inputs_from_orders(orders, store), store)


def _pipeline(spark: SparkSession, sf_dir: str, variant: str = "default") -> Pipeline:
    return _shared(spark.sparkContext.applicationId, str(sf_dir).rstrip("/"), variant)


def _table(name: str, variant: str = "default") -> Query:
    return lambda spark, sf_dir: getattr(_pipeline(spark, sf_dir, variant), name)


def _on(
    function: Callable[..., DataFrame], *names: str, variant: str = "default", **options
) -> Query:
    """A function of pipeline tables, or of inputs where the name begins with ``raw.``."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        pipeline = _pipeline(spark, sf_dir, variant)
        arguments = [
            getattr(pipeline.inputs, n[4:]) if n.startswith("raw.") else getattr(pipeline, n)
            for n in names
        ]
        return function(*arguments, **options)

    return query


def _fresh_path(pipeline: Pipeline, name: str) -> str:
    return pipeline.store.path(f"{name}-{uuid.uuid4().hex[:8]}")


# Sources and sinks: each writes to a fresh folder and returns what it reads back.


def _scan_staffing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pipeline = _pipeline(spark, sf_dir)
    path = _fresh_path(pipeline, "staffing_schedule")
    pipeline.inputs.staffing.write.parquet(path)
    return tables.read_table(spark, path, schemas.STAFFING, "staffing_schedule")


def _by_day(pipeline: Pipeline, df: DataFrame, schema, name: str) -> DataFrame:
    path = _fresh_path(pipeline, name)
    tables.write_partitioned(df, path)
    return tables.read_table(df.sparkSession, path, schema, name)


def _scan_partitioned_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    pipeline = _pipeline(spark, sf_dir)
    cases = pipeline.inputs.cases
    schema = schemas.cases_schema(cases.schema["case_id"].dataType)
    return _by_day(pipeline, cases, schema, "cases")


def _write_partitioned_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    pipeline = _pipeline(spark, sf_dir)
    log = pipeline.inputs.events_log
    schema = schemas.events_schema(log.schema["case_id"].dataType)
    return _by_day(pipeline, log, schema, "events_log")


def _replace_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all days, write the days of the latest year again, read all of them."""
    pipeline = _pipeline(spark, sf_dir)
    log = pipeline.inputs.events_log.select("event_id", "case_id", "intake_date")
    path = _fresh_path(pipeline, "events_by_day")
    tables.write_partitioned(log, path)
    latest = log.agg(F.max(F.year("intake_date"))).scalar()
    tables.write_partitioned(
        log.filter(F.year("intake_date") == latest), path, only_given_days=True
    )
    return spark.read.schema(log.schema).parquet(path)


def _saved_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    pipeline = _pipeline(spark, sf_dir)
    name = f"sla_by_tier_case_type_{uuid.uuid4().hex[:8]}"
    path = _fresh_path(pipeline, name)
    return tables.save_table(pipeline.sla_by_tier_case_type, name, path)


def _csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    pipeline = _pipeline(spark, sf_dir)
    folder = _fresh_path(pipeline, "export")
    return quality.row_counts(
        {
            name: spark.read.option("header", True).csv(f"{folder}/{name}")
            for name in pipeline.export(folder)
        }
    )


@cache
def _exported(application: str, sf_dir: str) -> str:
    """The folder of the exported reports of a session's pipeline."""
    pipeline = _shared(application, sf_dir, "default")
    folder = _fresh_path(pipeline, "reports")
    pipeline.export(folder)
    return folder


def _csv(report: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = _exported(spark.sparkContext.applicationId, str(sf_dir).rstrip("/"))
        schema = getattr(_pipeline(spark, sf_dir), report).schema
        return spark.read.option("header", True).schema(schema).csv(f"{folder}/{report}")

    return query


@cache
def _raw_folder(application: str, sf_dir: str) -> str:
    """The inputs as a user has them: cases and events by day, the others in one folder each."""
    made = _shared(application, sf_dir, "default")
    folder = _fresh_path(made, "raw")
    tables.write_partitioned(made.inputs.cases, f"{folder}/cases")
    tables.write_partitioned(made.inputs.events_log, f"{folder}/events_log")
    made.inputs.calendar.write.parquet(f"{folder}/calendar_dim")
    made.inputs.staffing.write.parquet(f"{folder}/staffing_schedule")
    return folder


@cache
def _published(application: str, sf_dir: str) -> str:
    """Read the inputs as a user does, publish all tables; the tables' prefix."""
    spark = SparkSession.active()
    prefix = f"p{uuid.uuid4().hex[:8]}_"
    made = _shared(application, sf_dir, "default")
    read = Inputs.from_parquet(spark, _raw_folder(application, sf_dir), case_id="bigint")
    stages = Store(spark)
    Pipeline(read, stages).publish(prefix, _fresh_path(made, "tables"))
    stages.clear()
    return prefix


def _from_catalog(table: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        prefix = _published(spark.sparkContext.applicationId, str(sf_dir).rstrip("/"))
        return spark.table(f"{prefix}{table}")

    return query


#: Batches of the streamed log at least, and rows of a batch and of a file at most. The stream
#: holds the events of a batch until the next one, so batches may not grow with the log.
STREAM_BATCHES = 4
BATCH_ROWS = 4_000_000
FILE_ROWS = 100_000


def _streamed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log in files by arrival, late events two days late, read as a stream batch by batch."""
    pipeline = _pipeline(spark, sf_dir)
    log = pipeline.inputs.events_log
    folder = _fresh_path(pipeline, "stream")
    late = F.col("ingestion_ts") + F.expr("IF(is_late_arriving, INTERVAL 2 DAY, INTERVAL 0 DAY)")
    arrival = dedup.instant(late).cast("double")
    timed = log.withColumn("arrival", arrival).filter("arrival IS NOT NULL")
    arrived, latest = timed.agg(F.count("*"), F.max("ingestion_ts")).first()
    if not arrived:
        return events.dedupe(log)
    batches = max(STREAM_BATCHES, -(-arrived // BATCH_ROWS))
    files = min(
        int(spark.conf.get("spark.sql.shuffle.partitions")), -(-arrived // (batches * FILE_ROWS))
    )
    written = timed.repartitionByRange(batches * files, "arrival").drop("arrival")
    with tables.small_splits(spark):
        written.write.parquet(f"{folder}/log")
    dedup.order_files(spark, f"{folder}/log")
    for _ in ("the log", "a heartbeat"):
        stream = dedup.read_log(spark, f"{folder}/log", log.schema, files)
        deduped = dedup.dedupe(stream, "4 days")
        dedup.start(deduped, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
        at = latest + dt.timedelta(days=30)
        dedup.write_heartbeat(spark, f"{folder}/log", log.schema, at)
    return spark.read.schema(deduped.schema).parquet(f"{folder}/out")


@cache
def _refreshed(application: str, sf_dir: str) -> Refresh:
    """Marts of a folder in which the days of the last month were wrong and are written again."""
    made, raw = _shared(application, sf_dir, "default"), _raw_folder(application, sf_dir)
    latest = made.inputs.cases.agg(F.max("intake_date")).first()[0]
    last_month = F.col("intake_date") > F.lit(latest - dt.timedelta(days=30))
    right = {
        "cases": made.inputs.cases.filter(last_month),
        "events_log": made.inputs.events_log.filter(last_month),
    }

    def write(parts: dict[str, DataFrame]) -> None:
        for name, table in parts.items():
            tables.write_partitioned(table, f"{raw}/{name}", only_given_days=True)

    some = {name: table.filter("case_id % 3 <> 0") for name, table in right.items()}
    write(some | {"cases": some["cases"].withColumn("tier", F.lit("TIER_1"))})
    state = _fresh_path(made, "marts")
    followed = Refresh(SparkSession.active(), raw, state, case_id="bigint")
    followed.refresh()
    write(right)
    followed.refresh([latest - dt.timedelta(days=n) for n in range(30)])
    return followed


def _after_refresh(mart: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        made = _refreshed(spark.sparkContext.applicationId, str(sf_dir).rstrip("/"))
        return getattr(made, mart)

    return query


# Joins on time.


def _asof_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The position of covered times by the last open minute at or before them."""
    pipeline = _pipeline(spark, sf_dir)
    log = pipeline.inputs.events_log.select("event_id", "event_ts")
    found = timejoin.asof_join(
        log.filter(pipeline.clock.covers(F.col("event_ts"))),
        pipeline.clock.minute_spine().select("minute_ts", "minute_idx"),
        "event_ts",
        "minute_ts",
        pipeline.store.keep,
        how="inner",
        name="asof_minutes",
    )
    later = (F.col("minute_ts") < F.col("event_ts")).cast("bigint")
    return found.select("event_id", (F.col("minute_idx") + later).alias("position"))


def _last_resolved_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each case the case of its tier that was resolved last before its intake."""
    pipeline = _pipeline(spark, sf_dir)
    cases = pipeline.inputs.cases.select("case_id", "tier", "intake_ts")
    resolved = (
        pipeline.inputs.events_log.filter("status = 'RESOLVED'")
        .join(cases.select("case_id", "tier"), "case_id")
        .groupBy("tier", F.col("event_ts").alias("resolved_ts"))
        .agg(F.max("case_id").alias("resolved_case_id"))
    )
    return timejoin.asof_join(
        cases, resolved, "intake_ts", "resolved_ts", pipeline.store.keep, ["tier"],
        name="asof_resolved",
    )


def _waits_in_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts of customer waits in which no shift is on duty."""
    pipeline = _pipeline(spark, sf_dir)
    gaps = staffing.staffing_gaps(pipeline.inputs.staffing).drop("team_tz")
    waits = pipeline.store.keep("wait_intervals", sla.wait_intervals(pipeline.timed_events))
    pairs = timejoin.overlap_join(
        waits, gaps, ("cw_start_ts", "cw_end_ts"), ("gap_start", "gap_end")
    )
    start = micros_since_1970(F.greatest("cw_start_ts", "gap_start"))
    end = micros_since_1970(F.least("cw_end_ts", "gap_end"))
    seconds = F.call_function("div", end - start, F.lit(1_000_000))
    return pairs.withColumn("unstaffed_seconds", seconds)


def _hot_case(log: DataFrame) -> DataFrame:
    """The log with a third of all cases as one case."""
    return log.withColumn("case_id", F.when(F.col("case_id") % 3 != 0, F.col("case_id")).otherwise(0))


def _hot_wait_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    pipeline = _pipeline(spark, sf_dir)
    return sla.wait_minutes(_hot_case(pipeline.timed_events), pipeline.clock)


# Percentiles of periods, totals over segments, figures observed while writing.


def _monthly_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    pipeline = _pipeline(spark, sf_dir)
    days = pipeline.store.keep("day_counts", periods.day_counts(pipeline.case_sla_metrics))
    return periods.period_percentiles(days, "month")


def _sketched_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether percentiles of quarters from sketches per day keep the error they promise."""
    pipeline = _pipeline(spark, sf_dir)
    days = pipeline.store.keep("day_counts", periods.day_counts(pipeline.case_sla_metrics))
    sketches = pipeline.store.keep("day_sketches", periods.day_sketches(pipeline.case_sla_metrics))
    found = periods.sketched_percentiles(sketches, "quarter")
    return periods.sketch_errors(found, days, "quarter")


def _segment_sets(case_sla_metrics: DataFrame) -> DataFrame:
    return marts.sla_by_segment_sets(marts.duration_counts(case_sla_metrics, marts.SEGMENT_KEYS))


@cache
def _observed(application: str, sf_dir: str) -> observed.StagedLog:
    made = _shared(application, sf_dir, "default")
    return observed.stage_log(made.inputs.events_log, _fresh_path(made, "observed"))


def _as_observed(figures: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        seen = _observed(spark.sparkContext.applicationId, str(sf_dir).rstrip("/"))
        return getattr(seen, figures)()

    return query


def _json_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    pipeline = _pipeline(spark, sf_dir)
    path = _fresh_path(pipeline, "event_integrity_json")
    metrics = quality.event_integrity(pipeline.inputs.events_log)
    tables.write_json(metrics, path)
    return spark.read.schema(metrics.schema).json(path)


def _calendar(strictly_after_first: bool) -> Query:
    return lambda spark, sf_dir: calendars.calendar_around(
        spark.read.parquet(f"{sf_dir}/orders.parquet"), "o_orderdate", strictly_after_first
    )


# Rows that the SQL of the analysis passes through on its way.


def _positions(covered_only: bool) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        pipeline = _pipeline(spark, sf_dir)
        log = pipeline.inputs.events_log.select("event_id", "event_ts")
        if covered_only:
            log = log.filter(pipeline.clock.covers(F.col("event_ts")))
        return pipeline.clock.with_positions(log, {"event_ts": "position"}).drop("event_ts")

    return query


def _milestones_with_sla(case_milestones: DataFrame, case_sla_metrics: DataFrame) -> DataFrame:
    measured = case_sla_metrics.filter("resolved_ts IS NOT NULL").select(
        "case_id",
        F.col("first_resolution_business_hours_including_cw").alias("fr_hours_inc_cw"),
        F.col("first_resolution_business_hours_paused_cw").alias("fr_hours_pause_cw"),
    )
    return case_milestones.select(
        "case_id", "tier", "case_type", F.col("reopened_first_ts").isNotNull().alias("is_reopened")
    ).join(measured, "case_id")


def _cases_with_waits(cases: DataFrame, waits: DataFrame) -> DataFrame:
    return cases.select("case_id").join(waits, "case_id", "left")


def _penalties_of_reopened(
    log: DataFrame, case_sla_metrics: DataFrame, stages: DataFrame
) -> DataFrame:
    reopened = case_sla_metrics.join(scenarios.reopened_cases(log), "case_id", "left_semi")
    return scenarios.reopen_penalty(reopened, stages)


def _terminal_cases(case_milestones: DataFrame) -> DataFrame:
    return case_milestones.filter("resolved_ts IS NOT NULL OR cancelled_ts IS NOT NULL").select(
        "case_id", F.coalesce("resolved_ts", "cancelled_ts").alias("terminal_ts")
    )


def _zone_by_tier() -> Column:
    return (
        F.when(F.col("tier") == "TIER_1", "America/Los_Angeles")
        .when(F.col("tier") == "TIER_2", "America/Denver")
        .otherwise("America/New_York")
    )


def _team_time(cases: DataFrame) -> DataFrame:
    return cases.select("case_id", _zone_by_tier().alias("team_tz"), "intake_ts").select(
        "case_id",
        "team_tz",
        to_team_time(F.col("intake_ts"), F.col("team_tz")).alias("intake_local_ts"),
    )


def _read_in_row_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases written as instants and read by the clock of each row's zone."""
    pipeline = _pipeline(spark, sf_dir)
    path = _fresh_path(pipeline, "instants")
    since = micros_since_1970(F.col("intake_ts"))
    written = pipeline.inputs.cases.withColumns(
        {"intake_ts": F.timestamp_micros(since), "team_tz": _zone_by_tier()}
    )
    tables.write_partitioned(written, path)
    schema = schemas.cases_schema(written.schema["case_id"].dataType)
    return tables.read_table(spark, path, schema, "cases", F.col("team_tz")).select(
        "case_id", "team_tz", F.col("intake_ts").alias("intake_local_ts")
    )


# Zones with other hours, and holidays by another rule in one of them.
_ZONE_HOURS = {
    "America/Los_Angeles": WorkingHours(8, 18),
    "America/Denver": WorkingHours(9, 17),
    "America/New_York": WorkingHours(7, 16),
}


def _zoned_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SLA metrics of teams in three zones; the times of the log are taken for those of UTC."""
    pipeline = _pipeline(spark, sf_dir)
    cases = pipeline.inputs.cases.withColumn("team_tz", _zone_by_tier())
    local, log = in_team_time(cases, pipeline.inputs.events_log)
    usual, later = (_calendar(strictly)(spark, sf_dir) for strictly in (False, True))
    days = {zone: later if zone == "America/Denver" else usual for zone in _ZONE_HOURS}
    return zoned_sla_metrics(local, log, days, _ZONE_HOURS, pipeline.store)


def _output_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts that the steps after staging report."""
    pipeline = _pipeline(spark, sf_dir)
    steps = ("sla", "marts", "drivers", "scenarios")
    counts = [reports.STEPS[step](pipeline)["counts"] for step in steps]
    return reduce(DataFrame.unionByName, counts)


def _raw_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.raw_quality(_pipeline(spark, sf_dir))["counts"]


# The operators on training text, if their subpackage and the pipeline are there.


def _optional(module: str):
    package = module.rpartition(".")[0]
    present = (not package or find_spec(package)) and find_spec(module)
    return importlib.import_module(module) if present else None


def _with_package(query: Query) -> Query:
    """The query, with this folder on the path of the Python workers."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.sparkContext.environment.setdefault("PYTHONPATH", HERE)
        return query(spark, sf_dir)

    return run


def _corpus_pipeline():
    """``corpus_pipeline.py``, which imports the subpackage, if both are there."""
    return _optional("corpus_pipeline") if find_spec("waitline.llm") else None


def _text_queries() -> dict[str, Query]:
    found = {}
    if registered := _optional("waitline.llm.queries"):
        found |= registered.queries()
    if corpus := _corpus_pipeline():
        found["pipeline"] = corpus.run
    return {name: _with_package(query) for name, query in found.items()}


def _text_sql() -> dict[str, str]:
    found = {}
    if registered := _optional("waitline.llm.sql"):
        found |= registered.oracle_sql()
    corpus = _corpus_pipeline()
    if corpus and corpus.ORACLE_SQL:
        found["pipeline"] = corpus.ORACLE_SQL
    return found


def queries() -> dict[str, Query]:
    return _service_queries() | _text_queries()


def _service_queries() -> dict[str, Query]:
    return {
        # Sources and sinks
        "s1_scan_staffing": _scan_staffing,
        "s2_scan_partitioned_cases": _scan_partitioned_cases,
        "s3_write_partitioned_events": _write_partitioned_events,
        "s4_replace_days": _replace_days,
        **{
            f"s4_refreshed_{mart}": _after_refresh(mart)
            for mart in ("sla_daily", "sla_by_tier_case_type", "backlog_daily_proxy")
        },
        "s5_saved_table": _saved_table,
        "s6_csv_export": _csv_export,
        **{f"s6_csv_{report}": _csv(report) for report in REPORT_ORDER},
        **{
            f"s5_published_{table}": _from_catalog(table)
            for table in ("events_clean", "case_sla_metrics", "scenario_results")
        },
        "s7_json_metrics": _json_metrics,
        "s8_calendar": _calendar(strictly_after_first=False),
        "s8_calendar_after_first": _calendar(strictly_after_first=True),
        "s9_staffing_schedule": _on(lambda staffing: staffing, "raw.staffing"),
        # Projections and filters
        "p1_canonical_time": _on(
            lambda timed: timed.select("event_id", "event_ts_canonical"), "timed_events"
        ),
        "p2_events_clean": _table("events_clean"),
        "p3_milestone_flags": _on(
            lambda m: m.select(
                "case_id",
                "is_triage_missing",
                "is_terminal_missing",
                "is_triage_before_intake_after_fix",
            ),
            "case_milestones",
        ),
        "p4_sla_flags": _on(
            lambda m: m.select(
                "case_id",
                "is_triage_missing_for_sla",
                "is_terminal_missing_for_sla",
                "is_triage_before_intake_for_sla",
            ),
            "case_sla_metrics",
            variant="left",
        ),
        "p5_terminal_cases": _on(_terminal_cases, "case_milestones"),
        "p6_business_days": _on(
            lambda calendar: calendar.filter("NOT is_weekend AND NOT is_holiday").select("cal_date"),
            "raw.calendar",
        ),
        # Joins
        "j1_milestones_with_sla": _on(_milestones_with_sla, "case_milestones", "case_sla_metrics"),
        "j2_cases_with_wait_minutes": _on(_cases_with_waits, "raw.cases", "wait_minutes"),
        "j3_reopened_with_tier_penalty": _on(
            _penalties_of_reopened, "raw.events_log", "case_sla_metrics", "case_stage_durations"
        ),
        "j5_business_position": _positions(covered_only=False),
        "j5_business_position_inner": _positions(covered_only=True),
        "j5_business_minutes_dim": _on(lambda clock: clock.minute_spine(), "clock"),
        "j5_asof_position": _asof_position,
        "j5_asof_last_resolved": _last_resolved_before,
        "j6_waits_in_staffing_gaps": _waits_in_gaps,
        # Windows
        "w1_events_dedup": _table("events_deduped"),
        "w1_events_dedup_stream": _streamed_dedup,
        "w2_congestion_deciles": _on(
            lambda d: d.select("case_id", "avg_congestion_flow_index", "congestion_decile"),
            "case_deciles",
        ),
        "w5_wait_intervals": _on(sla.wait_intervals, "timed_events"),
        "w5_wait_intervals_hot_case": _on(
            lambda timed: sla.wait_intervals(_hot_case(timed)), "timed_events"
        ),
        # Case tables
        "a2_case_milestones": _table("case_milestones"),
        "a3_sla_inputs": _on(milestones.sla_inputs, "repaired"),
        "a5_wait_minutes": _table("wait_minutes"),
        "a5_wait_minutes_left": _table("wait_minutes", variant="left"),
        "a5_wait_minutes_hot_case": _hot_wait_minutes,
        "a7_case_sla_metrics": _table("case_sla_metrics"),
        "a7_case_sla_metrics_left": _table("case_sla_metrics", variant="left"),
        "a7_case_sla_metrics_zoned": _zoned_metrics,
        "a8_case_stage_durations": _table("case_stage_durations"),
        "a8_case_stage_durations_all": _table("case_stage_durations", variant="all"),
        "a9_reopened_cases": _on(scenarios.reopened_cases, "raw.events_log"),
        "a10_reopen_penalty": _table("reopen_penalty"),
        "a10_reopen_penalty_all": _table("reopen_penalty", variant="all"),
        "a7_case_sla_metrics_short": _table("case_sla_metrics", variant="short"),
        "a11_congestion_exposure": _table("case_congestion_exposure"),
        "a11_congestion_exposure_short": _table("case_congestion_exposure", variant="short"),
        # Marts
        "m1_sla_daily": _table("sla_daily"),
        "m1_sla_daily_left": _table("sla_daily", variant="left"),
        "m2_sla_by_tier_case_type": _table("sla_by_tier_case_type"),
        "m2_sla_by_segment_sets": _on(_segment_sets, "case_sla_metrics"),
        "g6_monthly_percentiles": _monthly_percentiles,
        "g6_sketched_percentiles": _sketched_percentiles,
        "m3_staffing_daily": _table("staffing_daily"),
        "m4_backlog_daily_proxy": _table("backlog_daily_proxy"),
        "m5_congestion_daily": _table("congestion_daily"),
        "m6_congestion_daily_v2": _table("congestion_daily_v2"),
        "m7_driver_congestion_buckets": _table("driver_congestion_buckets"),
        "m8_driver_reopen_impact": _table("driver_reopen_impact"),
        "m9_driver_stage_durations": _table("driver_stage_durations"),
        "m9_driver_stage_durations_all": _table("driver_stage_durations", variant="all"),
        "m10_driver_summary": _table("driver_summary"),
        "m11_scenario_results": _table("scenario_results"),
        "m11_scenario_results_all": _table("scenario_results", variant="all"),
        # Scalar functions
        "f12_team_time": _on(_team_time, "raw.cases"),
        "f12_read_in_row_zone": _read_in_row_zone,
        # Quality and headline figures
        "q1_row_counts": _raw_counts,
        "q2_intake_coverage": _on(quality.intake_coverage, "raw.cases"),
        "q3_events_per_case": _on(quality.events_per_case, "case_profile"),
        "q4_event_integrity": _on(quality.event_integrity, "raw.events_log"),
        "q4_event_integrity_unrounded": _on(
            quality.event_integrity, "raw.events_log", digits=None
        ),
        "q5_duplicate_groups": _on(quality.duplicate_groups, "raw.events_log"),
        "q6_ingestion_before_event": _on(quality.ingestion_before_event, "raw.events_log"),
        "q7_status_coverage": _on(quality.status_coverage, "case_profile"),
        "q8_triage_before_intake": _on(quality.triage_before_intake, "case_profile"),
        "q9_triage_before_intake_canonical": _on(
            quality.triage_before_intake, "case_profile", time="event_ts_canonical"
        ),
        "q10_cancelled_and_resolved": _on(quality.cancelled_and_resolved, "case_profile"),
        "q11_triage_before_intake_after_repair": _on(
            quality.triage_before_intake_after_repair, "case_milestones"
        ),
        "q12_clean_event_anomalies": _on(quality.clean_event_anomalies, "events_clean"),
        "q13_dedup_reconciliation": _on(
            quality.dedup_reconciliation, "raw.events_log", "events_deduped"
        ),
        "q4_event_integrity_observed": _as_observed("event_integrity"),
        "q6_ingestion_before_event_observed": _as_observed("ingestion_before_event"),
        "q12_clean_event_anomalies_observed": _as_observed("clean_event_anomalies"),
        "q13_dedup_reconciliation_observed": _as_observed("dedup_reconciliation"),
        "q14_breach_rates": _on(quality.breach_rates, "case_sla_metrics"),
        "q15_sla_triage_before_intake": _on(quality.sla_triage_before_intake, "case_sla_metrics"),
        "q16_sla_percentiles": _on(marts.sla_percentiles, "case_sla_metrics"),
        "q17_daily_breach_means": _on(quality.daily_breach_means, "sla_daily"),
        "q18_congestion_summary": _on(quality.congestion_summary, "congestion_daily"),
        "q19_bottleneck_stage": _table("bottleneck_stage"),
        "q20_scenario_headline": _on(scenarios.scenario_headline, "scenario_results"),
        "q21_output_row_counts": _output_counts,
    }


def oracle_sql() -> dict[str, str]:
    """The SQL that DuckDB runs on the same Parquet tables, for each query that has any."""
    return oracles.oracle_sql() | _text_sql()


def entry(spark: SparkSession) -> DataFrame:
    """Breach rates and percentiles by tier and case type, from the orders of sf0.001."""
    return queries()["m2_sla_by_tier_case_type"](spark, "/root/testdata/sf0.001")
