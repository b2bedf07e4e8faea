from __future__ import annotations

import datetime as dt

import pytest
from helpers import cases_table, events_table, ts
from pyspark.sql import functions as F

import fixture
from waitline import schemas
from waitline.plans import reports
from waitline.plans.pipeline import REPORT_ORDER, Inputs, Pipeline
from waitline.plans.store import Store, shared_folder
from waitline.settings import Settings, Staffing, WorkingHours
from waitline.sources import calendar, staffing, tables

START = dt.date(2025, 7, 1)


@pytest.mark.parametrize("after_first, labor_day", [(False, 1), (True, 8)])
def test_calendar_of_half_a_year(spark, after_first, labor_day):
    rows = calendar.calendar(spark, START, 180, after_first).collect()
    assert len(rows) == 180
    assert {r.holiday_name: (r.cal_date.month, r.cal_date.day) for r in rows if r.is_holiday} == {
        "Independence Day": (7, 4),
        "Labor Day": (9, labor_day),
        "Thanksgiving": (11, 27),
        "Christmas Day": (12, 25),
    }
    assert sum(not r.is_weekend and not r.is_holiday for r in rows) == 125
    assert all(r.dow == r.cal_date.weekday() for r in rows)


def test_staffing_rounds_half_to_even_and_runs_down(spark):
    rows = staffing.staffing_schedule(calendar.calendar(spark, START, 180)).collect()
    by_day = {(r.shift_date, r.shift_name): r for r in rows}
    friday = by_day[dt.date(2025, 7, 11), "SWING"]
    assert friday.planned_agents == 10  # 10.5
    assert by_day[dt.date(2025, 7, 11), "DAY"].planned_agents == 20  # 19.5
    last = START + dt.timedelta(days=179)
    days_left = 59
    edge = by_day[last - dt.timedelta(days=days_left), "DAY"].deterioration_multiplier
    assert edge == 1.0 - (1.0 - days_left / 60) * (1.0 - 0.85)
    assert by_day[last - dt.timedelta(days=60), "DAY"].deterioration_multiplier == 1.0
    assert by_day[last, "DAY"].deterioration_multiplier == pytest.approx(0.85)
    for r in rows:
        assert r.effective_agents == round(
            r.planned_agents * (1.0 - 0.22) * r.deterioration_multiplier
        )


def test_three_shifts_share_the_agents(spark):
    plan = Staffing(
        planned_agents=(40,) * 7,
        shifts=(("A", 6, 12, 0.25), ("B", 12, 18, 0.25), ("C", 18, 22, 0.5)),
        deterioration_days=0,
    )
    rows = staffing.staffing_schedule(calendar.calendar(spark, START, 3), plan).collect()
    assert sorted((r.shift_name, r.planned_agents) for r in rows) == sorted(
        [("A", 10), ("B", 10), ("C", 20)] * 3
    )
    assert {r.deterioration_multiplier for r in rows} == {1.0}
    with pytest.raises(ValueError, match="sum to 0.9"):
        Staffing(shifts=(("A", 6, 12, 0.4), ("B", 12, 18, 0.5)))


def test_settings_and_inputs_do_not_meet_in_a_store(spark):
    """One store, other settings and other orders: each gets its own tables."""
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    store = Store(spark)
    usual = Pipeline(fixture.inputs_from_orders(orders, store), store)
    short = Settings(exposure_days=2, hours=WorkingHours(9, 12))
    changed = Pipeline(usual.inputs, store, short)
    alone = Pipeline(fixture.inputs_from_orders(orders, Store(spark)), Store(spark), short)

    def sums(pipeline):
        return [
            pipeline.case_congestion_exposure.agg({"biz_days_in_window": "sum"}).first()[0],
            pipeline.case_sla_metrics.agg(
                {"first_resolution_business_minutes_including_cw": "sum"}
            ).first()[0],
        ]

    assert sums(usual) != sums(changed) == sums(alone)
    half = fixture.inputs_from_orders(orders.filter("o_orderkey % 2 = 0"), store)
    assert half.cases.count() < usual.inputs.cases.count()


def test_schema_check_names_what_is_wrong(spark):
    df = spark.createDataFrame([("x",)], "cal_date string")
    with pytest.raises(ValueError, match="cal_date: expected date, found string.*dow"):
        schemas.require(df, schemas.CALENDAR, "calendar_dim")


def test_partitioned_write_replaces_and_keeps_other_days(spark, tmp_path):
    path = str(tmp_path / "cases")
    days = [ts(f"2025-07-0{d} 09:00:00") for d in (1, 2, 3)]
    cases = cases_table(spark, [(f"c{i}", days[i % 3]) for i in range(30)])
    tables.write_partitioned(cases, path)
    tables.write_partitioned(cases, path)  # a rerun counts nothing twice
    back = tables.read_table(spark, path, schemas.cases_schema(), "cases")
    assert sorted(back.collect()) == sorted(cases.collect())
    one_day = cases.filter(F.col("intake_date") == days[1].date()).limit(4)
    tables.write_partitioned(one_day, path, only_given_days=True)
    sizes = tables.read_table(spark, path, schemas.cases_schema(), "cases")
    counts = {r[0].day: r[1] for r in sizes.groupBy("intake_date").count().collect()}
    assert counts == {1: 10, 2: 4, 3: 10}


def test_json_keeps_null_fields(spark, tmp_path):
    df = spark.createDataFrame([(None, 1.5)], "a double, b double")
    tables.write_json(df, str(tmp_path / "m"))
    text = "".join(p.read_text() for p in (tmp_path / "m").glob("*.json"))
    assert text.strip() == '{"a":null,"b":1.5}'


def test_store_writes_a_name_once(spark):
    store = Store(spark)
    first = store.keep("t", spark.range(3))
    assert store.keep("t", spark.range(3)) is first and first.count() == 3
    assert store.keep("t", spark.range(9)).count() == 9  # another plan, another table
    store.clear()
    assert store.keep("t", spark.range(3)) is not first
    assert store.folder.startswith(shared_folder(spark).rstrip("/"))


@pytest.mark.parametrize("by_day", [False, True])
def test_store_sees_that_files_were_written_again(spark, tmp_path, by_day):
    """A count over a folder is made anew when the folder, or one day of it, is."""
    store, folder = Store(spark), f"file://{tmp_path}/a b%"
    days = "date_add(date'2025-07-01', CAST(id % 5 AS INT)) AS intake_date"

    def count():
        counted = spark.read.schema("id long, intake_date date").parquet(folder).groupBy()
        return store.keep("count", counted.count()).first()[0]

    rows = spark.range(10).selectExpr("id", days)
    tables.write_partitioned(rows, folder)
    assert count() == count() == 10
    if by_day:
        more = spark.range(25).selectExpr("id", days).filter("intake_date = date'2025-07-02'")
        tables.write_partitioned(more, folder, only_given_days=True)
        assert count() == count() == 13
    else:
        tables.write_partitioned(spark.range(25).selectExpr("id", days), folder)
        assert count() == count() == 25


def test_store_sees_a_file_of_the_same_name(spark, tmp_path):
    store, file = Store(spark), tmp_path / "one.csv"
    for lines in (3, 7):
        file.write_text("x\n" * lines)
        df = spark.read.schema("x string").csv(f"file://{file}").groupBy().count()
        assert store.keep("lines", df).first()[0] == lines


def test_pipeline_from_partitioned_parquet_with_text_ids(spark, tmp_path):
    """The whole way from files, as a user of the library takes it."""
    flow_of_case = ("TRIAGE", "ASSIGNMENT", "INVESTIGATION", "CUSTOMER_WAIT", "REVIEW_QA")
    cases, log = [], []
    for n in range(20):
        start = ts("2025-07-07 09:00:00") + dt.timedelta(hours=n)
        case = f"C{n:09d}"
        cases.append((case, start, f"TIER_{n % 3 + 1}"))
        log.append((case, "INTAKE", start))
        log += [
            (case, s, start + dt.timedelta(minutes=40 * (i + 1)))
            for i, s in enumerate(flow_of_case)
        ]
        log.append((case, "RESOLVED", start + dt.timedelta(days=1 + n % 4)))
        if n % 5 == 0:
            log.append((case, "REOPENED", start + dt.timedelta(days=6)))
    folder = str(tmp_path)
    days = calendar.calendar(spark, START, 60)
    tables.write_partitioned(cases_table(spark, cases), f"{folder}/cases")
    tables.write_partitioned(events_table(spark, log), f"{folder}/events_log")
    days.write.parquet(f"{folder}/calendar_dim")
    staffing.staffing_schedule(days).write.parquet(f"{folder}/staffing_schedule")

    pipeline = Pipeline(Inputs.from_parquet(spark, folder), Store(spark))
    sla = pipeline.case_sla_metrics.collect()
    assert len(sla) == 20
    for r in sla:
        paused = r.first_resolution_business_minutes_paused_cw
        assert paused <= r.first_resolution_business_minutes_including_cw
    names = pipeline.export(str(tmp_path / "export"))
    assert len(names) == 8
    for name in names:
        back = spark.read.option("header", True).csv(f"{tmp_path}/export/{name}")
        assert back.count() == getattr(pipeline, name).count() > 0
        # In the order of the files the rows are those of the table in its order.
        files = sorted((tmp_path / "export" / name).glob("part-*.csv"))
        lines = [line for file in files for line in file.read_text().splitlines()[1:]]
        ordered = getattr(pipeline, name).orderBy(*REPORT_ORDER[name])
        tables.write_csv(ordered.coalesce(1), f"{tmp_path}/ordered/{name}")
        (file,) = (tmp_path / "ordered" / name).glob("part-*.csv")
        assert lines == file.read_text().splitlines()[1:]
        keys = [tuple(r[c] for c in REPORT_ORDER[name]) for r in ordered.collect()]
        assert keys == sorted(keys)

    one, two, both = pipeline.scenario_results.orderBy("scenario_name").collect()
    assert both.total_hours_saved == pytest.approx(one.total_hours_saved + two.total_hours_saved)
    assert two.eligible_cases == 4 and two.baseline_breaches_inc is None
    assert both.breaches_avoided_inc == one.breaches_avoided_inc
    assert pipeline.bottleneck_stage.first().stage == "reviewqa_to_resolved"

    figures = str(tmp_path / "figures")
    written = reports.write_figures(pipeline, figures)
    assert len(written) == len(set(written)) == 24
    rates = spark.read.json(f"{figures}/sla/breach_rates").first()
    assert rates.sla_b_breach_pct == 0.0


def test_files_with_instants_are_read_in_the_team_zone(spark, tmp_path):
    path = str(tmp_path / "cases")
    instant = spark.sql("""SELECT 'a' AS case_id, TIMESTAMP '2025-07-01 16:30:00+00:00' AS intake_ts,
        'x' AS case_type, 'TIER_1' AS tier, 'America/Los_Angeles' AS team_tz,
        DATE '2025-07-01' AS intake_date""")
    tables.write_partitioned(instant, path)
    schema = schemas.cases_schema()
    with pytest.raises(ValueError, match="intake_ts: expected timestamp_ntz, found timestamp"):
        tables.read_table(spark, path, schema, "cases")
    for zone in ("America/Los_Angeles", F.col("team_tz")):
        local = tables.read_table(spark, path, schema, "cases", zone)
        assert local.first().intake_ts == ts("2025-07-01 09:30:00")


def test_instants_around_a_change_of_clocks(spark, tmp_path):
    """The hour that New York repeats, read in three zones, whatever the session's zone is."""
    path = str(tmp_path / "events")
    zones = ["America/New_York", "UTC", "America/Los_Angeles"]
    rows = [(f"e{n}{z}", f"2025-11-02 0{5 + n}:30:00.000001+00:00", zones[z])
            for n in range(2) for z in range(3)]
    made = spark.createDataFrame(rows, "event_id string, at string, event_tz string").selectExpr(
        "event_id", "'c' case_id", "'INTAKE' status", "CAST(at AS TIMESTAMP) event_ts",
        "CAST(at AS TIMESTAMP) ingestion_ts", "event_tz", "false is_duplicate",
        "false is_late_arriving", "DATE '2025-11-02' intake_date",
    )
    made.write.parquet(path)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        read = tables.read_table(
            spark, path, schemas.events_schema(), "events_log", F.col("event_tz")
        )
        found = {r.event_id: r.event_ts for r in read.collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    hours = {"e00": 1, "e10": 1, "e01": 5, "e11": 6}
    for event, hour in hours.items():
        assert found[event] == ts(f"2025-11-02 0{hour}:30:00.000001")
    assert found["e02"] == ts("2025-11-01 22:30:00.000001")


def test_whole_numbers_of_another_width_are_cast(spark):
    wide = spark.sql("SELECT DATE '2025-07-01' AS cal_date, 1L AS dow, false AS is_weekend, "
                     "false AS is_holiday, CAST(NULL AS STRING) AS holiday_name")  # fmt: skip
    kinds = [(f.name, f.dataType) for f in schemas.require(wide, schemas.CALENDAR, "t").schema]
    assert kinds == [(f.name, f.dataType) for f in schemas.CALENDAR]
