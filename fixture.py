"""Cases and events derived from an orders table, for checks and benchmarks.

One case per order. The statuses a case passes and their times follow from its
number by fixed arithmetic, with missing times, shifted times and retries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitline.plans.pipeline import Inputs
from waitline.plans.store import Store
from waitline.settings import Settings
from waitline.sources import calendar as calendars
from waitline.sources import staffing

# Number, status, earliest minute after intake, spread in minutes.
STATUS_PLAN = (
    (1, "INTAKE", 0, 1),
    (2, "TRIAGE", 5, 150),
    (3, "ASSIGNMENT", 160, 60),
    (4, "INVESTIGATION", 230, 60),
    (5, "CUSTOMER_WAIT", 300, 900),
    (6, "REVIEW_QA", 700, 2500),
    (7, "RESOLVED", 3300, 200),
    (8, "REOPENED", 5000, 6000),
    (9, "ESCALATED", 240, 200),
    (10, "CANCELLED", 200, 100),
    # Three more events around the intake, and a resolution after many business days.
    (11, "TRIAGE", -500, 60),
    (12, "TRIAGE", -300, 60),
    (13, "TRIAGE", 400, 90),
    (14, "RESOLVED", -400, 60),
    (15, "RESOLVED", -200, 60),
    (16, "RESOLVED", 4000, 100),
    (17, "RESOLVED", 40000, 500),
)

# Which cases pass a status, as a condition on the case number.
PASSES = {
    1: "true",
    2: "case_id % 163 <> 0",
    3: "case_id % 83 <> 0",
    4: "case_id % 83 <> 0",
    5: "case_id % 83 <> 0 AND case_id % 100 < 28",
    6: "case_id % 83 <> 0",
    7: "case_id % 83 <> 0 AND case_id % 167 <> 0 AND case_id % 43 <> 0",
    8: "case_id % 83 <> 0 AND case_id % 21 = 0",
    9: "case_id % 83 <> 0 AND case_id % 29 = 0",
    10: "case_id % 83 = 0",
    11: "case_id % 37 = 0",
    12: "case_id % 37 = 0",
    13: "case_id % 37 = 0",
    14: "case_id % 83 <> 0 AND case_id % 41 = 0",
    15: "case_id % 83 <> 0 AND case_id % 41 = 0",
    16: "case_id % 83 <> 0 AND case_id % 41 = 0",
    17: "case_id % 83 <> 0 AND case_id % 43 = 0",
}


def inputs_from_orders(
    orders: DataFrame, store: Store, settings: Settings | None = None
) -> Inputs:
    """The four tables, stored: cases and events from orders, the calendar from their dates."""
    settings = settings or Settings()
    cases = store.keep("cases", cases_from_orders(orders.hint("rebalance")))
    calendar = store.keep("calendar_dim", calendars.calendar_around(cases, "intake_date"))
    schedule = staffing.staffing_schedule(calendar, settings.staffing)
    return Inputs(
        cases=cases,
        events_log=store.keep("events_log", events_from_cases(cases)),
        calendar=calendar,
        staffing=store.keep("staffing_schedule", schedule),
    )


def cases_from_orders(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("case_id"),
        F.expr(
            "o_orderdate + INTERVAL '1' HOUR * 8"
            " + INTERVAL '1' MINUTE * CAST((o_orderkey * 37 + o_custkey) % 600 AS INT)"
            " + INTERVAL '1' SECOND * CAST(o_custkey % 60 AS INT)"
        ).alias("intake_ts"),
        F.when(F.col("o_orderstatus") == "F", "VENDOR_ASSESSMENT")
        .when(F.col("o_orderstatus") == "O", "ACCESS_REVIEW")
        .otherwise("POLICY_EXCEPTION")
        .alias("case_type"),
        F.when(F.col("o_orderkey") * 13 % 100 < 55, "TIER_1")
        .when(F.col("o_orderkey") * 13 % 100 < 90, "TIER_2")
        .otherwise("TIER_3")
        .alias("tier"),
        F.lit("UTC").alias("team_tz"),
        F.col("o_orderdate").cast("date").alias("intake_date"),
    )


def events_from_cases(cases: DataFrame) -> DataFrame:
    """The events of every case; each row makes its own, nothing is joined or shuffled."""
    steps = F.array_compact(
        F.array(
            *[
                F.when(
                    F.expr(PASSES[seq]),
                    F.struct(
                        F.lit(seq).alias("seq"),
                        F.lit(status).alias("status"),
                        F.lit(base).alias("base"),
                        F.lit(spread).alias("spread"),
                    ),
                )
                for seq, status, base, spread in STATUS_PLAN
            ]
        )
    )
    base = (
        cases.select("case_id", "intake_ts", "intake_date", F.explode(steps).alias("step"))
        .select("case_id", "intake_ts", "intake_date", "step.*")
        .select(
            "case_id",
            "intake_date",
            "seq",
            "status",
            (F.col("case_id") * 100 + F.col("seq")).alias("k"),
            F.expr(
                "intake_ts + INTERVAL '1' MINUTE * CAST(base + (case_id * (seq * 7 + 3)) % spread"
                " - CASE WHEN (case_id * 10 + seq) % 33 = 0 THEN 420 ELSE 0 END AS INT)"
            ).alias("ts0"),
        )
    )
    copies = F.when(
        F.expr("(case_id * 11 + seq) % 50 = 0"), F.array(F.lit(False), F.lit(True))
    ).otherwise(F.array(F.lit(False)))
    return base.withColumn("retry", F.explode(copies)).select(
        F.concat(F.col("k").cast("string"), F.when(F.col("retry"), "_dup").otherwise("")).alias(
            "event_id"
        ),
        "case_id",
        "status",
        F.expr("CASE WHEN (case_id * 7 + seq) % 55 = 0 THEN NULL ELSE ts0 END").alias("event_ts"),
        F.expr(
            "ts0 + INTERVAL '1' MINUTE * CAST(k % 30 + IF(retry, 1 + k % 29, 0) AS INT)"
        ).alias("ingestion_ts"),
        F.when(F.expr("(case_id * 10 + seq) % 33 = 0"), "INCONSISTENT")
        .otherwise("UTC")
        .alias("event_tz"),
        F.col("retry").alias("is_duplicate"),
        F.expr("(case_id * 3 + seq) % 67 = 0").alias("is_late_arriving"),
        "intake_date",
    )
