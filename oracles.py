"""What every registered query should return, as SQL for DuckDB on the given tables.

The SQL takes the long way round on purpose: a real table of open minutes that is counted,
range joins for waits and exposure, and window functions over whole tables.
"""

from __future__ import annotations

import re

# Every entry may refer to the ones before it.
TABLES = {
    "cases": """
        SELECT o_orderkey AS case_id,
               o_orderdate + INTERVAL 8 HOUR
                 + to_minutes((o_orderkey * 37 + o_custkey) % 600)
                 + to_seconds(o_custkey % 60) AS intake_ts,
               CASE o_orderstatus WHEN 'F' THEN 'VENDOR_ASSESSMENT'
                                  WHEN 'O' THEN 'ACCESS_REVIEW'
                                  ELSE 'POLICY_EXCEPTION' END AS case_type,
               CASE WHEN o_orderkey * 13 % 100 < 55 THEN 'TIER_1'
                    WHEN o_orderkey * 13 % 100 < 90 THEN 'TIER_2'
                    ELSE 'TIER_3' END AS tier,
               'UTC' AS team_tz,
               CAST(o_orderdate AS DATE) AS intake_date
        FROM orders""",
    "steps": """
        SELECT c.case_id, c.intake_date, s.seq, s.status, c.case_id * 100 + s.seq AS k,
               c.intake_ts + to_minutes(s.base + (c.case_id * (s.seq * 7 + 3)) % s.spread
                 - IF((c.case_id * 10 + s.seq) % 33 = 0, 420, 0)) AS ts0
        FROM cases c, (VALUES
            (1, 'INTAKE', 0, 1), (2, 'TRIAGE', 5, 150), (3, 'ASSIGNMENT', 160, 60),
            (4, 'INVESTIGATION', 230, 60), (5, 'CUSTOMER_WAIT', 300, 900),
            (6, 'REVIEW_QA', 700, 2500), (7, 'RESOLVED', 3300, 200),
            (8, 'REOPENED', 5000, 6000), (9, 'ESCALATED', 240, 200),
            (10, 'CANCELLED', 200, 100), (11, 'TRIAGE', -500, 60), (12, 'TRIAGE', -300, 60),
            (13, 'TRIAGE', 400, 90), (14, 'RESOLVED', -400, 60), (15, 'RESOLVED', -200, 60),
            (16, 'RESOLVED', 4000, 100), (17, 'RESOLVED', 40000, 500))
            AS s(seq, status, base, spread)
        WHERE CASE WHEN s.seq = 1 THEN true
                   WHEN s.seq = 2 THEN c.case_id % 163 <> 0
                   WHEN s.seq = 10 THEN c.case_id % 83 = 0
                   WHEN s.seq IN (11, 12, 13) THEN c.case_id % 37 = 0
                   WHEN c.case_id % 83 = 0 THEN false
                   WHEN s.seq = 5 THEN c.case_id % 100 < 28
                   WHEN s.seq = 7 THEN c.case_id % 167 <> 0 AND c.case_id % 43 <> 0
                   WHEN s.seq IN (14, 15, 16) THEN c.case_id % 41 = 0
                   WHEN s.seq = 17 THEN c.case_id % 43 = 0
                   WHEN s.seq = 8 THEN c.case_id % 21 = 0
                   WHEN s.seq = 9 THEN c.case_id % 29 = 0
                   ELSE true END""",
    "events_log": """
        SELECT CAST(k AS VARCHAR) || IF(retry, '_dup', '') AS event_id, case_id, status,
               IF((case_id * 7 + seq) % 55 = 0, NULL, ts0) AS event_ts,
               ts0 + to_minutes(k % 30 + IF(retry, 1 + k % 29, 0)) AS ingestion_ts,
               IF((case_id * 10 + seq) % 33 = 0, 'INCONSISTENT', 'UTC') AS event_tz,
               retry AS is_duplicate, (case_id * 3 + seq) % 67 = 0 AS is_late_arriving,
               intake_date
        FROM steps, (VALUES (false), (true)) AS r(retry)
        WHERE NOT retry OR (case_id * 11 + seq) % 50 = 0""",
    "all_days": """
        SELECT CAST(unnest(generate_series(
                 date_trunc('year', min(o_orderdate)),
                 date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY,
                 INTERVAL 1 DAY)) AS DATE) AS cal_date
        FROM orders""",
    "numbered_days": """
        SELECT cal_date, isodow(cal_date) - 1 AS dow, month(cal_date) AS m, day(cal_date) AS d,
               row_number() OVER (PARTITION BY year(cal_date), month(cal_date), isodow(cal_date)
                                  ORDER BY cal_date) AS nth,
               row_number() OVER (PARTITION BY year(cal_date), month(cal_date), isodow(cal_date),
                                  day(cal_date) = 1 ORDER BY cal_date) AS nth_after_first
        FROM all_days""",
    "calendar_dim": """
        SELECT cal_date, CAST(dow AS SMALLINT) AS dow, dow >= 5 AS is_weekend,
               holiday_name IS NOT NULL AS is_holiday, holiday_name
        FROM (SELECT *, CASE WHEN m = 7 AND d = 4 THEN 'Independence Day'
                             WHEN m = 12 AND d = 25 THEN 'Christmas Day'
                             WHEN m = 9 AND dow = 0 AND nth = 1 THEN 'Labor Day'
                             WHEN m = 11 AND dow = 3 AND nth = 4 THEN 'Thanksgiving'
                        END AS holiday_name FROM numbered_days)""",
    "business_days": """
        SELECT cal_date FROM calendar_dim WHERE dow < 5 AND holiday_name IS NULL""",
    "staffing_schedule": """
        SELECT *, CAST(round_even(planned_agents * (1.0::DOUBLE - 0.22::DOUBLE)
                                  * deterioration_multiplier, 0) AS INTEGER) AS effective_agents
        FROM (SELECT cal_date AS shift_date, 'UTC' AS team_tz, shift_name,
                     shift_start_hour, shift_end_hour,
                     CAST(round_even([38, 36, 34, 34, 30, 6, 4][dow + 1] * share, 0) AS INTEGER)
                       AS planned_agents,
                     0.22::DOUBLE AS shrinkage_rate,
                     IF(days_left >= 60, 1.0::DOUBLE,
                        1.0::DOUBLE - (1.0::DOUBLE - days_left / 60.0::DOUBLE)
                                      * (1.0::DOUBLE - 0.85::DOUBLE)) AS deterioration_multiplier
              FROM (SELECT *, max(cal_date) OVER () - cal_date AS days_left FROM calendar_dim),
                   (VALUES ('DAY', 8, 16, 0.65::DOUBLE),
                           ('SWING', 10, 18, 1.0::DOUBLE - 0.65::DOUBLE))
                     AS s(shift_name, shift_start_hour, shift_end_hour, share))""",
    "events_deduped": """
        SELECT event_id, case_id, status, event_ts, ingestion_ts,
               ifnull(event_ts, ingestion_ts) AS event_ts_canonical,
               event_tz, is_duplicate, is_late_arriving, intake_date
        FROM events_log
        QUALIFY 1 = row_number() OVER (
            PARTITION BY case_id, status, ifnull(event_ts, ingestion_ts)
            ORDER BY event_ts IS NULL, ingestion_ts, event_id)""",
    "events_clean": """
        SELECT event_id, case_id, status, event_ts, ingestion_ts, event_ts_canonical, event_tz,
               event_tz = 'INCONSISTENT' AS is_tz_inconsistent, is_duplicate, is_late_arriving,
               ifnull(ingestion_ts < event_ts, false) AS is_ingestion_before_event_ts,
               event_ts IS NULL AS is_event_ts_missing, intake_date
        FROM events_deduped""",
    "marks": """
        SELECT case_id, status, event_ts_canonical AS ts FROM events_clean""",
    "repaired": """
        SELECT c.*,
               min(ts) FILTER (status = 'TRIAGE') AS triage_any,
               ifnull(min(ts) FILTER (status = 'TRIAGE' AND ts >= intake_ts), triage_any)
                 AS triage_fixed,
               min(ts) FILTER (status = 'ASSIGNMENT') AS assignment_ts,
               min(ts) FILTER (status = 'INVESTIGATION') AS investigation_ts,
               min(ts) FILTER (status = 'CUSTOMER_WAIT') AS customer_wait_first_ts,
               min(ts) FILTER (status = 'REVIEW_QA') AS review_qa_ts,
               min(ts) FILTER (status = 'RESOLVED') AS resolved_any,
               ifnull(min(ts) FILTER (status = 'RESOLVED' AND ts >= intake_ts), resolved_any)
                 AS resolved_fixed,
               min(ts) FILTER (status = 'CANCELLED') AS cancelled_ts,
               min(ts) FILTER (status = 'REOPENED') AS reopened_first_ts,
               min(ts) FILTER (status = 'ESCALATED') AS escalated_first_ts
        FROM cases c LEFT JOIN marks USING (case_id)
        GROUP BY ALL""",
    "case_milestones": """
        SELECT case_id, intake_ts, case_type, tier, team_tz, intake_date,
               triage_fixed AS triage_ts, assignment_ts, investigation_ts,
               customer_wait_first_ts, review_qa_ts, resolved_any AS resolved_ts, cancelled_ts,
               reopened_first_ts, escalated_first_ts, triage_any IS NULL AS is_triage_missing,
               resolved_any IS NULL AND cancelled_ts IS NULL AS is_terminal_missing,
               ifnull(triage_fixed < intake_ts, false) AS is_triage_before_intake_after_fix
        FROM repaired""",
    "spine": """
        SELECT CAST(cal_date AS TIMESTAMP) + to_minutes(480 + n) AS minute_ts, cal_date,
               row_number() OVER (ORDER BY cal_date, n) - 1 AS minute_idx
        FROM business_days, range(600) AS r(n)""",
    "wait_intervals": """
        SELECT case_id, ts AS cw_start_ts, next_ts AS cw_end_ts
        FROM (SELECT *, min(ts) OVER (PARTITION BY case_id ORDER BY ts
                 RANGE BETWEEN INTERVAL 1 MICROSECOND FOLLOWING AND UNBOUNDED FOLLOWING)
                 AS next_ts FROM marks)
        WHERE status = 'CUSTOMER_WAIT'""",
    "wait_minutes": """
        SELECT case_id, count(minute_ts) AS customer_wait_business_minutes
        FROM wait_intervals
        LEFT JOIN spine ON minute_ts >= cw_start_ts AND minute_ts < cw_end_ts
        WHERE cw_end_ts IS NOT NULL AND cw_start_ts >= (SELECT min(s.minute_ts) FROM spine s)
        GROUP BY case_id""",
    "wait_minutes_left": """
        SELECT case_id, count(minute_ts) AS customer_wait_business_minutes
        FROM wait_intervals
        LEFT JOIN spine ON minute_ts >= cw_start_ts AND minute_ts < cw_end_ts
        WHERE cw_end_ts IS NOT NULL
        GROUP BY case_id""",
    "hot_marks": """
        SELECT DISTINCT IF(case_id % 3 = 0, 0, case_id) AS case_id, status, ts FROM marks""",
    "hot_wait_intervals": """
        SELECT case_id, ts AS cw_start_ts, next_ts AS cw_end_ts
        FROM (SELECT *, min(ts) OVER (PARTITION BY case_id ORDER BY ts
                 RANGE BETWEEN INTERVAL 1 MICROSECOND FOLLOWING AND UNBOUNDED FOLLOWING)
                 AS next_ts FROM hot_marks)
        WHERE status = 'CUSTOMER_WAIT'""",
    "hot_wait_minutes": """
        SELECT case_id, count(minute_ts) AS customer_wait_business_minutes
        FROM hot_wait_intervals
        LEFT JOIN spine ON minute_ts >= cw_start_ts AND minute_ts < cw_end_ts
        WHERE cw_end_ts IS NOT NULL AND cw_start_ts >= (SELECT min(s.minute_ts) FROM spine s)
        GROUP BY case_id""",
    "moments": """
        SELECT DISTINCT unnest([intake_ts, triage_fixed, resolved_fixed, resolved_any,
               assignment_ts, investigation_ts, customer_wait_first_ts, review_qa_ts]) AS ts
        FROM repaired""",
    "open_before": """
        SELECT ts, minutes, first_minute FROM (
          SELECT ts, is_minute, CAST(sum(is_minute) OVER (ORDER BY ts, is_minute
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS minutes,
                 min(ts) FILTER (is_minute = 1) OVER () AS first_minute
          FROM (SELECT minute_ts AS ts, 1 AS is_minute FROM spine
                UNION ALL SELECT ts, 0 FROM moments WHERE ts IS NOT NULL))
        WHERE is_minute = 0""",
    "open_within": "SELECT ts, minutes FROM open_before WHERE ts >= first_minute",
    "placed": """
        SELECT r.*, i.minutes AS intake_at, t.minutes AS triage_at, f.minutes AS resolved_at
        FROM repaired r JOIN open_within i ON intake_ts = i.ts
        JOIN open_within t ON triage_fixed = t.ts JOIN open_within f ON resolved_fixed = f.ts""",
    "placed_left": """
        SELECT r.*, i.minutes AS intake_at, t.minutes AS triage_at, f.minutes AS resolved_at
        FROM repaired r LEFT JOIN open_before i ON intake_ts = i.ts
        LEFT JOIN open_before t ON triage_fixed = t.ts
        LEFT JOIN open_before f ON resolved_fixed = f.ts""",
}

_METRICS = """
        SELECT case_id, case_type, tier, team_tz, intake_date, intake_ts,
               triage_fixed AS triage_ts, resolved_fixed AS resolved_ts, cancelled_ts,
               touch AS first_touch_business_minutes,
               whole AS first_resolution_business_minutes_including_cw,
               waited AS customer_wait_business_minutes,
               paused AS first_resolution_business_minutes_paused_cw,
               round(touch / 60.0::DOUBLE, 3) AS first_touch_business_hours,
               round(whole / 60.0::DOUBLE, 3) AS first_resolution_business_hours_including_cw,
               round(paused / 60.0::DOUBLE, 3) AS first_resolution_business_hours_paused_cw,
               touch > 120 AS sla_b_breached, whole > 1440 AS sla_a_breached_including_cw,
               paused > 1440 AS sla_a_breached_paused_cw,
               triage_fixed IS NULL AS is_triage_missing_for_sla,
               resolved_fixed IS NULL AND cancelled_ts IS NULL AS is_terminal_missing_for_sla,
               ifnull(triage_fixed < intake_ts, false) AS is_triage_before_intake_for_sla
        FROM (SELECT *, IF(whole IS NULL, NULL, greatest(0, whole - waited)) AS paused
              FROM (SELECT p.*, ifnull(customer_wait_business_minutes, 0) AS waited,
                           IF(triage_at IS NULL, NULL, greatest(0, triage_at - intake_at)) AS touch,
                           IF(resolved_at IS NULL, NULL, greatest(0, resolved_at - intake_at))
                             AS whole
                    FROM {placed} p LEFT JOIN {waits} USING (case_id)))"""

# Three zones: times in the zone of the tier, hours by zone, in one of them other holidays.
TABLES |= {
    "zoned_cases": """
        SELECT case_id, (intake_ts AT TIME ZONE 'UTC') AT TIME ZONE zone AS intake_ts, case_type,
               tier, zone AS team_tz,
               CAST((intake_ts AT TIME ZONE 'UTC') AT TIME ZONE zone AS DATE) AS intake_date
        FROM (SELECT *, CASE tier WHEN 'TIER_1' THEN 'America/Los_Angeles'
                     WHEN 'TIER_2' THEN 'America/Denver' ELSE 'America/New_York' END AS zone
              FROM cases)""",
    "zoned_marks": """
        SELECT DISTINCT case_id, team_tz, status, (ts AT TIME ZONE 'UTC') AT TIME ZONE team_tz AS ts
        FROM marks JOIN zoned_cases USING (case_id)""",
    "zoned_days": """
        SELECT 'America/Los_Angeles' AS team_tz, cal_date, 480 AS opens, 600 AS minutes
        FROM business_days
        UNION ALL SELECT 'America/New_York', cal_date, 420, 540 FROM business_days
        UNION ALL SELECT 'America/Denver', cal_date, 540, 480 FROM numbered_days
        WHERE dow < 5 AND NOT ((m = 7 AND d = 4) OR (m = 12 AND d = 25)
          OR (m = 9 AND dow = 0 AND d > 1 AND nth_after_first = 1)
          OR (m = 11 AND dow = 3 AND d > 1 AND nth_after_first = 4))""",
    "zoned_spine": """
        SELECT team_tz, CAST(cal_date AS TIMESTAMP) + to_minutes(opens + n) AS minute_ts,
               row_number() OVER (PARTITION BY team_tz ORDER BY cal_date, n) - 1 AS minute_idx
        FROM zoned_days, LATERAL (SELECT unnest(range(minutes)) AS n)""",
    "zoned_repaired": """
        SELECT c.*,
               min(ts) FILTER (status = 'TRIAGE') AS triage_any,
               ifnull(min(ts) FILTER (status = 'TRIAGE' AND ts >= intake_ts), triage_any)
                 AS triage_fixed,
               min(ts) FILTER (status = 'RESOLVED') AS resolved_any,
               ifnull(min(ts) FILTER (status = 'RESOLVED' AND ts >= intake_ts), resolved_any)
                 AS resolved_fixed,
               min(ts) FILTER (status = 'CANCELLED') AS cancelled_ts
        FROM zoned_cases c LEFT JOIN (SELECT case_id, status, ts FROM zoned_marks) USING (case_id)
        GROUP BY ALL""",
    "zoned_waits": """
        SELECT case_id, count(minute_ts) AS customer_wait_business_minutes
        FROM (SELECT case_id, team_tz AS zone, status, ts AS cw_start_ts,
                     min(ts) OVER (PARTITION BY case_id ORDER BY ts
                       RANGE BETWEEN INTERVAL 1 MICROSECOND FOLLOWING AND UNBOUNDED FOLLOWING)
                       AS cw_end_ts FROM zoned_marks) w
        LEFT JOIN zoned_spine s
          ON zone = s.team_tz AND minute_ts >= cw_start_ts AND minute_ts < cw_end_ts
        WHERE status = 'CUSTOMER_WAIT' AND cw_end_ts IS NOT NULL
          AND cw_start_ts >= (SELECT min(f.minute_ts) FROM zoned_spine f WHERE f.team_tz = zone)
        GROUP BY case_id""",
    "zoned_within": """
        SELECT * FROM (
          SELECT zone, ts, is_minute, CAST(sum(is_minute) OVER (PARTITION BY zone
                   ORDER BY ts, is_minute ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                   AS BIGINT) AS minutes,
                 min(ts) FILTER (is_minute = 1) OVER (PARTITION BY zone) AS first_minute
          FROM (SELECT team_tz AS zone, minute_ts AS ts, 1 AS is_minute FROM zoned_spine
                UNION ALL SELECT DISTINCT team_tz,
                  unnest([intake_ts, triage_fixed, resolved_fixed]), 0 FROM zoned_repaired)
          WHERE ts IS NOT NULL)
        WHERE is_minute = 0 AND ts >= first_minute""",
    "zoned_placed": """
        SELECT r.*, i.minutes AS intake_at, t.minutes AS triage_at, f.minutes AS resolved_at
        FROM zoned_repaired r JOIN zoned_within i ON team_tz = i.zone AND intake_ts = i.ts
        JOIN zoned_within t ON team_tz = t.zone AND triage_fixed = t.ts
        JOIN zoned_within f ON team_tz = f.zone AND resolved_fixed = f.ts""",
}

TABLES["case_sla_metrics_zoned"] = _METRICS.format(placed="zoned_placed", waits="zoned_waits")
TABLES["case_sla_metrics"] = _METRICS.format(placed="placed", waits="wait_minutes")
TABLES["case_sla_metrics_left"] = _METRICS.format(placed="placed_left", waits="wait_minutes_left")

_STAGE_TIMES = {
    "i": "intake_ts",
    "t": "triage_ts",
    "a": "assignment_ts",
    "v": "investigation_ts",
    "q": "review_qa_ts",
    "f": "resolved_ts",
}
_STAGES = """
        SELECT case_id, intake_date, tier, case_type, team_tz,
               greatest(0, t_at - i_at) AS mins_intake_to_triage,
               greatest(0, a_at - t_at) AS mins_triage_to_assignment,
               greatest(0, v_at - a_at) AS mins_assignment_to_investigation,
               greatest(0, q_at - v_at) AS mins_investigation_to_reviewqa,
               greatest(0, f_at - q_at) AS mins_reviewqa_to_resolved,
               greatest(0, f_at - i_at) AS mins_intake_to_resolved
        FROM (SELECT m.*, {positions} FROM case_milestones m {joins})"""


def _stage_table(extra: dict[str, str]) -> str:
    times = {**_STAGE_TIMES, **extra}
    return _STAGES.format(
        positions=", ".join(f"{a}.minutes AS {a}_at" for a in times),
        joins=" ".join(f"JOIN open_within {a} ON m.{ts} = {a}.ts" for a, ts in times.items()),
    )


TABLES["case_stage_durations"] = _stage_table({"w": "customer_wait_first_ts"})
TABLES["case_stage_durations_all"] = _stage_table({})

TABLES |= {
    "staffing_daily": """
        SELECT shift_date AS cal_date, team_tz,
               CAST(sum(planned_agents) AS BIGINT) AS planned_agents_total,
               CAST(sum(effective_agents) AS BIGINT) AS effective_agents_total,
               round(avg(shrinkage_rate), 4) AS avg_shrinkage_rate,
               round(avg(deterioration_multiplier), 4) AS avg_deterioration_multiplier
        FROM staffing_schedule GROUP BY ALL""",
    "backlog_daily_proxy": """
        SELECT *, cum_intake - cum_terminal AS open_backlog_proxy
        FROM (SELECT cal_date, intake_cases, terminal_cases,
                     CAST(sum(intake_cases) OVER so_far AS BIGINT) AS cum_intake,
                     CAST(sum(terminal_cases) OVER so_far AS BIGINT) AS cum_terminal
              FROM (SELECT cal_date,
                           (SELECT count(*) FROM cases WHERE intake_date = cal_date)
                             AS intake_cases,
                           (SELECT count(*) FROM case_milestones
                            WHERE CAST(ifnull(resolved_ts, cancelled_ts) AS DATE) = cal_date)
                             AS terminal_cases
                    FROM calendar_dim)
              WINDOW so_far AS (ORDER BY cal_date))""",
    "congestion_daily": """
        SELECT cal_date, team_tz, intake_cases, terminal_cases, open_backlog_proxy,
               effective_agents_total,
               round(open_backlog_proxy::DOUBLE / nullif(effective_agents_total, 0), 4)
                 AS congestion_index
        FROM backlog_daily_proxy LEFT JOIN staffing_daily USING (cal_date)""",
    "congestion_daily_v2": """
        SELECT cal_date, team_tz, intake_cases, terminal_cases, open_backlog_proxy,
               open_backlog_proxy - lag(open_backlog_proxy)
                 OVER (PARTITION BY team_tz ORDER BY cal_date) AS backlog_delta,
               effective_agents_total,
               round(intake_cases::DOUBLE / nullif(effective_agents_total, 0), 4)
                 AS congestion_flow_index,
               round(open_backlog_proxy::DOUBLE / nullif(effective_agents_total, 0), 4)
                 AS congestion_stock_index
        FROM congestion_daily SEMI JOIN business_days USING (cal_date)""",
    # Means of values with few decimals are taken over integers, rounded half up.
    "case_congestion_exposure": """
        SELECT case_id, tier, case_type, intake_date, resolved_date,
               count(*) AS biz_days_in_window,
               ((2 * CAST(sum(flow) AS BIGINT) + count(*)) // (2 * count(*))) / 10000.0::DOUBLE
                 AS avg_congestion_flow_index
        FROM (SELECT case_id, tier, case_type, intake_date,
                     CAST(resolved_ts AS DATE) AS resolved_date, cal_date
              FROM case_sla_metrics
              JOIN business_days ON cal_date BETWEEN intake_date AND CAST(resolved_ts AS DATE)
              QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY cal_date) <= 10)
        JOIN (SELECT cal_date, CAST(round(congestion_flow_index * 10000) AS BIGINT) AS flow
              FROM congestion_daily_v2 WHERE congestion_flow_index IS NOT NULL)
        USING (cal_date)
        GROUP BY ALL""",
    "case_deciles": """
        SELECT s.*, avg_congestion_flow_index AS exposure,
               CAST(ntile(10) OVER (ORDER BY avg_congestion_flow_index, case_id) AS INTEGER)
                 AS congestion_decile
        FROM case_sla_metrics s
        JOIN (SELECT case_id, avg_congestion_flow_index FROM case_congestion_exposure)
        USING (case_id)""",
}


def _mean(column: str, digits: int) -> str:
    scale = 10**digits
    return (
        f"(2 * CAST(sum(CAST(round({column} * {scale}) AS BIGINT)) AS BIGINT) + count({column}))"
        f" // (2 * count({column})) / {scale}.0::DOUBLE"
    )


def _pct(condition: str, digits: int = 3) -> str:
    return f"round(100.0 * avg(({condition} IS TRUE)::INT), {digits})"


def _spread(column: str, prefix: str, suffix: str = "") -> str:
    return ", ".join(
        f"round(quantile_cont({column}, {q}), 6) AS {prefix}_p{p}_min{suffix}"
        for p, q in ((50, 0.5), (90, 0.9), (95, 0.95))
    )


_TOUCH = "first_touch_business_minutes"
_WHOLE = "first_resolution_business_minutes_including_cw"
_PAUSED = "first_resolution_business_minutes_paused_cw"


def _sla_daily(sla: str) -> str:
    return f"""
        SELECT intake_date, count(*) AS cases_in_sla_table,
               count({_TOUCH}) AS cases_with_triage,
               {_pct("sla_b_breached")} AS sla_b_breach_pct, {_spread(_TOUCH, "ft")},
               count({_WHOLE}) AS cases_resolved,
               {_pct("sla_a_breached_including_cw")} AS sla_a_breach_pct_including_cw,
               {_pct("sla_a_breached_paused_cw")} AS sla_a_breach_pct_paused_cw,
               {_spread(_WHOLE, "fr", "_inc_cw")}, {_spread(_PAUSED, "fr", "_pause_cw")},
               {_pct("is_triage_missing_for_sla")} AS dq_triage_missing_pct,
               {_pct("is_terminal_missing_for_sla")} AS dq_terminal_missing_pct
        FROM {sla} GROUP BY intake_date"""


def _stage_percentiles(stages: str) -> str:
    names = {
        "intake_to_triage": "intake_to_triage",
        "triage_to_assignment": "triage_to_assignment",
        "assignment_to_investigation": "assignment_to_investigation",
        "investigation_to_reviewqa": "investigation_to_reviewqa",
        "reviewqa_to_resolved": "reviewqa_to_resolved",
        "intake_to_resolved": "total",
    }
    columns = ", ".join(
        f"round(quantile_cont(mins_{name}, {q}), 6) AS p{p}_{label}"
        for name, label in names.items()
        for p, q in ((50, 0.5), (90, 0.9), (95, 0.95))
    )
    return f"SELECT tier, {columns} FROM {stages} GROUP BY tier"


def _reopen_penalty(stages: str) -> str:
    return f"""
        SELECT case_id, tier, case_type, reopen_penalty_business_minutes
        FROM case_sla_metrics
        SEMI JOIN (SELECT case_id FROM marks WHERE status = 'REOPENED') USING (case_id)
        JOIN (SELECT tier, median(mins_investigation_to_reviewqa)
                       AS reopen_penalty_business_minutes
              FROM {stages} GROUP BY tier) USING (tier)"""


def _scenarios(stages: str, penalties: str) -> str:
    return f"""
        WITH one AS (
            SELECT count(*) AS n, round(100.0 * avg(was), 3) AS was_pct,
                   round(100.0 * avg(becomes), 3) AS becomes_pct,
                   CAST(sum(was) AS BIGINT) AS was, CAST(sum(becomes) AS BIGINT) AS becomes,
                   round(CAST(sum(saved) AS DOUBLE) / 60, 2) AS hours
            FROM (SELECT sla_a_breached_including_cw::INT AS was,
                         ({_WHOLE} - saved > 1440)::INT AS becomes, saved
                  FROM (SELECT *, 0.20 * mins_investigation_to_reviewqa AS saved
                        FROM case_sla_metrics JOIN (SELECT * EXCLUDE (tier, case_type,
                             team_tz, intake_date) FROM {stages}) USING (case_id))
                  WHERE tier = 'TIER_3')),
        two AS (
            SELECT count(*) AS n,
                   round(0.25 * sum(reopen_penalty_business_minutes) / 60, 2) AS hours
            FROM {penalties})
        SELECT 'S1_TIER3_reduce_investigation_to_reviewQA_20pct' AS scenario_name,
               n AS eligible_cases, was_pct AS baseline_breach_pct_inc,
               becomes_pct AS scenario_breach_pct_inc, was AS baseline_breaches_inc,
               becomes AS scenario_breaches_inc, was - becomes AS breaches_avoided_inc,
               hours AS resolution_hours_saved, 0::DOUBLE AS reopen_hours_saved,
               round(hours, 2) AS total_hours_saved FROM one
        UNION ALL
        SELECT 'S2_reduce_reopens_25pct', n, NULL, NULL, NULL, NULL, NULL, 0, hours,
               round(hours, 2) FROM two
        UNION ALL
        SELECT 'S3_combined_S1_plus_S2', one.n, was_pct, becomes_pct, was, becomes,
               was - becomes, one.hours, two.hours, round(one.hours + two.hours, 2)
        FROM one, two"""


TABLES |= {
    "sla_daily": _sla_daily("case_sla_metrics"),
    "sla_daily_left": _sla_daily("case_sla_metrics_left"),
    "sla_by_tier_case_type": f"""
        SELECT tier, case_type, count(*) AS cases,
               {_pct("sla_b_breached")} AS sla_b_breach_pct, {_spread(_TOUCH, "ft")},
               {_pct("sla_a_breached_including_cw")} AS sla_a_breach_pct_including_cw,
               {_pct("sla_a_breached_paused_cw")} AS sla_a_breach_pct_paused_cw,
               {_spread(_WHOLE, "fr", "_inc_cw")}, {_spread(_PAUSED, "fr", "_pause_cw")}
        FROM case_sla_metrics GROUP BY ALL""",
    "driver_congestion_buckets": f"""
        SELECT congestion_decile, tier, count(*) AS cases,
               {_pct("sla_b_breached")} AS sla_b_breach_pct,
               {_pct("sla_a_breached_including_cw")} AS sla_a_breach_pct_inc_cw,
               {_pct("sla_a_breached_paused_cw")} AS sla_a_breach_pct_pause_cw,
               {_mean("exposure", 4)} AS avg_congestion_exposure
        FROM case_deciles GROUP BY ALL""",
    "decile_rates": f"""
        SELECT congestion_decile, {_pct("sla_b_breached")} AS b,
               {_pct("sla_a_breached_including_cw")} AS a
        FROM case_deciles GROUP BY ALL""",
    "driver_summary": """
        SELECT m.b AS sla_b_breach_p50_cong, h.b AS sla_b_breach_p90_cong,
               t.b AS sla_b_breach_p95plus_cong,
               round(h.b - m.b, 3) AS sla_b_breach_lift_p90_vs_p50,
               round(t.b - m.b, 3) AS sla_b_breach_lift_p95_vs_p50,
               m.a AS sla_a_breach_p50_cong, h.a AS sla_a_breach_p90_cong,
               t.a AS sla_a_breach_p95plus_cong,
               round(h.a - m.a, 3) AS sla_a_breach_lift_p90_vs_p50,
               round(t.a - m.a, 3) AS sla_a_breach_lift_p95_vs_p50
        FROM decile_rates m, decile_rates h, decile_rates t
        WHERE m.congestion_decile = 5 AND h.congestion_decile = 9
          AND t.congestion_decile = 10""",
    "case_hours": """
        SELECT m.case_id, m.tier, m.case_type, m.reopened_first_ts IS NOT NULL AS is_reopened,
               s.first_resolution_business_hours_including_cw AS fr_hours_inc_cw,
               s.first_resolution_business_hours_paused_cw AS fr_hours_pause_cw
        FROM case_milestones m, case_sla_metrics s
        WHERE m.case_id = s.case_id AND s.resolved_ts IS NOT NULL""",
    "driver_reopen_impact": f"""
        SELECT tier, case_type, is_reopened, count(*) AS cases,
               {_mean("fr_hours_inc_cw", 3)} AS avg_fr_hours_inc_cw,
               {_mean("fr_hours_pause_cw", 3)} AS avg_fr_hours_pause_cw,
               round(quantile_cont(fr_hours_inc_cw, 0.9), 6) AS p90_fr_hours_inc_cw,
               round(quantile_cont(fr_hours_inc_cw, 0.95), 6) AS p95_fr_hours_inc_cw
        FROM case_hours GROUP BY ALL""",
    "driver_stage_durations": _stage_percentiles("case_stage_durations"),
    "driver_stage_durations_all": _stage_percentiles("case_stage_durations_all"),
    "reopen_penalty": _reopen_penalty("case_stage_durations"),
    "reopen_penalty_all": _reopen_penalty("case_stage_durations_all"),
    "scenario_results": _scenarios("case_stage_durations", "reopen_penalty"),
    "scenario_results_all": _scenarios("case_stage_durations_all", "reopen_penalty_all"),
}


def with_tables(query: str) -> str:
    """The query preceded by the tables it needs, directly or through others."""
    wanted: set[str] = set()
    pending = [query]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        for name in words & TABLES.keys() - wanted:
            wanted.add(name)
            pending.append(TABLES[name])
    ctes = ",\n".join(
        f"{name} AS MATERIALIZED ({sql})" for name, sql in TABLES.items() if name in wanted
    )
    return f"WITH {ctes}\n{query}" if ctes else query


def _counts(*names: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS table_name, count(*) AS row_count FROM {table}"
        for label, table in (n.split("=") if "=" in n else (n, n) for n in names)
    )


_HAS = ("TRIAGE", "RESOLVED", "CANCELLED", "REOPENED", "ESCALATED", "CUSTOMER_WAIT")


def _triage_before_intake(time: str) -> str:
    return f"""
        SELECT count(*) AS cases_with_both,
               {_pct("triage < intake", 4)} AS pct_triage_before_intake
        FROM (SELECT min({time}) FILTER (status = 'INTAKE') AS intake,
                     min({time}) FILTER (status = 'TRIAGE') AS triage
              FROM events_log GROUP BY case_id)
        WHERE intake IS NOT NULL AND triage IS NOT NULL"""


def _integrity(rounded: bool) -> str:
    def share(condition: str) -> str:
        return _pct(condition) if rounded else f"100.0 * avg(({condition} IS TRUE)::INT)"

    return f"""
        SELECT {share("event_ts IS NULL")} AS pct_missing_event_ts,
               {share("is_duplicate")} AS pct_duplicate_flag,
               {share("is_late_arriving")} AS pct_late_arriving_flag,
               {share("event_tz = 'INCONSISTENT'")} AS pct_tz_inconsistent
        FROM events_log"""


_DURATIONS = {"touch": _TOUCH, "whole": _WHOLE, "paused": _PAUSED}


def _by_period(period: str, columns: str) -> str:
    """A query per measure, over the cases of every month, quarter or year."""
    return " UNION ALL ".join(
        f"""SELECT CAST(date_trunc('{period}', intake_date) AS DATE) AS period,
                   '{measure}' AS measure, count(*) AS cases, {columns.format(minutes=minutes)}
            FROM case_sla_metrics WHERE {minutes} IS NOT NULL GROUP BY ALL"""
        for measure, minutes in _DURATIONS.items()
    )


_PERCENTILES = ", ".join(
    f"round(quantile_cont({{minutes}}, {q}), 6) AS p{p}_min"
    for p, q in ((50, 0.5), (90, 0.9), (95, 0.95))
)

_QUERIES = {
    "s1_scan_staffing": "SELECT * FROM staffing_schedule",
    "s2_scan_partitioned_cases": "SELECT * FROM cases",
    "s3_write_partitioned_events": "SELECT * FROM events_log",
    "s4_replace_days": "SELECT event_id, case_id, intake_date FROM events_log",
    "s4_refreshed_sla_daily": "SELECT * FROM sla_daily",
    "s4_refreshed_sla_by_tier_case_type": "SELECT * FROM sla_by_tier_case_type",
    "s4_refreshed_backlog_daily_proxy": "SELECT * FROM backlog_daily_proxy",
    "s5_saved_table": "SELECT * FROM sla_by_tier_case_type",
    "s6_csv_export": _counts(
        "sla_daily",
        "sla_by_tier_case_type",
        "staffing_daily",
        "backlog_daily_proxy",
        "congestion_daily",
        "driver_stage_durations",
        "driver_reopen_impact",
        "scenario_results",
    ),
    "s5_published_events_clean": "SELECT * FROM events_clean",
    "s5_published_case_sla_metrics": "SELECT * FROM case_sla_metrics",
    "s5_published_scenario_results": "SELECT * FROM scenario_results",
    "s6_csv_sla_daily": "SELECT * FROM sla_daily",
    "s6_csv_sla_by_tier_case_type": "SELECT * FROM sla_by_tier_case_type",
    "s6_csv_staffing_daily": "SELECT * FROM staffing_daily",
    "s6_csv_backlog_daily_proxy": "SELECT * FROM backlog_daily_proxy",
    "s6_csv_congestion_daily": "SELECT * FROM congestion_daily",
    "s6_csv_driver_stage_durations": "SELECT * FROM driver_stage_durations",
    "s6_csv_driver_reopen_impact": "SELECT * FROM driver_reopen_impact",
    "s6_csv_scenario_results": "SELECT * FROM scenario_results",
    "s7_json_metrics": _integrity(rounded=True),
    "s8_calendar": "SELECT * FROM calendar_dim",
    "s8_calendar_after_first": """
        SELECT cal_date, CAST(dow AS SMALLINT) AS dow, dow >= 5 AS is_weekend,
               holiday_name IS NOT NULL AS is_holiday, holiday_name
        FROM (SELECT *, CASE WHEN m = 7 AND d = 4 THEN 'Independence Day'
                             WHEN m = 12 AND d = 25 THEN 'Christmas Day'
                             WHEN d = 1 THEN NULL
                             WHEN m = 9 AND dow = 0 AND nth_after_first = 1 THEN 'Labor Day'
                             WHEN m = 11 AND dow = 3 AND nth_after_first = 4 THEN 'Thanksgiving'
                        END AS holiday_name FROM numbered_days)""",
    "s9_staffing_schedule": "SELECT * FROM staffing_schedule",
    "p1_canonical_time": """
        SELECT event_id, ifnull(event_ts, ingestion_ts) AS event_ts_canonical FROM events_log""",
    "p2_events_clean": "SELECT * FROM events_clean",
    "p3_milestone_flags": """
        SELECT case_id, is_triage_missing, is_terminal_missing, is_triage_before_intake_after_fix
        FROM case_milestones""",
    "p4_sla_flags": """
        SELECT case_id, is_triage_missing_for_sla, is_terminal_missing_for_sla,
               is_triage_before_intake_for_sla FROM case_sla_metrics_left""",
    "p5_terminal_cases": """
        SELECT case_id, ifnull(resolved_ts, cancelled_ts) AS terminal_ts FROM case_milestones
        WHERE resolved_ts IS NOT NULL OR cancelled_ts IS NOT NULL""",
    "p6_business_days": "SELECT cal_date FROM business_days",
    "j1_milestones_with_sla": "SELECT * FROM case_hours",
    "j2_cases_with_wait_minutes": """
        SELECT case_id, customer_wait_business_minutes FROM cases LEFT JOIN wait_minutes
        USING (case_id)""",
    "j3_reopened_with_tier_penalty": "SELECT * FROM reopen_penalty",
    "j5_business_position": """
        SELECT event_id, CASE WHEN ts IS NOT NULL THEN
                 ifnull(minute_idx + (minute_ts < ts)::BIGINT, 0) END AS position
        FROM (SELECT event_id, event_ts AS ts FROM events_log)
        ASOF LEFT JOIN spine ON ts >= minute_ts""",
    "j5_business_position_inner": """
        SELECT event_id, minute_idx + (minute_ts < ts)::BIGINT AS position
        FROM (SELECT event_id, event_ts AS ts FROM events_log)
        ASOF JOIN spine ON ts >= minute_ts""",
    "j5_business_minutes_dim": "SELECT * FROM spine",
    "w1_events_dedup": "SELECT * FROM events_deduped",
    "w1_events_dedup_stream": "SELECT * FROM events_deduped",
    "w2_congestion_deciles": """
        SELECT case_id, exposure AS avg_congestion_flow_index, congestion_decile
        FROM case_deciles""",
    "w5_wait_intervals": "SELECT * FROM wait_intervals",
    "a7_case_sla_metrics_zoned": "SELECT * FROM case_sla_metrics_zoned",
    "w5_wait_intervals_hot_case": "SELECT * FROM hot_wait_intervals",
    "a5_wait_minutes_hot_case": "SELECT * FROM hot_wait_minutes",
    "j5_asof_last_resolved": """
        SELECT c.case_id, c.tier, c.intake_ts, r.resolved_ts, r.resolved_case_id
        FROM cases c ASOF LEFT JOIN (
          SELECT tier, event_ts AS resolved_ts, max(case_id) AS resolved_case_id
          FROM events_log JOIN cases USING (case_id)
          WHERE status = 'RESOLVED' AND event_ts IS NOT NULL GROUP BY ALL) r
        ON c.tier = r.tier AND c.intake_ts >= r.resolved_ts""",
    "j6_waits_in_staffing_gaps": """
        SELECT w.*, g.*, CAST((epoch_us(least(cw_end_ts, gap_end))
                 - epoch_us(greatest(cw_start_ts, gap_start))) // 1000000 AS BIGINT)
                 AS unstaffed_seconds
        FROM wait_intervals w JOIN (
          SELECT gap_start, gap_end FROM (
            SELECT CAST(shift_date AS TIMESTAMP) + to_hours(max(shift_end_hour)) AS gap_start,
                   lead(CAST(shift_date AS TIMESTAMP) + to_hours(min(shift_start_hour)))
                     OVER (ORDER BY shift_date) AS gap_end
            FROM staffing_schedule GROUP BY shift_date)
          WHERE gap_end > gap_start) g
        ON cw_start_ts < gap_end AND gap_start < cw_end_ts""",
    "m2_sla_by_segment_sets": f"""
        SELECT tier, case_type, CAST(grouping(tier, case_type) AS BIGINT) AS level,
               count(*) AS cases,
               {_pct("sla_b_breached")} AS sla_b_breach_pct, {_spread(_TOUCH, "ft")},
               {_pct("sla_a_breached_including_cw")} AS sla_a_breach_pct_including_cw,
               {_pct("sla_a_breached_paused_cw")} AS sla_a_breach_pct_paused_cw,
               {_spread(_WHOLE, "fr", "_inc_cw")}, {_spread(_PAUSED, "fr", "_pause_cw")}
        FROM case_sla_metrics
        GROUP BY GROUPING SETS ((tier, case_type), (tier), (case_type), ())""",
    "g6_monthly_percentiles": _by_period("month", _PERCENTILES),
    "g6_sketched_percentiles": _by_period("quarter", "true AS within_error"),
    "a2_case_milestones": "SELECT * FROM case_milestones",
    "a3_sla_inputs": """
        SELECT case_id, intake_ts, triage_fixed AS triage_ts_final,
               resolved_fixed AS resolved_ts_final, cancelled_ts, case_type, tier, team_tz,
               intake_date FROM repaired""",
    "a5_wait_minutes": "SELECT * FROM wait_minutes",
    "a5_wait_minutes_left": "SELECT * FROM wait_minutes_left",
    "a7_case_sla_metrics": "SELECT * FROM case_sla_metrics",
    "a7_case_sla_metrics_left": "SELECT * FROM case_sla_metrics_left",
    "a8_case_stage_durations": "SELECT * FROM case_stage_durations",
    "a8_case_stage_durations_all": "SELECT * FROM case_stage_durations_all",
    "a9_reopened_cases": "SELECT DISTINCT case_id FROM events_log WHERE status = 'REOPENED'",
    "a10_reopen_penalty": "SELECT * FROM reopen_penalty",
    "a10_reopen_penalty_all": "SELECT * FROM reopen_penalty_all",
    "a7_case_sla_metrics_short": "SELECT * FROM case_sla_metrics",
    "a11_congestion_exposure": "SELECT * FROM case_congestion_exposure",
    "a11_congestion_exposure_short": "SELECT * FROM case_congestion_exposure",
    "m1_sla_daily": "SELECT * FROM sla_daily",
    "m1_sla_daily_left": "SELECT * FROM sla_daily_left",
    "m2_sla_by_tier_case_type": "SELECT * FROM sla_by_tier_case_type",
    "m3_staffing_daily": "SELECT * FROM staffing_daily",
    "m4_backlog_daily_proxy": "SELECT * FROM backlog_daily_proxy",
    "m5_congestion_daily": "SELECT * FROM congestion_daily",
    "m6_congestion_daily_v2": "SELECT * FROM congestion_daily_v2",
    "m7_driver_congestion_buckets": "SELECT * FROM driver_congestion_buckets",
    "m8_driver_reopen_impact": "SELECT * FROM driver_reopen_impact",
    "m9_driver_stage_durations": "SELECT * FROM driver_stage_durations",
    "m9_driver_stage_durations_all": "SELECT * FROM driver_stage_durations_all",
    "m10_driver_summary": "SELECT * FROM driver_summary",
    "m11_scenario_results": "SELECT * FROM scenario_results",
    "m11_scenario_results_all": "SELECT * FROM scenario_results_all",
    "f12_team_time": """
        SELECT case_id, zone AS team_tz,
               (intake_ts AT TIME ZONE 'UTC') AT TIME ZONE zone AS intake_local_ts
        FROM (SELECT case_id, intake_ts, CASE tier WHEN 'TIER_1' THEN 'America/Los_Angeles'
                     WHEN 'TIER_2' THEN 'America/Denver' ELSE 'America/New_York' END AS zone
              FROM cases)""",
    "f12_read_in_row_zone": """
        SELECT case_id, zone AS team_tz,
               (intake_ts AT TIME ZONE 'UTC') AT TIME ZONE zone AS intake_local_ts
        FROM (SELECT case_id, intake_ts, CASE tier WHEN 'TIER_1' THEN 'America/Los_Angeles'
                     WHEN 'TIER_2' THEN 'America/Denver' ELSE 'America/New_York' END AS zone
              FROM cases)""",
    "q1_row_counts": _counts(
        "raw.cases=cases",
        "raw.events_log=events_log",
        "raw.calendar_dim=calendar_dim",
        "raw.staffing_schedule=staffing_schedule",
    ),
    "q2_intake_coverage": """
        SELECT min(intake_date) AS min_intake_date, max(intake_date) AS max_intake_date,
               count(DISTINCT intake_date) AS distinct_intake_days FROM cases""",
    "q3_events_per_case": """
        SELECT count(*) AS total_events, count(DISTINCT case_id) AS distinct_cases_in_events,
               round(total_events::DOUBLE / distinct_cases_in_events, 3) AS avg_events_per_case
        FROM events_log""",
    "q4_event_integrity": _integrity(rounded=True),
    "q4_event_integrity_unrounded": _integrity(rounded=False),
    "q5_duplicate_groups": """
        SELECT count(*) AS duplicate_groups, CAST(sum(n - 1) AS BIGINT) AS duplicate_extra_rows
        FROM (SELECT count(*) AS n FROM events_log WHERE event_ts IS NOT NULL
              GROUP BY case_id, status, event_ts) WHERE n > 1""",
    "q6_ingestion_before_event": f"""
        SELECT {_pct("ingestion_ts < event_ts")} AS pct_ingestion_before_event_ts
        FROM events_log""",
    "q7_status_coverage": f"""
        SELECT count(*) AS cases_in_events, {", ".join(
            f"round(100.0 * avg(({s})::INT), 3) AS pct_cases_with_{s.lower()}" for s in _HAS)}
        FROM (SELECT {", ".join(f"bool_or(status = '{s}') AS {s}" for s in _HAS)}
              FROM events_log GROUP BY case_id)""",
    "q8_triage_before_intake": _triage_before_intake("event_ts"),
    "q9_triage_before_intake_canonical": _triage_before_intake("ifnull(event_ts, ingestion_ts)"),
    "q10_cancelled_and_resolved": f"""
        SELECT {_pct("c AND r", 4)} AS pct_cases_both_cancelled_and_resolved
        FROM (SELECT bool_or(status = 'CANCELLED') AS c, bool_or(status = 'RESOLVED') AS r
              FROM events_log GROUP BY case_id)""",
    "q11_triage_before_intake_after_repair": f"""
        SELECT {_pct("triage_ts < intake_ts", 4)} AS after_milestone_fix
        FROM case_milestones WHERE triage_ts IS NOT NULL""",
    "q12_clean_event_anomalies": f"""
        SELECT {_pct("is_event_ts_missing")} AS pct_event_ts_missing,
               {_pct("is_tz_inconsistent")} AS pct_tz_inconsistent,
               {_pct("is_ingestion_before_event_ts")} AS pct_ingestion_before_event_ts
        FROM events_clean""",
    "q13_dedup_reconciliation": """
        SELECT r.n AS raw_events_log, d.n AS staging_events_deduped,
               r.n - d.n AS dedup_removed_rows
        FROM (SELECT count(*) AS n FROM events_log) r,
             (SELECT count(*) AS n FROM events_deduped) d""",
    "q14_breach_rates": f"""
        SELECT {_pct("sla_b_breached")} AS sla_b_breach_pct,
               {_pct("sla_a_breached_including_cw")} AS sla_a_breach_pct_including_cw,
               {_pct("sla_a_breached_paused_cw")} AS sla_a_breach_pct_paused_cw
        FROM case_sla_metrics WHERE resolved_ts IS NOT NULL""",
    "q15_sla_triage_before_intake": f"""
        SELECT {_pct("is_triage_before_intake_for_sla", 4)} AS triage_before_intake_pct_for_sla
        FROM case_sla_metrics WHERE triage_ts IS NOT NULL""",
    "q16_sla_percentiles": f"""
        SELECT {_spread(_TOUCH, "ft")}, {_spread(_WHOLE, "fr", "_inc")},
               {_spread(_PAUSED, "fr", "_pause")}
        FROM case_sla_metrics WHERE resolved_ts IS NOT NULL""",
    "q17_daily_breach_means": f"""
        SELECT {_mean("sla_b_breach_pct", 3)} AS avg_sla_b_breach_pct_daily,
               {_mean("sla_a_breach_pct_including_cw", 3)} AS avg_sla_a_breach_pct_inc_cw_daily,
               {_mean("sla_a_breach_pct_paused_cw", 3)} AS avg_sla_a_breach_pct_pause_cw_daily
        FROM sla_daily""",
    "q18_congestion_summary": f"""
        SELECT {_mean("congestion_index", 4)} AS avg_congestion_index,
               round(quantile_cont(congestion_index, 0.5), 6) AS cong_p50,
               round(quantile_cont(congestion_index, 0.9), 6) AS cong_p90,
               round(quantile_cont(congestion_index, 0.95), 6) AS cong_p95
        FROM congestion_daily WHERE congestion_index IS NOT NULL""",
    "q19_bottleneck_stage": """
        SELECT tier, stage, p95_minutes
        FROM (UNPIVOT (SELECT tier, p95_intake_to_triage AS intake_to_triage,
                              p95_triage_to_assignment AS triage_to_assignment,
                              p95_assignment_to_investigation AS assignment_to_investigation,
                              p95_investigation_to_reviewqa AS investigation_to_reviewqa,
                              p95_reviewqa_to_resolved AS reviewqa_to_resolved
                       FROM driver_stage_durations WHERE tier = 'TIER_3')
              ON COLUMNS(* EXCLUDE tier) INTO NAME stage VALUE p95_minutes)
        ORDER BY p95_minutes DESC LIMIT 1""",
    "q20_scenario_headline": "SELECT * FROM scenario_results",
    "q21_output_row_counts": _counts(
        "business_minutes_dim=spine",
        "case_sla_metrics",
        "mart_sla_daily=sla_daily",
        "mart_sla_by_tier_case_type=sla_by_tier_case_type",
        "mart_staffing_daily=staffing_daily",
        "mart_backlog_daily_proxy=backlog_daily_proxy",
        "mart_congestion_daily=congestion_daily",
        "case_stage_durations",
        "driver_congestion_buckets",
        "driver_reopen_impact",
        "driver_stage_durations",
        "driver_summary",
        "reopen_penalty_rows=reopen_penalty",
        "scenario_results_rows=scenario_results",
    ),
}


# The SQL of the variant with short days and a short exposure.
_SHORT = (
    ("to_minutes(480 + n)", "to_minutes(540 + n)"),
    ("range(600)", "range(180)"),
    ("ORDER BY cal_date) <= 10", "ORDER BY cal_date) <= 2"),
)


# Queries that reach the rows of another in another way.
_SAME = {
    "j5_asof_position": "j5_business_position_inner",
    "q4_event_integrity_observed": "q4_event_integrity",
    "q6_ingestion_before_event_observed": "q6_ingestion_before_event",
    "q12_clean_event_anomalies_observed": "q12_clean_event_anomalies",
    "q13_dedup_reconciliation_observed": "q13_dedup_reconciliation",
}


def oracle_sql() -> dict[str, str]:
    found = {name: with_tables(query) for name, query in _QUERIES.items()}
    found |= {name: found[same] for name, same in _SAME.items()}
    for name in found:
        if name.endswith("_short"):
            for usual, short in _SHORT:
                found[name] = found[name].replace(usual, short)
    return found
