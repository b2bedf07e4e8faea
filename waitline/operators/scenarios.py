"""What-if scenarios: faster review in one tier, fewer reopened cases, both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitline.functions.numbers import quantiles_of, share, value_counts
from waitline.settings import Scenarios, Targets

REVIEW_STAGE = "mins_investigation_to_reviewqa"


def reopened_cases(events: DataFrame) -> DataFrame:
    """Cases with a REOPENED event, once each."""
    return events.filter(F.col("status") == "REOPENED").select("case_id").distinct()


def tier_penalty(stages: DataFrame) -> DataFrame:
    """Median review stage per tier: the estimated rework of a reopened case."""
    counts = value_counts(
        stages.filter(F.col(REVIEW_STAGE).isNotNull()), ["tier"], {"review": REVIEW_STAGE}
    )
    (median,) = quantiles_of("review", (0.5,))
    return counts.groupBy("tier").agg(median.alias("reopen_penalty_business_minutes"))


def reopen_penalty(reopened: DataFrame, stages: DataFrame) -> DataFrame:
    """Estimated rework per reopened case of the SLA table.

    ``reopened`` holds case_id, tier and case_type of those cases. The penalties
    are one row per tier; Spark broadcasts them when it has seen their size.
    """
    return reopened.join(tier_penalty(stages), "tier").select(
        "case_id", "tier", "case_type", "reopen_penalty_business_minutes"
    )


def scenario_results(
    resolved: DataFrame,
    penalties: DataFrame,
    levers: Scenarios | None = None,
    targets: Targets | None = None,
) -> DataFrame:
    """Three scenarios, one row each.

    ``resolved`` has the cases of the SLA table that also have stage times, with
    both. Sums stay integer or decimal and are divided once.
    """
    levers, targets = levers or Scenarios(), targets or Targets()
    zero = F.lit(0.0)
    whole = F.col("first_resolution_business_minutes_including_cw")
    saved = F.col(REVIEW_STAGE) * F.lit(levers.review_cut)
    shortened = F.greatest(F.lit(0), whole - saved)
    breached = F.col("sla_a_breached_including_cw")

    review = resolved.filter(
        (F.col("tier") == levers.tier)
        & F.col("resolved_ts").isNotNull()
        & F.col(REVIEW_STAGE).isNotNull()
    ).agg(
        F.count("*").alias("review_cases"),
        F.sum(F.when(breached, 1).otherwise(0)).alias("before"),
        F.sum(F.when(shortened > targets.first_resolution_minutes, 1).otherwise(0)).alias(
            "after"
        ),
        F.sum(saved).cast("double").alias("review_minutes"),
    )
    rework = penalties.filter("reopen_penalty_business_minutes IS NOT NULL").agg(
        F.count("*").alias("rework_cases"),
        F.sum("reopen_penalty_business_minutes").alias("rework_minutes"),
    )
    # Two one-row results side by side, each column filled by one of them.
    both = review.unionByName(rework, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in (*review.columns, *rework.columns)]
    )
    review_hours = F.round(F.col("review_minutes") / 60.0, 2)
    rework_hours = F.round(float(levers.reopen_cut) * F.col("rework_minutes") / 60.0, 2)
    review_cases = F.col("review_cases")
    counts = {
        "baseline_breach_pct_inc": share(F.col("before"), review_cases),
        "scenario_breach_pct_inc": share(F.col("after"), review_cases),
        "baseline_breaches_inc": F.col("before"),
        "scenario_breaches_inc": F.col("after"),
        "breaches_avoided_inc": F.col("before") - F.col("after"),
    }
    kinds = {name: "double" if "pct" in name else "bigint" for name in counts}

    def row(name: str, cases: Column, review_part: Column, rework_part: Column, with_counts: bool):
        return F.struct(
            F.lit(name).alias("scenario_name"),
            cases.alias("eligible_cases"),
            *[
                (c if with_counts else F.lit(None)).cast(kinds[n]).alias(n)
                for n, c in counts.items()
            ],
            review_part.alias("resolution_hours_saved"),
            rework_part.alias("reopen_hours_saved"),
            F.round(review_part + rework_part, 2).alias("total_hours_saved"),
        )

    rows = F.array(
        row(
            "S1_TIER3_reduce_investigation_to_reviewQA_20pct",
            review_cases, review_hours, zero, True,
        ),
        row("S2_reduce_reopens_25pct", F.col("rework_cases"), zero, rework_hours, False),
        row("S3_combined_S1_plus_S2", review_cases, review_hours, rework_hours, True),
    )
    return both.select(F.explode(rows).alias("scenario")).select("scenario.*")


def scenario_headline(results: DataFrame) -> DataFrame:
    """Scenario rows for a report: numbers that are not a number become NULL."""
    doubles = [name for name, kind in results.dtypes if kind == "double"]
    return results.select(
        *[
            F.when(~F.isnan(c), F.col(c)).alias(c) if c in doubles else F.col(c)
            for c in results.columns
        ]
    )
