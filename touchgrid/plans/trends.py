"""Display joins and reshapes on top of the scorecards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TEAM = "Whole team"


def kpi_totals(scorecard: DataFrame, measures: Sequence[str]) -> DataFrame:
    return scorecard.agg(*[F.sum(m).alias(m) for m in measures])


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "measure", value: str = "n") -> DataFrame:
    return df.unpivot(list(ids), list(values), name, value)


def held_with_verified(scorecard: DataFrame, verified: DataFrame) -> DataFrame:
    """Move recording-verified meetings from unknown to held; the sum stays booked."""
    v = F.coalesce(F.col("verified"), F.lit(0))
    return scorecard.join(verified, "ca_id", "left").select(
        "ca_id", "ca_name", "meetings_booked",
        (F.col("meetings_held") + v).alias("meetings_held"),
        "meetings_canceled", "meetings_scheduled",
        (F.col("meetings_unknown") - v).alias("meetings_unknown"),
    )


def last_weeks(trend: DataFrame, n: int, week: str = "week_start") -> DataFrame:
    """Rows of the n latest weeks present."""
    keep = trend.select(week).distinct().orderBy(F.desc(week)).limit(n)
    return trend.join(keep, week, "left_semi")


def team_and_reps(trend: DataFrame, measure: str, week: str = "week_start") -> DataFrame:
    """Per-week team line (sum of the rep values) next to every rep's own line."""
    team = trend.groupBy(week).agg(F.sum(measure).alias(measure)).withColumn("who", F.lit(TEAM))
    reps = trend.select(week, measure, F.col("ca_name").alias("who"))
    return team.select(week, measure, "who").unionByName(reps)


def pivot_weeks(trend: DataFrame, measure: str, weeks: Sequence[str], week: str = "week_start") -> DataFrame:
    """Reps down, weeks across, mean of one measure; the week list is a parameter."""
    wide = trend.withColumn("_w", F.date_format(week, "yyyy-MM-dd"))
    return wide.groupBy("ca_name").pivot("_w", list(weeks)).agg(F.avg(measure))


def partial_flags(trend: DataFrame, first_day, week: str = "week_start") -> DataFrame:
    """Mark the newest week, and the month in which the history starts, as partial."""
    latest = trend.agg(F.max(week)).scalar()
    return trend.select("ca_id", week).withColumns(
        {
            "is_latest_week": F.col(week) == latest,
            "month_is_partial": F.trunc(week, "month") == F.trunc(first_day, "month"),
        }
    )


def results_vs_activity(monthly: DataFrame, results: DataFrame, split: DataFrame) -> DataFrame:
    """Monthly activity next to monthly results and the meeting split, joined for display."""
    res = results.withColumnsRenamed({"rep_name": "ca_name", "month": "month_start"})
    j = monthly.join(res, ["month_start", "ca_name"], "left").join(
        split.select(
            "month_start", "ca_name", "meetings_new_stakeholder", "meetings_follow_up", "meetings_no_account"
        ),
        ["month_start", "ca_name"], "left",
    )
    zero = F.lit(0).cast("decimal(38,6)")
    attainment = F.round(
        F.col("saos") * 100 / F.nullif(F.col("sao_target"), zero), 0
    )
    return j.withColumns(
        {
            "saos_outbound": F.col("saos") - F.coalesce("saos_inbound", zero) - F.coalesce("saos_event", zero),
            "attainment_pct": attainment,
            "target_hit": attainment >= 100,
            "ramping": F.coalesce("is_ramping", F.lit(False)),
        }
    )


def column_scores(df: DataFrame, ids: Sequence[str], good: Sequence[str], bad: Sequence[str]) -> DataFrame:
    """Min-max position of every cell in its column, flipped where high is bad."""
    cols = [*good, *bad]
    bounds = df.agg(
        F.struct(
            *[F.min(c).alias(f"lo_{c}") for c in cols], *[F.max(c).alias(f"hi_{c}") for c in cols]
        ).alias("b")
    )
    wide = df.select(*ids, *cols, bounds.scalar().alias("_b"))
    scores = []
    for c in cols:
        span = (F.col(f"_b.hi_{c}") - F.col(f"_b.lo_{c}")).cast("decimal(20,4)")
        pos = (F.col(c) - F.col(f"_b.lo_{c}")).cast("decimal(20,4)") / F.nullif(span, F.lit(0).cast("decimal(20,4)"))
        pos = F.when(F.col(c).isNotNull(), F.coalesce(pos, F.lit(0.5).cast("decimal(20,4)")))
        scores.append(F.round(1 - pos if c in bad else pos, 4).alias(c))
    return wide.select(*ids, *scores)


def tier_heatmap(activity_flat: DataFrame, tiers: Sequence[str]) -> DataFrame:
    """Counted touches per rep and account tier."""
    return (
        activity_flat.where(F.col("counts") & F.col("ca_id").isNotNull())
        .groupBy("ca_name")
        .pivot("account_icp_tier_validated", list(tiers))
        .count()
    )

