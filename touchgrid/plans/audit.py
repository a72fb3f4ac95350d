"""Audit browser, drill-through peeks, option lists, run status."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchgrid import vocab
from touchgrid.functions.text import contains_text
from touchgrid.plans.scorecard import between, counted

ALL = "(all)"
PEEK_ROWS = 8
BROWSE_ROWS = 500
ENTITY_JOBS = ("companies", "contacts", "owners", "users")


def active_names(dim_ca: DataFrame) -> DataFrame:
    return dim_ca.where("is_active").select(F.col("name").alias("ca_name")).distinct()


def inactive_names(dim_ca: DataFrame) -> DataFrame:
    return dim_ca.where("NOT is_active").select(F.col("name").alias("ca_name")).distinct()


def only_active(df: DataFrame, dim_ca: DataFrame) -> DataFrame:
    """Rows of current reps only."""
    return df.join(active_names(dim_ca), "ca_name", "left_semi")


def drop_inactive(df: DataFrame, dim_ca: DataFrame, col: str = "ca_name") -> DataFrame:
    """Drop departed reps by name; names the roster does not know stay."""
    gone = inactive_names(dim_ca).withColumnRenamed("ca_name", "_gone")
    return df.join(gone, F.col(col) == F.col("_gone"), "left_anti")


def _rep(ca_name: str) -> Column:
    return F.lit(True) if ca_name == ALL else F.col("ca_name") == ca_name


def outcome_is(outcome: str) -> Column:
    """'all', 'unknown' (anything undeclared), 'scheduled' (both kinds) or one value."""
    known = F.coalesce(F.col("outcome"), F.lit("?"))
    if outcome == "all":
        return F.lit(True)
    if outcome == "unknown":
        return ~known.isin(*vocab.KNOWN_OUTCOMES)
    if outcome == "scheduled":
        return known.isin(*vocab.SCHEDULED_OUTCOMES)
    return known == outcome


PEEK_COLUMNS = ("activity_date", "ca_name", "channel", "account_name", "subject", "contact_email", "occurred_at")


def peek(rows: DataFrame, n: int = PEEK_ROWS) -> DataFrame:
    """Newest n rows, each carrying the true number of rows behind them.

    The total is one scalar aggregate, not a window over an unpartitioned set.
    """
    total = rows.agg(F.count(F.lit(1)).alias("total")).scalar()
    newest = rows.orderBy(F.desc("occurred_at"), "activity_id").limit(n)
    return newest.select("activity_id", *PEEK_COLUMNS, total.alias("total"))


def drill_rows(
    activity_flat: DataFrame, dim_ca: DataFrame, start, end,
    ca_name: str = ALL, channels: Sequence[str] = vocab.COUNTED_CHANNELS,
    account: str = ALL, outcome: str = "all",
) -> DataFrame:
    """All rows behind one mark of a chart."""
    label = F.coalesce("account_name", F.lit(vocab.NO_ACCOUNT))
    rows = activity_flat.where(
        F.col("counts") & between("activity_date", start, end) & _rep(ca_name)
        & F.col("channel").isin(*channels) & outcome_is(outcome)
        & (F.lit(True) if account == ALL else label == account)
    )
    return only_active(rows, dim_ca)


def drill_verified(
    activity_flat: DataFrame, verification: DataFrame, dim_ca: DataFrame, start, end,
    verified: bool, ca_name: str = ALL,
) -> DataFrame:
    """Unknown-outcome meetings with (or without) a recording that proves them."""
    rows = activity_flat.where(
        F.col("counts") & (F.col("channel") == "meeting") & between("activity_date", start, end)
        & _rep(ca_name) & outcome_is("unknown")
    )
    how = "left_semi" if verified else "left_anti"
    return only_active(rows, dim_ca).join(verification.select("activity_id"), "activity_id", how)


def drill_bucket(
    activity_flat: DataFrame, flags: DataFrame, dim_ca: DataFrame, start, end, bucket: str, ca_name: str = ALL
) -> DataFrame:
    """Meetings of one new / follow-up / no-account bucket."""
    rows = activity_flat.where(between("activity_date", start, end) & _rep(ca_name))
    keep = flags.where(F.col("bucket") == bucket).select("activity_id")
    return only_active(rows, dim_ca).join(keep, "activity_id", "left_semi")


def audit_filter(
    activity_flat: DataFrame, start, end, ca_name: str = ALL, channel: str = ALL,
    state: str = "all", search: str = "",
) -> DataFrame:
    cond = between("activity_date", start, end) & _rep(ca_name)
    if channel != ALL:
        cond = cond & (F.col("channel") == channel)
    if state != "all":
        cond = cond & (F.col("counts") if state == "counted" else ~F.col("counts"))
    if search:
        cond = cond & (contains_text("subject", search) | contains_text("account_name", search))
    return activity_flat.where(cond)


def audit_rows(activity_flat: DataFrame, start, end, n: int = BROWSE_ROWS, **filters) -> DataFrame:
    """The newest rows that match the browser's filters."""
    return (
        audit_filter(activity_flat, start, end, **filters)
        .select(
            "activity_date", "occurred_at", "ca_name", "channel", "direction", "is_automated", "subject",
            "account_name", "contact_email", "counts", "excluded_reason", "dup_count", "logged_by",
            "source", "activity_id",
        )
        .orderBy(F.desc("occurred_at"), "activity_id")
        .limit(n)
    )


def audit_counts(activity_flat: DataFrame, start, end, **filters) -> DataFrame:
    return audit_filter(activity_flat, start, end, **filters).agg(
        F.count_if("counts").alias("counted"), F.count_if(~F.col("counts")).alias("excluded")
    )


def record(activity_flat: DataFrame, activity_id: str) -> DataFrame:
    return activity_flat.where(F.col("activity_id") == activity_id)


def channel_options(activity_flat: DataFrame) -> DataFrame:
    return activity_flat.select("channel").distinct().orderBy("channel")


def rep_options(dim_ca: DataFrame, active: bool = True) -> DataFrame:
    return (active_names(dim_ca) if active else inactive_names(dim_ca)).orderBy("ca_name")


def meetings_logged_by(activity_flat: DataFrame, tag: str, start, end) -> DataFrame:
    """Counted meetings per rep whose copies include one scheduler."""
    return (
        activity_flat.where(
            F.col("counts") & (F.col("channel") == "meeting") & F.array_contains("logged_by", tag)
            & between("activity_date", start, end)
        )
        .groupBy("ca_name")
        .agg(F.count(F.lit(1)).alias("meetings"))
    )


def drill_counts(activity: DataFrame, dim_ca: DataFrame, start, end) -> DataFrame:
    """(ca_id, measure, drilled): what every drill mark would list, for all reps at once."""
    reps = dim_ca.select("ca_id")
    measures = F.array_compact(
        F.array(
            *[F.when(F.col("channel").isin(*chs), F.lit(m)) for m, chs in vocab.DRILL_CHANNELS.items()],
            *[
                F.when((F.col("channel") == "meeting") & outcome_is(o), F.lit(f"meetings_{n}"))
                for n, o in (("held", "COMPLETED"), ("canceled", "CANCELED"),
                             ("scheduled", "scheduled"), ("unknown", "unknown"))
            ],
        )
    )
    return (
        counted(activity)
        .where(between("activity_date", start, end))
        .join(reps, "ca_id", "left_semi")
        .groupBy("ca_id", "channel", "outcome")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("ca_id", "n", F.explode(measures).alias("measure"))
        .groupBy("ca_id", "measure")
        .agg(F.sum("n").alias("drilled"))
    )


# -------------------------------------------------------------------- run log
def last_run(runs: DataFrame, object_types: Sequence[str] | None = None) -> DataFrame:
    ok = runs.where(F.col("status") == "ok")
    if object_types:
        ok = ok.where(F.col("object_type").isin(*object_types))
    return ok.agg(F.max("finished_at").alias("finished_at"))


def last_daily_run(runs: DataFrame) -> DataFrame:
    return last_run(runs, ENTITY_JOBS)


def active_run(runs: DataFrame, now: Column, hours: int = 2) -> DataFrame:
    """Start of the run still going, if any started within the last hours."""
    open_ = runs.where(
        F.col("finished_at").isNull() & (F.col("started_at") > now - F.expr(f"interval {hours} hours"))
    )
    return (
        open_.agg(F.min("started_at").alias("started_at"), F.count(F.lit(1)).alias("n"))
        .where("n > 0")
        .select("started_at")
    )
