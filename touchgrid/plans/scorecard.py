"""Per-rep scorecards: one window, calendar periods, several windows, team totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchgrid import vocab
from touchgrid.functions.text import rate

ALL_TIME_START = "2000-01-01"

COUNT_MEASURES = (
    "auto_email", "manual_email", "emails", "dials", "conversations", "linkedin",
    "li_connect", "li_message", "li_other", "other_outreach", "inbound_replies",
    "meetings_booked", "meetings_held", "meetings_canceled", "meetings_scheduled",
    "total_counted",
)
SCORECARD_COLUMNS = (
    "ca_id", "ca_name", "auto_email", "manual_email", "emails", "dials", "pursuits",
    "conversations", "linkedin", "li_connect", "li_message", "li_other", "other_outreach",
    "inbound_replies", "meetings_booked", "meetings_held", "meetings_canceled",
    "meetings_scheduled", "meetings_unknown", "total_counted", "accounts_touched",
    "contacts_touched", "contacts_per_account", "accounts_owned", "owned_touched", "coverage_pct",
)

# ---- fixed values: the printed scorecard (key, kind, operands) -----------------
LAYOUT = (
    ("ca_name", "text", None),
    ("auto_email", "db", None),
    ("manual_email", "db", None),
    ("emails", "sum", ("auto_email", "manual_email")),
    ("dials", "db", None),
    ("pursuits", "db", None),
    ("conversations", "db", None),
    ("linkedin", "db", None),
    ("other_outreach", "db", None),
    ("inbound_replies", "db", None),
    ("meetings_booked", "db", None),
    ("meetings_held", "db", None),
    ("meetings_canceled", "db", None),
    ("meetings_scheduled", "db", None),
    ("meetings_unknown", "db", None),
    ("total_counted", "db", None),
    ("accounts_touched", "db", None),
    ("contacts_touched", "db", None),
    ("accounts_owned", "db", None),
    ("owned_touched", "db", None),
    ("coverage_pct", "ratio", ("owned_touched", "accounts_owned")),
)


def d(value) -> Column:
    """A date parameter: ISO text, date object or Column."""
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def between(col: str, start, end) -> Column:
    return (F.col(col) >= d(start)) & (F.col(col) <= d(end))


def _count_aggs() -> list[Column]:
    ch, out = F.col("channel"), F.col("outcome")
    meeting = ch == "meeting"
    tests = {
        "auto_email": ch == "auto_email",
        "manual_email": ch == "manual_email",
        "emails": ch.isin(*vocab.EMAIL_CHANNELS),
        "dials": ch == "call",
        "conversations": (ch == "call") & F.col("is_conversation"),
        "linkedin": ch.startswith("li_"),
        "li_connect": ch == "li_connect",
        "li_message": ch == "li_message",
        "li_other": ch == "li_other",
        "other_outreach": ch.isin(*vocab.OTHER_CHANNELS),
        "inbound_replies": ch == "inbound_email",
        "meetings_booked": meeting,
        "meetings_held": meeting & (out == "COMPLETED"),
        "meetings_canceled": meeting & (out == "CANCELED"),
        "meetings_scheduled": meeting & out.isin(*vocab.SCHEDULED_OUTCOMES),
    }
    return [F.count_if(t).alias(n) for n, t in tests.items()] + [F.count(F.lit(1)).alias("total_counted")]


def counted(activity: DataFrame) -> DataFrame:
    """Counted rows that belong to a rep, narrowed to what the measures read."""
    return activity.where(F.col("counts") & F.col("ca_id").isNotNull())


def rep_measures(rows: DataFrame, dim_account: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """All scorecard measures of already counted rows per (groups, rep).

    Counts are first combined per (rep, account), so the owner lookup joins one row
    per pair instead of one per activity; the distinct people and call groups are a
    second narrow pass over the same columns.
    """
    keys = [*groups, "ca_id"]
    pairs = rows.groupBy(*keys, "company_id").agg(*_count_aggs())
    owners = dim_account.select(F.col("account_id").alias("company_id"), "owner_rep_id")
    per_rep = (
        pairs.join(owners, "company_id", "left")
        .groupBy(*keys)
        .agg(
            *[F.sum(m).alias(m) for m in COUNT_MEASURES],
            F.count("company_id").alias("accounts_touched"),
            F.count_if(F.col("owner_rep_id") == F.col("ca_id")).alias("owned_touched"),
        )
    )
    distinct = rows.groupBy(*keys).agg(
        F.count_distinct("contact_id").alias("contacts_touched"),
        F.count_distinct(F.when(F.col("channel") == "call", F.col("call_group_id"))).alias("pursuits"),
    )
    return per_rep.join(distinct, keys)


def owned_counts(dim_account: DataFrame) -> DataFrame:
    return (
        dim_account.where(F.col("owner_rep_id").isNotNull())
        .groupBy(F.col("owner_rep_id").alias("ca_id"))
        .agg(F.count(F.lit(1)).alias("accounts_owned"))
    )


def _finish(skeleton: DataFrame, measures: DataFrame, dim_account: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Attach measures to every skeleton row; absent ones are zero."""
    j = skeleton.join(measures, [*groups, "ca_id"], "left").join(owned_counts(dim_account), "ca_id", "left")
    zero = [*COUNT_MEASURES, "pursuits", "accounts_owned", "owned_touched"]
    j = j.withColumns({m: F.coalesce(F.col(m), F.lit(0)) for m in zero})
    j = j.withColumn(
        "meetings_unknown",
        F.col("meetings_booked") - F.col("meetings_held") - F.col("meetings_canceled") - F.col("meetings_scheduled"),
    )
    j = j.withColumn("contacts_per_account", rate(F.col("contacts_touched"), F.col("accounts_touched"), scale=1))
    j = j.withColumn("coverage_pct", rate(F.col("owned_touched"), F.col("accounts_owned")))
    j = j.withColumns({m: F.coalesce(F.col(m), F.lit(0)) for m in ("accounts_touched", "contacts_touched")})
    return j.select(*groups, *SCORECARD_COLUMNS)


def roster(dim_ca: DataFrame) -> DataFrame:
    return dim_ca.select("ca_id", F.col("name").alias("ca_name"))


def rep_scorecard(activity: DataFrame, dim_ca: DataFrame, dim_account: DataFrame, start, end) -> DataFrame:
    """26 measures per roster rep for an inclusive date window; zero rows are kept."""
    rows = counted(activity).where(between("activity_date", start, end))
    out = _finish(roster(dim_ca), rep_measures(rows, dim_account), dim_account, [])
    return out.orderBy(F.desc("total_counted"), "ca_name")


def rep_scorecard_7d(activity, dim_ca, dim_account, as_of) -> DataFrame:
    return rep_scorecard(activity, dim_ca, dim_account, F.date_sub(d(as_of), 7), F.date_sub(d(as_of), 1))


def rep_scorecard_30d(activity, dim_ca, dim_account, as_of) -> DataFrame:
    return rep_scorecard(activity, dim_ca, dim_account, F.date_sub(d(as_of), 30), F.date_sub(d(as_of), 1))


def rep_scorecard_alltime(activity, dim_ca, dim_account, as_of) -> DataFrame:
    return rep_scorecard(activity, dim_ca, dim_account, ALL_TIME_START, as_of)


# ------------------------------------------------------------------ calendar
def calendar_of(reps: DataFrame, activity: DataFrame, period: str, as_of) -> DataFrame:
    """Every rep for every week (Monday) or month from the first activity to as_of."""
    first = activity.select(F.trunc(F.min("activity_date"), period)).scalar()
    step = F.expr("interval 7 days" if period == "week" else "interval 1 month")
    start = f"{period}_start"
    out = reps.withColumn(start, F.explode(F.sequence(first, F.trunc(d(as_of), period), step)))
    end = F.date_add(start, 6) if period == "week" else F.last_day(start)
    return out.withColumn(f"{period}_end", end)


def _by_period(activity, dim_ca, dim_account, period: str, as_of) -> DataFrame:
    start = f"{period}_start"
    rows = counted(activity).withColumn(start, F.trunc("activity_date", period))
    skeleton = calendar_of(roster(dim_ca), activity, period, as_of)
    out = _finish(skeleton.drop(f"{period}_end"), rep_measures(rows, dim_account, [start]), dim_account, [start])
    end = F.date_add(start, 6) if period == "week" else F.last_day(start)
    return out.withColumn(f"{period}_end", end)


def rep_weekly_trend(activity, dim_ca, dim_account, as_of) -> DataFrame:
    return _by_period(activity, dim_ca, dim_account, "week", as_of)


def rep_monthly_scorecard(activity, dim_ca, dim_account, as_of) -> DataFrame:
    return _by_period(activity, dim_ca, dim_account, "month", as_of)


# ------------------------------------------------------------- several windows
def window_list(first: Column, last: Column) -> Column:
    """Array of (label, start, end): last 7, last 30, each month, all; clipped to the data."""

    def win(label: Column, a: Column, b: Column) -> Column:
        return F.struct(label.alias("window"), a.alias("start"), b.alias("end"))

    months = F.transform(
        F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month")),
        lambda m: win(F.date_format(m, "MMM yyyy"), F.greatest(m, first), F.least(F.last_day(m), last)),
    )
    fixed = F.array(
        win(F.lit("Last 7 days"), F.greatest(F.date_sub(last, 6), first), last),
        win(F.lit("Last 30 days"), F.greatest(F.date_sub(last, 29), first), last),
        win(F.lit("All time"), first, last),
    )
    return F.concat(fixed, months)


def data_range(activity: DataFrame) -> DataFrame:
    return activity.where("counts").agg(
        F.min("activity_date").alias("first_day"), F.max("activity_date").alias("last_day")
    )


def multi_window_scorecard(activity, dim_ca, dim_account) -> DataFrame:
    """One scorecard row per (window, rep).

    Each counted row is copied only into the windows it falls in (its month plus at
    most three), so no range join against a window table is needed.
    """
    span = data_range(activity)
    first, last = span.select("first_day").scalar(), span.select("last_day").scalar()
    day = F.col("activity_date")
    windows = F.array_compact(
        F.array(
            F.when(day >= F.date_sub(last, 6), F.lit("Last 7 days")),
            F.when(day >= F.date_sub(last, 29), F.lit("Last 30 days")),
            F.lit("All time"),
            F.date_format(day, "MMM yyyy"),
        )
    )
    rows = counted(activity).withColumn("window", F.explode(windows))
    skeleton = roster(dim_ca).withColumns({"_first": first, "_last": last})
    skeleton = skeleton.withColumn("w", F.explode(window_list(F.col("_first"), F.col("_last"))))
    skeleton = skeleton.select("ca_id", "ca_name", "w.window", "w.start", "w.end")
    out = _finish(skeleton.drop("start", "end"), rep_measures(rows, dim_account, ["window"]), dim_account, ["window"])
    bounds = skeleton.select("ca_id", "window", F.col("start").alias("window_start"), F.col("end").alias("window_end"))
    return out.join(bounds, ["ca_id", "window"])


# ------------------------------------------------------------------ team rows
def team_distincts(activity: DataFrame, start, end) -> DataFrame:
    """Accounts and people touched by anyone: true distincts, not the sum over reps."""
    return (
        counted(activity)
        .where(between("activity_date", start, end))
        .agg(
            F.count_distinct("company_id").alias("accounts_touched"),
            F.count_distinct("contact_id").alias("contacts_touched"),
        )
    )


def scorecard_layout(scorecard: DataFrame) -> DataFrame:
    """The printed columns, in order, with sums and zero-guarded ratios derived."""
    cols = []
    for key, kind, operands in LAYOUT:
        if kind == "sum":
            cols.append((F.col(operands[0]) + F.col(operands[1])).alias(key))
        elif kind == "ratio":
            ratio = F.col(operands[0]).cast("decimal(20,0)") / F.nullif(
                F.col(operands[1]).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)")
            )
            cols.append(F.round(ratio, 6).alias(key))
        else:
            cols.append(F.col(key))
    return scorecard.select(*cols)


def scorecard_with_total(activity, dim_ca, dim_account, start, end) -> DataFrame:
    """Printed scorecard plus an all-team row: sums, true distincts, ratio of totals."""
    reps = rep_scorecard(activity, dim_ca, dim_account, start, end)
    true = team_distincts(activity, start, end)
    summed = [
        k for k, kind, _ in LAYOUT if kind == "db" and k not in ("accounts_touched", "contacts_touched")
    ]
    total = reps.agg(
        F.concat(F.lit("All "), F.count(F.lit(1)).cast("string"), F.lit(" reps")).alias("ca_name"),
        *[F.sum(k).alias(k) for k in summed],
    ).withColumns({k: true.select(k).scalar() for k in ("accounts_touched", "contacts_touched")})
    return scorecard_layout(reps).unionByName(scorecard_layout(total))
