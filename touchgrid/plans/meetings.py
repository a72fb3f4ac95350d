"""Meetings: account mapping, new versus follow-up, recording verification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchgrid import vocab
from touchgrid.functions.text import second_part
from touchgrid.operators.keyed import nulls_last, order_struct
from touchgrid.plans.audit import outcome_is
from touchgrid.plans.scorecard import between, calendar_of, roster

BUCKETS = ("new_stakeholder", "follow_up", "no_account")


# ------------------------------------------------------------- account mapping
def meeting_attendees(meetings: DataFrame, meeting_contacts: DataFrame) -> DataFrame:
    """Attendee addresses of every raw copy of a meeting (source ids are expanded)."""
    copies = meetings.where(F.col("channel") == "meeting").select(
        "activity_id", F.explode("source_ids").alias("_src")
    )
    copies = copies.select("activity_id", F.col("_src.id").alias("meeting_id"))
    links = meeting_contacts.where(F.col("contact_email").isNotNull()).select("meeting_id", "contact_email")
    return copies.join(links, "meeting_id").select(
        "activity_id", "contact_email", second_part("contact_email").alias("email_domain")
    )


def single_canonical_domains(company_crosswalk: DataFrame) -> DataFrame:
    """Domains that exactly one canonical company carries."""
    return (
        company_crosswalk.where("is_canonical")
        .groupBy("domain_norm")
        .agg(F.min("resolved_company_id").alias("account_id"), F.count(F.lit(1)).alias("_n"))
        .where("_n = 1")
        .drop("_n")
    )


def meeting_account_map(
    meetings: DataFrame,
    meeting_contacts: DataFrame,
    contact_crosswalk: DataFrame,
    company_crosswalk: DataFrame,
    internal_domains: Sequence[str],
    free_domains: Sequence[str] = vocab.FREE_EMAIL_DOMAINS,
) -> DataFrame:
    """One account per meeting: by attendee address first, by unique domain otherwise."""
    att = meeting_attendees(meetings, meeting_contacts)
    by_email = contact_crosswalk.select(
        F.col("email").alias("contact_email"), "resolved_company_id", F.lit(1).alias("tier1")
    )
    by_domain = single_canonical_domains(company_crosswalk).where(
        ~F.col("domain_norm").isin(*free_domains, *internal_domains)
    ).select(F.col("domain_norm").alias("email_domain"), F.col("account_id").alias("domain_account"), F.lit(2).alias("tier2"))
    met = att.join(by_email, "contact_email", "left").join(by_domain, "email_domain", "left")
    # An attendee known by address never counts for its domain, and one such attendee decides.
    votes = (
        met.withColumn("tier", F.coalesce("tier1", "tier2")).where("tier IS NOT NULL")
        .groupBy("activity_id", "tier", F.when(F.col("tier") == 1, F.col("resolved_company_id"))
                 .otherwise(F.col("domain_account")).alias("account_id"))
        .agg(F.count(F.lit(1)).alias("attendees"))
    )
    order = order_struct(
        [F.col("tier"), -F.col("attendees"), *nulls_last(F.length("account_id")), F.coalesce("account_id", F.lit(""))]
    )
    return (
        votes.groupBy("activity_id")
        .agg(F.min_by(F.struct("account_id", "attendees"), order).alias("_top"))
        .select("activity_id", "_top.account_id", "_top.attendees")
    )


# ---------------------------------------------------------- new versus follow-up
def new_dates(dates: DataFrame, key: str, day: str, window_days: int = vocab.NEW_MEETING_DAYS) -> DataFrame:
    """(key, day) rows on which a new rolling window opens.

    The walk keeps the last counted day and opens a window only when a day lies more
    than `window_days` after it. Input is reduced to distinct days first, so the array
    folded per key is bounded by the calendar, however many meetings the key has.
    """
    start = F.struct(
        F.lit(None).cast("date").alias("last"), F.array().cast("array<date>").alias("opened")
    )

    def step(s, x):
        opens = s["last"].isNull() | (x > F.date_add(s["last"], window_days))
        return F.when(
            opens, F.struct(x.alias("last"), F.concat(s["opened"], F.array(x)).alias("opened"))
        ).otherwise(s)

    days = dates.select(key, day).distinct().groupBy(key).agg(F.array_sort(F.collect_list(day)).alias("_days"))
    return days.select(key, F.explode(F.aggregate("_days", start, step, lambda s: s["opened"])).alias(day))


def meeting_flags(
    activity: DataFrame, account_map: DataFrame, window_days: int = vocab.NEW_MEETING_DAYS
) -> DataFrame:
    """Bucket of every counted meeting, decided over the full history.

    Only the first meeting of a day that opens a window is new; ties on the day break
    on time, then id.
    """
    meetings = (
        activity.where((F.col("channel") == "meeting") & F.col("counts"))
        .select("activity_id", "ca_id", "activity_date", "occurred_at", "outcome")
        .join(account_map.select("activity_id", "account_id"), "activity_id", "left")
    )
    mapped = meetings.where(F.col("account_id").isNotNull())
    order = order_struct([*nulls_last("occurred_at"), F.col("activity_id")])
    firsts = mapped.groupBy("account_id", "activity_date").agg(F.min_by("activity_id", order).alias("activity_id"))
    opened = new_dates(firsts, "account_id", "activity_date", window_days)
    new_ids = firsts.join(opened, ["account_id", "activity_date"], "left_semi").select(
        "activity_id", F.lit(True).alias("_new")
    )
    return meetings.join(new_ids, "activity_id", "left").select(
        "activity_id", "ca_id", "activity_date", "occurred_at", "outcome", "account_id",
        F.when(F.col("account_id").isNull(), "no_account")
        .when(F.col("_new"), "new_stakeholder")
        .otherwise("follow_up")
        .alias("bucket"),
    )


def _bucket_counts(flags: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    return flags.groupBy(*groups, "ca_id").agg(
        F.count(F.lit(1)).alias("meetings_booked"),
        *[F.count_if(F.col("bucket") == b).alias(f"meetings_{b}") for b in BUCKETS],
    )


def _zeroed(skeleton: DataFrame, counts: DataFrame, groups: Sequence[str]) -> DataFrame:
    cols = ["meetings_booked", *[f"meetings_{b}" for b in BUCKETS]]
    j = skeleton.join(counts, [*groups, "ca_id"], "left")
    return j.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in cols})


def rep_meeting_breakdown(flags: DataFrame, dim_ca: DataFrame, start, end) -> DataFrame:
    """Booked meetings per rep split into the three buckets; every rep appears."""
    win = flags.where(between("activity_date", start, end))
    return _zeroed(roster(dim_ca), _bucket_counts(win), []).orderBy(F.desc("meetings_booked"), "ca_name")


def meeting_breakdown_by(flags: DataFrame, dim_ca: DataFrame, activity: DataFrame, period: str, as_of) -> DataFrame:
    """The same split per Monday week or calendar month, zero rows kept."""
    start = f"{period}_start"
    counts = _bucket_counts(flags.withColumn(start, F.trunc("activity_date", period)), [start])
    return _zeroed(calendar_of(roster(dim_ca), activity, period, as_of), counts, [start])


# ------------------------------------------------------------------ recordings
def live_rows(mirror: DataFrame) -> DataFrame:
    """Rows the latest completed sweep still saw."""
    return mirror.where(F.col("last_seen_at") == mirror.agg(F.max("last_seen_at")).scalar())


def time_bin(ts: Column, level: Column, bucket_seconds: int) -> Column:
    """The bin of a time at a level; a level's bins are twice as long as those of the one below."""
    return F.floor(F.unix_seconds(ts.cast("timestamp")) / F.lit(bucket_seconds) / F.pow(F.lit(2.0), level))


def slot_bins(slots: DataFrame, low: str, high: str, bucket_seconds: int) -> DataFrame:
    """Each slot with `_level` and `_bin`, once or twice: bins at its level are no shorter than it is."""
    seconds = F.unix_seconds(F.col(high).cast("timestamp")) - F.unix_seconds(F.col(low).cast("timestamp"))
    level = F.ceil(F.log2(F.greatest(seconds / F.lit(bucket_seconds), F.lit(1.0)))).cast("int")
    ends = [time_bin(F.col(c), F.col("_level"), bucket_seconds) for c in (low, high)]
    return slots.withColumn("_level", level).withColumn("_bin", F.explode(F.array_distinct(F.array(*ends))))


def recording_verification(
    meetings: DataFrame,
    recordings: DataFrame,
    meeting_contacts: DataFrame,
    recording_contacts: DataFrame,
    before: str = "15 minutes",
    after: str = "30 minutes",
    default_length: str = "30 minutes",
    bucket_seconds: int = 3600,
) -> DataFrame:
    """Meetings proven by a completed recording inside the slot with a shared contact.

    The join is driven by (contact, time bin). Bins double in length from level to level; a
    slot stands in the one or two bins it reaches at the first level whose bins are as long as
    it is, a recording in one bin of every level that some slot stands at, and the exact slot
    test runs on the few survivors. So a slot of any length costs two rows, and a contact that
    sits on very many rows is split over its bins.
    """
    slots = meetings.where(F.col("start_time").isNotNull()).select(
        "activity_id", "meeting_id",
        (F.col("start_time") - F.expr(f"interval {before}")).alias("_lo"),
        (F.coalesce("end_time", F.col("start_time") + F.expr(f"interval {default_length}"))
         + F.expr(f"interval {after}")).alias("_hi"),
    ).where("_hi >= _lo")
    slots = slot_bins(slots, "_lo", "_hi", bucket_seconds)
    # A level for each doubling of the length: at most some fifty rows, whatever the data.
    levels = slots.select("_level").distinct()
    slots = slots.join(meeting_contacts.select("meeting_id", "contact_id").distinct(), "meeting_id")
    heard = (
        live_rows(recordings)
        .where((F.col("call_status") == "COMPLETED") & F.col("call_time").isNotNull())
        .select(F.col("id").alias("call_id"), "title", "call_time")
        .crossJoin(F.broadcast(levels))
        .withColumn("_bin", time_bin(F.col("call_time"), F.col("_level"), bucket_seconds))
        .join(recording_contacts.select("call_id", "contact_id").distinct(), "call_id")
    )
    return (
        slots.join(heard, ["contact_id", "_level", "_bin"])
        .where((F.col("call_time") >= F.col("_lo")) & (F.col("call_time") <= F.col("_hi")))
        .groupBy("activity_id")
        .agg(F.min(F.struct("call_time", "call_id", "title")).alias("_first"))
        .select(
            "activity_id",
            F.col("_first.call_id").alias("recording_id"),
            F.col("_first.title").alias("recording_title"),
            F.col("_first.call_time").alias("recording_time"),
        )
    )


def verified_unknown(activity: DataFrame, verification: DataFrame, start, end) -> DataFrame:
    """Per rep: unknown-outcome meetings that a recording proves."""
    return (
        activity.where(F.col("counts") & (F.col("channel") == "meeting") & between("activity_date", start, end))
        .where(outcome_is("unknown"))
        .join(verification.select("activity_id"), "activity_id", "left_semi")
        .groupBy("ca_id")
        .agg(F.count(F.lit(1)).alias("verified"))
    )
