"""Account and contact drill-downs, owned-account coverage, neglect lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchgrid import vocab
from touchgrid.functions.text import churn_label, display_name, lost_label, rate
from touchgrid.plans.scorecard import between

TOP_TIERS = ("Tier 0", "Tier 1")
RANKED_TIERS = ("Tier 0", "Tier 1", "Tier 2", "Tier 3", "Tier 4")


def touches(activity_flat: DataFrame, start, end) -> DataFrame:
    """Counted non-meeting activity of a rep inside the window."""
    return activity_flat.where(
        F.col("counts")
        & (F.col("channel") != "meeting")
        & F.col("ca_id").isNotNull()
        & between("activity_date", start, end)
    )


def _channel_counts(*names: str) -> list[Column]:
    ch = F.col("channel")
    tests = {
        "auto_email": ch == "auto_email",
        "manual_email": ch == "manual_email",
        "emails": ch.isin(*vocab.EMAIL_CHANNELS),
        "calls": ch == "call",
        "linkedin": ch.startswith("li_"),
        "inbound_replies": ch == "inbound_email",
        "other_outreach": ch.isin(*vocab.OTHER_CHANNELS),
    }
    return [F.count_if(tests[n]).alias(n) for n in names]


def rep_account_drilldown(activity_flat: DataFrame, dim_account: DataFrame, start, end) -> DataFrame:
    """Touches per rep and account; the no-account rows keep a row of their own."""
    owners = dim_account.select(
        F.col("account_id").alias("company_id"), F.col("owner_rep_id").alias("owned_by_rep_id")
    )
    per = (
        touches(activity_flat, start, end)
        .groupBy("ca_id", "ca_name", "company_id", "account_name", "account_domain", "account_icp_tier_validated")
        .agg(
            F.count(F.lit(1)).alias("touchpoints"),
            F.count_distinct("contact_id").alias("people_touched"),
            *_channel_counts("auto_email", "manual_email", "calls", "linkedin", "inbound_replies", "other_outreach"),
            F.min("activity_date").alias("first_touch"),
            F.max("activity_date").alias("last_touch"),
        )
    )
    return per.join(owners, "company_id", "left").select(
        "ca_id", "ca_name",
        F.col("company_id").alias("account_id"),
        F.coalesce("account_name", F.lit(vocab.NO_ACCOUNT)).alias("account_name"),
        "account_domain",
        F.col("account_icp_tier_validated").alias("icp_tier"),
        "owned_by_rep_id",
        (F.col("owned_by_rep_id") == F.col("ca_id")).alias("owned_by_this_rep"),
        "touchpoints", "people_touched", "auto_email", "manual_email", "calls", "linkedin",
        "inbound_replies", "other_outreach", "first_touch", "last_touch",
    )


def account_contact_drilldown(activity_flat: DataFrame, start, end) -> DataFrame:
    """Touches per rep, account and person; rows without a person are left out."""
    keys = [
        "ca_id", "ca_name", "company_id", "account_name", "account_icp_tier_validated", "contact_id",
        "contact_firstname", "contact_lastname", "contact_email", "contact_jobtitle",
    ]
    return (
        touches(activity_flat, start, end)
        .where(F.col("contact_id").isNotNull())
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("touchpoints"),
            *_channel_counts("emails", "calls", "linkedin", "inbound_replies"),
            F.max("activity_date").alias("last_touch"),
        )
        .select(
            "ca_id", "ca_name",
            F.col("company_id").alias("account_id"),
            F.coalesce("account_name", F.lit(vocab.NO_ACCOUNT)).alias("account_name"),
            F.col("account_icp_tier_validated").alias("icp_tier"),
            "contact_id",
            display_name("contact_firstname", "contact_lastname").alias("contact_name"),
            "contact_email",
            F.col("contact_jobtitle").alias("jobtitle"),
            "touchpoints", "emails", "calls", "linkedin", "inbound_replies", "last_touch",
        )
    )


def owned_account_coverage(activity: DataFrame, dim_account: DataFrame, dim_ca: DataFrame, start, end) -> DataFrame:
    """Every rep-owned account with owner and team touches, untouched ones included.

    Touches are combined per (account, rep) first; the account join then sees one row
    per pair, so an account that draws a large share of all activity stays cheap.
    """
    pairs = (
        touches(activity, start, end)
        .where(F.col("company_id").isNotNull())
        .groupBy(F.col("company_id").alias("account_id"), "ca_id")
        .agg(F.count(F.lit(1)).alias("n"), F.max("activity_date").alias("last"))
    )
    owned = dim_account.join(
        dim_ca.select(F.col("ca_id").alias("owner_rep_id"), F.col("name").alias("owner_name")), "owner_rep_id"
    )
    by_owner = F.col("ca_id") == F.col("owner_rep_id")
    keys = ["owner_rep_id", "owner_name", "account_id", "name", "domain", "icp_tier_validated", "vertical"]
    return (
        owned.select(*keys)
        .join(pairs, "account_id", "left")
        .groupBy(*keys)
        .agg(
            F.coalesce(F.sum(F.when(by_owner, F.col("n"))), F.lit(0)).alias("owner_touches"),
            F.max(F.when(by_owner, F.col("last"))).alias("owner_last_touch"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("team_touches"),
            F.max("last").alias("team_last_touch"),
            F.count("ca_id").alias("team_reps"),
        )
        .select(
            F.col("owner_rep_id").alias("owner_ca_id"), "owner_name", "account_id",
            F.col("name").alias("account_name"), F.col("domain").alias("account_domain"),
            F.col("icp_tier_validated").alias("icp_tier"), "vertical",
            "owner_touches", "owner_last_touch", "team_touches", "team_last_touch", "team_reps",
        )
    )


def owned_summary(coverage: DataFrame) -> DataFrame:
    """Per owner: owned, touched, untouched, rate, untouched top tiers; worst first."""
    touched = F.col("owner_touches") > 0
    return (
        coverage.groupBy("owner_name")
        .agg(
            F.count(F.lit(1)).alias("owned"),
            F.count_if(touched).alias("touched"),
            F.count_if(~touched & F.col("icp_tier").isin(*TOP_TIERS)).alias("top_untouched"),
        )
        .withColumn("untouched", F.col("owned") - F.col("touched"))
        .withColumn("coverage_pct", rate(F.col("touched"), F.col("owned")))
        .orderBy(F.asc_nulls_last(F.col("touched") / F.col("owned")), "owner_name")
    )


def tier_rank(c: str = "icp_tier") -> Column:
    out = F.lit(9)
    for i in reversed(range(len(RANKED_TIERS))):
        out = F.when(F.col(c) == RANKED_TIERS[i], i).otherwise(out)
    return out


def neglect_order(coverage: DataFrame) -> DataFrame:
    """Owned accounts, best tier first, least touched first."""
    return coverage.withColumn("tier_rank", tier_rank()).orderBy("tier_rank", "team_touches", "owner_name")


def coverage_order(coverage: DataFrame) -> DataFrame:
    """Owned accounts by owner, tier (unknown tier last), touches, name."""
    return coverage.orderBy("owner_name", F.asc_nulls_last("icp_tier"), "team_touches", "account_name")


def depth_buckets(rep_accounts: DataFrame) -> DataFrame:
    """How concentrated a rep's touches are: matched accounts per touch bucket."""
    t = F.col("touchpoints")
    bucket = (
        F.when(t <= 9, "1-9").when(t <= 24, "10-24").when(t <= 49, "25-49").when(t <= 99, "50-99").otherwise("100+")
    )
    return (
        rep_accounts.where(F.col("account_name") != vocab.NO_ACCOUNT)
        .groupBy("ca_name", bucket.alias("bucket"))
        .agg(F.count(F.lit(1)).alias("accounts"))
    )


def shielded_coverage(coverage: DataFrame, deal_status: DataFrame) -> DataFrame:
    """Coverage rows with the deal label of the account, where it has one."""
    return coverage.join(
        deal_status.select("account_id", "shield", "oldest_open_deal_days", "last_churned_date", "last_lost_date"),
        "account_id", "left",
    )


def workable_coverage(coverage: DataFrame, deal_status: DataFrame) -> DataFrame:
    """Coverage over accounts no deal shields."""
    return (
        shielded_coverage(coverage, deal_status)
        .where(F.col("shield").isNull())
        .groupBy("owner_ca_id", "owner_name")
        .agg(F.count(F.lit(1)).alias("workable"), F.count_if(F.col("owner_touches") > 0).alias("touched"))
        .withColumn("workable_pct", rate(F.col("touched"), F.col("workable")))
    )


def shield_label() -> Column:
    days = F.col("oldest_open_deal_days").cast("string")
    aged = F.coalesce(F.concat(F.lit("Open deal ("), days, F.lit("d old)")), F.lit("Open deal"))
    return (
        F.when(F.col("shield").isNull(), "Neglected")
        .when(F.col("shield") == "customer", "Customer")
        .when(F.col("shield") == "open_deal", aged)
        .when(F.col("shield") == "churned_recently", churn_label("last_churned_date"))
        .otherwise(lost_label("last_lost_date"))
    )


def neglected_top_tier(coverage: DataFrame, deal_status: DataFrame) -> DataFrame:
    """Top-tier owned accounts nobody touched, each with the label that explains it."""
    return (
        shielded_coverage(coverage, deal_status)
        .where(F.col("icp_tier").isin(*TOP_TIERS) & (F.col("team_touches") == 0))
        .withColumn("status", shield_label())
        .select("owner_name", "account_id", "account_name", "icp_tier", "vertical", "shield", "status")
    )


def neglected_counts(neglected: DataFrame) -> DataFrame:
    """Unshielded untouched accounts per owner and tier."""
    return (
        neglected.where(F.col("shield").isNull())
        .groupBy("owner_name", "icp_tier")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def share_of_total(rep_accounts: DataFrame) -> DataFrame:
    """Each account's share of its rep's touches, the no-account rows in the total."""
    totals = rep_accounts.groupBy("ca_id").agg(F.sum("touchpoints").alias("rep_touches"))
    return (
        rep_accounts.join(totals, "ca_id")
        .where(F.col("account_name") != vocab.NO_ACCOUNT)
        .withColumn("share_pct", rate(F.col("touchpoints"), F.col("rep_touches")))
        .select("ca_id", "ca_name", "account_id", "account_name", "touchpoints", "rep_touches", "share_pct")
    )


def top_accounts(activity_flat: DataFrame, dim_account: DataFrame, ca_name: str, start, end, n: int = 15) -> DataFrame:
    """A rep's most touched matched accounts."""
    return (
        rep_account_drilldown(activity_flat.where(F.col("ca_name") == ca_name), dim_account, start, end)
        .where(F.col("account_name") != vocab.NO_ACCOUNT)
        .orderBy(F.desc("touchpoints"), "account_name")
        .limit(n)
    )
