"""Deal status of accounts: customer, open deal, recent churn or loss."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchgrid import vocab
from touchgrid.plans.meetings import live_rows
from touchgrid.plans.scorecard import d


def deal_stage_class(stages: DataFrame) -> DataFrame:
    """won / lost / open from the stage's own metadata; kind of loss from its labels."""
    closed = F.coalesce(F.col("is_closed"), F.lit(False))
    churn = F.coalesce(F.col("pipeline_label").ilike("%renew%"), F.lit(False)) | F.coalesce(
        F.col("stage_label").ilike("%churn%"), F.lit(False)
    )
    return stages.select(
        "pipeline_id", "pipeline_label", "stage_id", "stage_label",
        F.when(closed & (F.col("probability") >= 1), "won").when(closed, "lost").otherwise("open").alias("class"),
        F.when(closed & (F.col("probability") < 1), F.when(churn, "churn").otherwise("new_business")).alias("loss_kind"),
        F.col("pipeline_label").ilike("%expansion%").alias("is_am_pipeline"),
    )


def account_deal_status(
    deals: DataFrame, deal_companies: DataFrame, company_crosswalk: DataFrame, stage_class: DataFrame, as_of,
    churn_months: int = vocab.CHURN_SHIELD_MONTHS, lost_days: int = vocab.LOST_SHIELD_DAYS,
) -> DataFrame:
    """One row per account with deals: flags, ages and the highest-priority shield."""
    at = d(as_of)
    on_account = (
        live_rows(deals)
        .select(F.col("id").alias("deal_id"), "pipeline", "dealstage", "closedate", "createdate")
        .join(
            stage_class.select(
                F.col("pipeline_id").alias("pipeline"), F.col("stage_id").alias("dealstage"),
                "class", "loss_kind", "is_am_pipeline",
            ),
            ["pipeline", "dealstage"],
        )
        .join(deal_companies.select("deal_id", "company_id"), "deal_id")
        .join(company_crosswalk.select("company_id", F.col("resolved_company_id").alias("account_id")), "company_id")
    )
    won, is_open = F.col("class") == "won", F.col("class") == "open"
    ours = ~F.col("is_am_pipeline")
    per = on_account.groupBy("account_id").agg(
        F.bool_or(won).alias("has_won"),
        F.max(F.when(won, F.col("closedate"))).alias("last_won_at"),
        F.bool_or(is_open).alias("has_open_deal"),
        F.count_if(is_open).alias("open_deals"),
        F.min(F.when(is_open, F.col("createdate"))).alias("oldest_open_created"),
        F.max(F.when((F.col("loss_kind") == "churn") & ours, F.col("closedate"))).alias("last_churned_at"),
        F.max(F.when((F.col("loss_kind") == "new_business") & ours, F.col("closedate"))).alias("last_lost_at"),
    )
    superseded = F.col("last_churned_at").isNotNull() & (
        F.col("last_won_at").isNull() | (F.col("last_churned_at") >= F.col("last_won_at"))
    )
    per = per.withColumn("is_customer", F.col("has_won") & ~superseded)
    churn_from = F.add_months(at, -churn_months).cast("timestamp")
    lost_from = F.date_sub(at, lost_days).cast("timestamp")
    return per.select(
        "account_id", "is_customer", "has_open_deal", "open_deals",
        F.datediff(at, F.col("oldest_open_created").cast("date")).alias("oldest_open_deal_days"),
        F.col("last_churned_at").cast("date").alias("last_churned_date"),
        F.col("last_lost_at").cast("date").alias("last_lost_date"),
        F.when(F.col("is_customer"), "customer")
        .when(F.col("has_open_deal"), "open_deal")
        .when(F.col("last_churned_at") >= churn_from, "churned_recently")
        .when(F.col("last_lost_at") >= lost_from, "lost_recently")
        .alias("shield"),
    )
