"""New versus follow-up meetings online: the rolling window as a stream.

Two stateful steps, with the table of the first one's days between them. The first keeps, for
each account and day, the first meeting and the count, with map-side combine, and lets a day go
once the watermark has passed it; so the second meets every day of an account once, in order
across batches, however many meetings it has, and its state is one date an account: the last
day that opened a window. Each has a checkpoint of its own and continues where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from touchgrid import vocab
from touchgrid.operators.keyed import nulls_last, order_struct

DAYS = "account_id string, activity_date date, activity_id string, meetings long"
OPENED = f"{DAYS}, opened boolean"


def account_days(meetings: DataFrame, late: str = "5 days") -> DataFrame:
    """(account_id, activity_date, activity_id, meetings) of a stream of counted meetings.

    `meetings` has activity_id, account_id, activity_date and occurred_at. A day comes out once,
    when the newest day seen lies more than `late` after it; what comes later still is dropped.
    """
    order = order_struct([*nulls_last("occurred_at"), F.col("activity_id")])
    timed = meetings.withColumn("_at", F.col("activity_date").cast("timestamp")).withWatermark("_at", late)
    days = timed.where("account_id IS NOT NULL").groupBy("account_id", F.window("_at", "1 day").alias("_day"))
    return days.agg(F.min_by("activity_id", order).alias("activity_id"), F.count(F.lit(1)).alias("meetings")).select(
        "account_id", F.col("_day.start").cast("date").alias("activity_date"), "activity_id", "meetings"
    )


def opened_days(days: DataFrame, window_days: int = vocab.NEW_MEETING_DAYS) -> DataFrame:
    """`days` of `account_days` with `opened`: more than `window_days` after the last day that did."""

    def fold(key, parts, state):
        import datetime as dt

        import pandas as pd

        rows = pd.concat(list(parts)).sort_values("activity_date")
        last = dt.date.fromordinal(state.get[0]) if state.exists else None
        opened = []
        for day in rows["activity_date"]:
            opened.append(last is None or (day - last).days > window_days)
            last = day if opened[-1] else last
        state.update((last.toordinal(),))
        yield rows.assign(account_id=key[0], opened=opened)[["account_id", "activity_date", "activity_id", "meetings", "opened"]]

    return days.groupBy("account_id").applyInPandasWithState(fold, OPENED, "last int", "append", GroupStateTimeout.NoTimeout)


def follow_meetings(
    meetings: DataFrame, base: str, late: str = "5 days", window_days: int = vocab.NEW_MEETING_DAYS
) -> DataFrame:
    """Take what a stream of meetings newly holds; the account days settled so far, as below `base`/opened.

    Of an opened day `activity_id` is the new meeting.
    """
    spark = meetings.sparkSession

    def landed(stream: DataFrame, name: str) -> str:
        path = f"{base}/{name}"
        writer = stream.writeStream.format("parquet").option("path", path).outputMode("append")
        writer.option("checkpointLocation", f"{base}/_{name}").trigger(availableNow=True).start().awaitTermination()
        return path

    settled = landed(account_days(meetings, late), "days")
    # Days come in order from batch to batch, so all that is new can be one batch here.
    days = spark.readStream.schema(DAYS).parquet(settled)
    return spark.read.schema(OPENED).parquet(landed(opened_days(days, window_days), "opened"))


def flags_from_days(meetings: DataFrame, days: DataFrame) -> DataFrame:
    """(activity_id, account_id, bucket) of meetings whose days are settled, from what the stream wrote.

    Meetings of an account whose day is still open are not there yet; those without one always are.
    """
    settled = days.select("account_id", "activity_date", F.when(F.col("opened"), F.col("activity_id")).alias("_new"))
    named = meetings.where("account_id IS NOT NULL").join(settled, ["account_id", "activity_date"])
    bucket = F.when(F.col("activity_id").eqNullSafe(F.col("_new")), "new_stakeholder").otherwise("follow_up")
    none = meetings.where("account_id IS NULL").select("activity_id", "account_id", F.lit("no_account").alias("bucket"))
    return named.select("activity_id", "account_id", bucket.alias("bucket")).unionByName(none)
