"""Incremental forms of the landing steps, as Structured Streaming jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from touchgrid import vocab
from touchgrid.sources.landing import append_absent
from touchgrid.sources.mirror import upsert_mirror


def _held(spark: SparkSession, path: str, schema) -> DataFrame:
    reader = spark.read.schema(schema)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    there = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
    return reader.parquet(path) if there else spark.createDataFrame([], schema)


def append_stream(stream: DataFrame, target: str, checkpoint: str, key: str = "id") -> StreamingQuery:
    """Land each micro-batch's unseen rows; replayed batches add nothing."""

    def write(batch: DataFrame, _epoch: int) -> None:
        held = _held(batch.sparkSession, target, batch.schema)
        append_absent(held, batch, key).write.mode("append").parquet(target)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upsert_stream(stream: DataFrame, base: str, checkpoint: str, order: str, key: str = "id") -> StreamingQuery:
    """Keep the latest state per key in a copy-on-write mirror; each batch that changes it publishes the next number.

    The held state is found through the manifests, so a new checkpoint continues where the
    last one stopped. A replayed batch meets its own rows and changes nothing, as of equal
    keys the later row by `order` wins, held or new, and equal orders are told apart by content.
    """

    def write(batch: DataFrame, _epoch: int) -> None:
        upsert_mirror(batch, base, order, key)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def fresh_rows(stream: DataFrame, ts: str, key: str = "id", days: int = vocab.LOOKBACK_DAYS) -> DataFrame:
    """Drop repeats that arrive within the late-data bound."""
    return stream.withWatermark(ts, f"{days} days").dropDuplicatesWithinWatermark([key])


def daily_channel_counts(stream: DataFrame, ts: str = "occurred_at", late: str = "5 days") -> DataFrame:
    """Counted rows per UTC day and channel."""
    return (
        stream.withWatermark(ts, late).where("counts").groupBy(F.window(ts, "1 day"), "channel")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("window.start").cast("date").alias("day"), "channel", "n")
    )


def dial_sessions(stream: DataFrame, ts: str = "start_date", gap_seconds: int = vocab.CALL_GROUP_GAP_SECONDS) -> DataFrame:
    """Dial pursuits per user and contact; a gap of exactly the limit starts a new one here."""
    return (
        stream.withWatermark(ts, "1 day").groupBy(F.session_window(ts, f"{gap_seconds} seconds"), "user_id", "contact_id")
        .agg(F.count(F.lit(1)).alias("dials"))
        .select("user_id", "contact_id", F.col("session_window.start").alias("first_dial"), "dials")
    )
