"""Landing raw records: typed extraction, day windows, append, upsert, snapshots, run log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from touchgrid import vocab
from touchgrid.functions.text import has_warmup_marker
from touchgrid.plans.meetings import live_rows  # noqa: F401  (the live gate of a swept mirror)


def extract_record(df: DataFrame, payload: str, schema: str, optional: Sequence[str] = ()) -> DataFrame:
    """Typed columns of a JSON payload; '' in an optional text field is NULL."""
    parsed = df.withColumn("_p", F.from_json(payload, schema))
    names = [f.name for f in parsed.schema["_p"].dataType.fields]
    cols = [
        (F.nullif(F.col(f"_p.{n}"), F.lit("")) if n in optional else F.col(f"_p.{n}")).alias(n) for n in names
    ]
    return parsed.select(*df.columns, *cols)


def day_window(df: DataFrame, ts: str, start, end) -> DataFrame:
    """start <= ts < end; a NULL time is never in a window."""
    lo, hi = (F.lit(str(x)).cast("timestamp_ntz") for x in (start, end))
    return df.where((F.col(ts) >= lo) & (F.col(ts) < hi))


def lookback_days(as_of, days: int = vocab.LOOKBACK_DAYS) -> Column:
    """The days one scheduled run sweeps: yesterday and the ones before it."""
    last = F.date_sub(F.lit(str(as_of)).cast("date"), 1)
    return F.sequence(F.date_sub(last, days - 1), last)


def lookback_sweep(df: DataFrame, day: str, as_of, days: int = vocab.LOOKBACK_DAYS) -> DataFrame:
    last = F.date_sub(F.lit(str(as_of)).cast("date"), 1)
    return df.where((F.col(day) >= F.date_sub(last, days - 1)) & (F.col(day) <= last))


def split_warmup(emails: DataFrame, markers: Sequence[str] = vocab.WARMUP_SUBJECT_MARKERS) -> tuple[DataFrame, DataFrame]:
    """(kept rows, tally of the dropped ones)."""
    noise = has_warmup_marker("subject", markers)
    tally = emails.agg(F.count(F.lit(1)).alias("fetched"), F.count_if(noise).alias("warmup"))
    return emails.where(~noise), tally


def _first_of_batch(batch: DataFrame, key: str, arrival: str | None) -> DataFrame:
    order = F.col(arrival) if arrival else F.monotonically_increasing_id()
    row = F.struct(*[F.col(c) for c in batch.columns])
    placed = batch.select(F.col(key).alias("_k"), order.alias("_at"), row.alias("_r"))
    first = placed.groupBy("_k").agg(F.min_by("_r", F.struct("_at", F.xxhash64("_r"))).alias("_r"))
    return first.select("_r.*")


def append_absent(existing: DataFrame, batch: DataFrame, key: str = "id", arrival: str | None = None) -> DataFrame:
    """Batch rows whose key is not held yet: what an idempotent append writes.

    Of rows with one key the first by `arrival` is taken (by place in the batch if None).
    """
    return _first_of_batch(batch, key, arrival).join(existing.select(key), key, "left_anti")


def upsert(existing: DataFrame, batch: DataFrame, order: str, key: str = "id") -> DataFrame:
    """Latest state per key: the last batch row (by `order`) replaces the held one."""
    payload = F.struct(*[F.col(c) for c in existing.columns])
    last = batch.groupBy(key).agg(F.max_by(payload, F.col(order)).alias("_r")).select("_r.*")
    return existing.join(last.select(key), key, "left_anti").unionByName(last)


def watermark(mirror: DataFrame, modified: str, overlap_seconds: int = vocab.WATERMARK_OVERLAP_SECONDS) -> Column:
    """Newest modification held, minus the overlap; NULL when nothing is held."""
    return (mirror.select(F.max(modified)).scalar() - F.expr(f"interval {overlap_seconds} seconds"))


def changed_since(source: DataFrame, mirror: DataFrame, modified: str) -> DataFrame:
    """Source rows at or after the watermark; everything when nothing is held yet."""
    mark = watermark(mirror, modified)
    return source.where(mark.isNull() | (F.col(modified) >= mark))


def link_table(rows: DataFrame, a: str, b: str) -> DataFrame:
    """One row per association, keyed '<a>:<b>'."""
    return rows.select(F.concat_ws(":", F.col(a).cast("string"), F.col(b).cast("string")).alias("id"), a, b).dropDuplicates(["id"])


def merge_schemas(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both generations; columns one of them lacks are NULL."""
    return old.unionByName(new, allowMissingColumns=True)


def team_config(spark: SparkSession, path: str) -> DataFrame:
    """Team policy file (one JSON object with a `ca_teams` array) as a table."""
    raw = spark.read.schema("ca_teams array<struct<ca_team:string,parent_team:string>>").json(path, multiLine=True)
    return raw.select(F.inline("ca_teams")).select(
        F.col("ca_team").alias("ca_team_name"), F.col("parent_team").alias("parent_team_name")
    )


# ------------------------------------------------------------------ run log
RUN_COLUMNS = (
    "activity_date", "source", "object_type", "started_at", "finished_at", "rows_fetched", "rows_new",
    "rows_excluded", "exclusion_breakdown", "status",
)


def run_log(jobs: DataFrame) -> DataFrame:
    """One row per job; the excluded count is the sum of its breakdown."""
    total = F.aggregate(F.map_values("exclusion_breakdown"), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return jobs.withColumn("rows_excluded", F.coalesce(total, F.lit(0).cast("bigint"))).select(*RUN_COLUMNS)


def run_rollup(runs: DataFrame) -> DataFrame:
    return runs.groupBy("source", "object_type").agg(
        F.count(F.lit(1)).alias("runs"), F.sum("rows_fetched").alias("rows_fetched"), F.sum("rows_new").alias("rows_new"),
        F.sum("rows_excluded").alias("rows_excluded"), F.count_if(F.col("status") != "ok").alias("failed"),
    )


# ----------------------------------------------------------------- snapshots
POINTER = "number long, version string"


def publish(spark: SparkSession, base: str, version: str, tables: dict[str, DataFrame], kept: int | None = None) -> int:
    """Write all tables of one version, then move the pointer: readers see all or nothing. Its number.

    With `kept` only the versions of the last so many publications stay.
    """
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{base}/{version}/{name}")
    number = _point(spark, base, version)
    if kept is not None:
        _retain(spark, base, kept)
    return number


def rollback(spark: SparkSession, base: str, number: int) -> int:
    """Publish again what publication `number` named, for all tables at once; a reader of another keeps it."""
    return _point(spark, base, _marked(spark, base, number))


def _point(spark: SparkSession, base: str, version: str) -> int:
    latest = _pointer(spark, base)
    number = 1 + (latest["number"] if latest else 0)
    mark = spark.createDataFrame([(number, version)], POINTER).coalesce(1)
    mark.write.mode("append").json(f"{base}/_published")
    return number


def _marks(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.schema(POINTER).json(f"{base}/_published")


def _pointer(spark: SparkSession, base: str):
    """The latest publication (number, version), or None."""
    try:
        return _marks(spark, base).orderBy(F.desc("number"), F.desc("version")).first()
    except AnalysisException:
        return None


def _marked(spark: SparkSession, base: str, number: int) -> str:
    found = _marks(spark, base).where(F.col("number") == number).orderBy(F.desc("version")).first()
    if found is None or not _there(spark, f"{base}/{found['version']}"):
        raise FileNotFoundError(f"publication {number} of {base} is not held")
    return found["version"]


def _there(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _retain(spark: SparkSession, base: str, kept: int) -> None:
    """Delete the versions that none of the last `kept` publications names; one line for each publication is read."""
    marks = sorted((r["number"], r["version"]) for r in _marks(spark, base).collect())
    stay = {v for _, v in marks[-kept:]}
    for version in {v for _, v in marks} - stay:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/{version}")
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def current_version(spark: SparkSession, base: str) -> str | None:
    latest = _pointer(spark, base)
    return latest["version"] if latest else None


def read_published(spark: SparkSession, base: str, name: str, number: int | None = None) -> DataFrame:
    """A table of the version published last, or of publication `number`."""
    version = current_version(spark, base) if number is None else _marked(spark, base, number)
    if version is None:
        raise FileNotFoundError(f"nothing published under {base}")
    return spark.read.parquet(f"{base}/{version}/{name}")
