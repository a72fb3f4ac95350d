"""Small helpers the operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchgrid.session import ensure_checkpoint_dir, prepare

#: Rows of an Arrow batch; with whole texts in them a batch stays at a few MB.
BATCH_ROWS = 1000
#: Bytes of an Arrow batch of packed blocks.
BATCH_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the corpus, read by Spark."""
    spark = prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the cluster's shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{purpose}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of `shared_folder` that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def block_batches(blocks: DataFrame) -> DataFrame:
    """Rows that hold packed blocks, for a Python step: batches are bounded by bytes, not by rows alone."""
    blocks.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return blocks


def stage_table(df: DataFrame, purpose: str) -> DataFrame:
    """Write a small intermediate table into the shared folder and read it back."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_words(text: Column) -> Column:
    """Lower-cased words between ASCII white space; no empty strings."""
    plain = F.lower(F.coalesce(text, F.lit("")))
    return F.filter(F.split(plain, "[ \\t-\\r]+"), lambda w: w != "")


def letter_words(text: Column) -> Column:
    """Lower-cased runs of letters and digits, whatever stands between them."""
    plain = F.lower(F.coalesce(text, F.lit("")))
    return F.filter(F.split(plain, "[^\\p{L}\\p{N}]+"), lambda w: w != "")
