"""Sharding by a two-pass external shuffle.

Pass one scatters records by seeded hashes into (shard, bucket) cells of about
`bucket_bytes`; pass two Fisher-Yates-shuffles each cell in memory and writes it. The law is
`key`: the shard is the one with the greatest seeded hash of (doc_id, shard), so doc_id and
the shard count decide alone, and one shard more takes rows only into itself.

Defined results: a null text counts as empty (size 1, crc 0); rows with a null doc_id share
one shard; repeated rows are all kept and share a cell; an empty table gives no rows and no
files; a cell's order depends on the seed and its rows only, so a task that runs again after
a lost executor writes the same cell again. Columns beside id and text are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchgrid.llm.common import shared_folder, table

SHARDS = 16
SEED = 20240229
#: Texts of one cell together; a cell is shuffled in one task's memory.
BUCKET_BYTES = 16 << 20
CELL = "doc_id long, text string, size long, text_crc32 long, shard int, bucket long, position long"


def shard_of(key: Column, shards: int, seed: int) -> Column:
    """The shard with the greatest hash of (key, shard)."""
    marks = [F.struct(F.xxhash64(F.lit(seed), key, F.lit(j)).alias("h"), F.lit(j).alias("j")) for j in range(shards)]
    return F.array_max(F.array(*marks))["j"]


def placed(docs: DataFrame, shards: int, seed: int, bucket_bytes: int) -> DataFrame:
    """Pass one's addresses: every record with size, crc, shard and bucket."""
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = docs.select(
        "doc_id", "text", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    total = sized.agg(F.sum("size").alias("n")).first()["n"] or 0
    buckets = max(1, -(-total // (shards * bucket_bytes)))
    return sized.withColumn("shard", shard_of(F.col("doc_id"), shards, seed)).withColumn(
        "bucket", F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "text"), F.lit(buckets))
    )


def fisher_yates(n: int, seed: int, shard: int, bucket: int) -> list[int]:
    """A permutation of range(n), drawn from the seed and the cell's number."""
    import numpy as np

    order = list(range(n))
    draws = np.random.default_rng([seed, shard, bucket]).integers(0, np.arange(n, 0, -1) if n else [])
    for i, d in zip(range(n - 1, 0, -1), draws.tolist(), strict=False):
        order[i], order[d] = order[d], order[i]
    return order


def shuffle_cells(cells: DataFrame, seed: int) -> DataFrame:
    """Pass two: each cell in its shuffled order, numbered by `position`."""

    def shuffle(cell):
        import pyarrow as pa
        import pyarrow.compute as pc

        by = [("doc_id", "ascending"), ("text_crc32", "ascending"), ("text", "ascending")]
        start = pc.sort_indices(cell, sort_keys=by)
        order = fisher_yates(len(start), seed, cell.column("shard")[0].as_py(), cell.column("bucket")[0].as_py())
        position = pa.array(range(len(order)), pa.int64())
        return cell.take(start.take(pa.array(order, pa.int64()))).append_column("position", position)

    return cells.groupBy("shard", "bucket").applyInArrow(shuffle, CELL)


def write_shards(
    docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """Write the shuffled texts below `path` (shard=../bucket=..) and return them as read back.

    The result has doc_id, text, size, text_crc32, shard, bucket, position and `slot`, the
    gapless place in the shard: cells in order, each cell in its shuffled order.
    """
    spark = docs.sparkSession
    cells = shuffle_cells(placed(docs, shards, seed, bucket_bytes), seed)
    ordered = cells.sortWithinPartitions("shard", "bucket", "position")
    ordered.write.partitionBy("shard", "bucket").option("compression", "zstd").parquet(path)
    return read_shards(spark, path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards below `path` with their slots."""
    stored = spark.read.schema(CELL).parquet(path)
    cells = stored.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = cells.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return stored.join(starts, ["shard", "bucket"]).withColumn("slot", F.col("start") + F.col("position")).drop("start")


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    stored = write_shards(docs, shared_folder(docs.sparkSession, "shards"))
    return stored.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
        shard_of(F.col("doc_id"), SHARDS + 1, SEED).alias("grown_shard"),
    )


QUERIES = {"op10_shards": op10_shards}
ORACLES: dict[str, str] = {}
