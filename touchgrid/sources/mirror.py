"""A keyed mirror on files that is updated copy-on-write.

Rows are dealt to a fixed number of buckets by a hash of their key. A manifest lists, for one
number of the mirror, the folder of every bucket. An update reads and rewrites only the buckets
where a row really changes, writes a manifest that names the new folders beside the old ones, and
so publishes all of it at once; a batch that changes nothing publishes nothing. Readers of an
earlier number keep their files until retention lets that number go.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Buckets of a new mirror; the first manifest fixes the number for good.
BUCKETS = 64
#: Numbers whose files stay.
KEPT = 2
MANIFEST = "number long, buckets int, bucket int, folder string"


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def numbers(spark: SparkSession, base: str) -> list[int]:
    """The numbers a reader can ask for, oldest first; one counts once its manifest is whole."""
    found = [n for n in _children(spark, f"{base}/_manifests") if n.isdigit()]
    return sorted(int(n) for n in found if "_SUCCESS" in _children(spark, f"{base}/_manifests/{n}"))


def _manifest(spark: SparkSession, base: str, number: int) -> tuple[int, dict[int, str]]:
    """(buckets, folder of each): as many rows as the mirror has buckets."""
    rows = spark.read.schema(MANIFEST).json(f"{base}/_manifests/{number:012d}").collect()
    return rows[0]["buckets"], {r["bucket"]: r["folder"] for r in rows if r["folder"]}


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("mirror"), F.col(key)), F.lit(buckets)).cast("int")


def _folders(spark: SparkSession, base: str, folders: list[str], schema) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{base}/{f}" for f in folders])


def read_mirror(spark: SparkSession, base: str, schema, number: int | None = None) -> DataFrame:
    """The rows of one number of the mirror, the newest by default."""
    known = numbers(spark, base)
    if number is None:
        number = known[-1] if known else None
    if number is None:
        return spark.createDataFrame([], schema)
    if number not in known:
        raise FileNotFoundError(f"number {number} of {base} is not held")
    return _folders(spark, base, sorted(_manifest(spark, base, number)[1].values()), schema)


def _mark(columns: list[str]) -> Column:
    return F.xxhash64(*[F.col(c) for c in columns])


def _latest(rows: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """The last row of each key by `order`; of equal ones the greater hash, wherever it came from."""
    whole = F.struct(*[F.col(c) for c in rows.columns])
    return rows.groupBy(F.col(key).alias("_k")).agg(
        F.max_by(whole, F.struct(F.col(order), _mark(columns))).alias("_r")
    ).select("_r.*")


def upsert_mirror(
    batch: DataFrame, base: str, order: str, key: str = "id", buckets: int = BUCKETS, kept: int = KEPT
) -> int | None:
    """Take a batch into the mirror; the new number, or None where nothing changes.

    The latest row of each key by `order` stays, held or new; rows with a null key are not taken.
    """
    spark, columns = batch.sparkSession, batch.columns
    known = numbers(spark, base)
    held: dict[int, str] = {}
    if known:
        buckets, held = _manifest(spark, base, known[-1])
    newest = _latest(batch.where(F.col(key).isNotNull()), key, order, columns).withColumn("_bucket", _bucket(key, buckets))
    newest = newest.persist()
    asked = sorted(r[0] for r in newest.select("_bucket").distinct().collect())
    now = _folders(spark, base, [held[b] for b in asked if b in held], batch.schema).withColumn("_bucket", _bucket(key, buckets))
    merged = _latest(now.unionByName(newest), key, order, columns)
    # What is not held in just this form: such rows decide which buckets are written.
    before = now.select(F.col(key).alias("_k"), _mark(columns).alias("_m"))
    changed = merged.join(before, (F.col(key) == F.col("_k")) & (_mark(columns) == F.col("_m")), "left_anti")
    touched = sorted(r[0] for r in changed.select("_bucket").distinct().collect())
    if not touched:
        newest.unpersist()
        return None
    number = (known[-1] if known else 0) + 1
    folder = f"data/{number:012d}-{uuid.uuid4().hex[:8]}"
    out = merged.where(F.col("_bucket").isin(touched)).withColumn("bucket", F.col("_bucket")).drop("_bucket")
    out.repartition("bucket").write.partitionBy("bucket").parquet(f"{base}/{folder}")
    newest.unpersist()
    whole = held | {b: f"{folder}/bucket={b}" for b in touched}
    rows = [(number, buckets, b, whole.get(b)) for b in range(buckets)]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.json(f"{base}/_manifests/{number:012d}")
    retain(spark, base, kept)
    return number


def retain(spark: SparkSession, base: str, kept: int = KEPT) -> None:
    """Let go of all numbers but the last `kept`, and of the bucket folders that none of those names."""
    known = numbers(spark, base)
    stay = known[-kept:]
    named = {f for n in stay for f in _manifest(spark, base, n)[1].values()}
    for n in known[:-kept]:
        _delete(spark, f"{base}/_manifests/{n:012d}")
    # A folder of a number yet to be published is not one of these.
    for run in _children(spark, f"{base}/data"):
        if int(run.split("-")[0]) > stay[-1]:
            continue
        of_run = [c for c in _children(spark, f"{base}/data/{run}") if c.startswith("bucket=")]
        gone = [c for c in of_run if f"data/{run}/{c}" not in named]
        if len(gone) == len(of_run):
            _delete(spark, f"{base}/data/{run}")
        else:
            for c in gone:
                _delete(spark, f"{base}/data/{run}/{c}")
