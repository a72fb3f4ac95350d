"""Session helpers shared by every job."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import touchgrid

# The few Python helpers that run inside tasks travel with the job, so executors do not
# need this package installed.
cloudpickle.register_pickle_by_value(touchgrid)


def build(app: str = "touchgrid", cores: str = "*", shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings this library relies on (UTC days, AQE)."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if cores:
        b = b.master(f"local[{cores}]")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Days are UTC days, whatever the cluster's default zone is."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; fall back only in local mode."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        sc.setCheckpointDir(named)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running iterative jobs")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss, keeps iterative plans short."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """The rows written once as compressed columns; later steps read only the columns they use."""
    return Scratch(df.sparkSession, "step").write(df)


#: Whether Spark deletes the shuffle files of a job that has ended.
SPENT_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Intermediate tables of an iterative job, written below the shared checkpoint folder.

    Unlike a checkpoint, a table read back has the size of its files, and not an estimate that
    the joins of every round multiply; and a spent one can be deleted. The shuffle files behind it
    go as soon as it is written.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        ensure_checkpoint_dir(spark)
        self.spark = spark
        self.folder = f"{spark.sparkContext.getCheckpointDir()}/{purpose}-{uuid.uuid4().hex}"
        self.paths: dict[int, str] = {}

    def write(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{len(self.paths)}-{uuid.uuid4().hex[:8]}"
        before = self.spark.conf.get(SPENT_SHUFFLES, "false")
        self.spark.conf.set(SPENT_SHUFFLES, "true")
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            self.spark.conf.set(SPENT_SHUFFLES, before)
        back = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(back)] = path
        return back

    def drop(self, *spent: DataFrame) -> None:
        """Delete tables that nothing reads any more."""
        for df in spent:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(df)))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
