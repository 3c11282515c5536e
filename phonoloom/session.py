"""Sessions, table access and the folder that all executors share."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", app: str = "phonoloom", shuffle_partitions: int = 8) -> SparkSession:
    """A session with adaptive execution, UTC and Arrow, for tests and single-node work."""
    return (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("PHONOLOOM_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` below ``sf_dir`` (a file or a folder of part files)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints: the cluster's own setting, or one of our own where it is unset.

    Only a local session (tests, one machine) gets a folder of its own: executors of a cluster share no local disk, so a cluster
    without ``spark.checkpoint.dir`` is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    have = spark.sparkContext._jsc.sc().getCheckpointDir()
    if named:
        if have.isEmpty():
            spark.sparkContext.setCheckpointDir(named)
        return named
    if have.isEmpty():
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="phonoloom-checkpoint-"))
        have = spark.sparkContext._jsc.sc().getCheckpointDir()
    return have.get()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by a reliable checkpoint in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, by: str | None = None) -> DataFrame:
    """``df`` written once as Parquet below the shared folder (in a folder for each value of ``by``) and read back.

    Cheaper than a checkpoint where only some columns are read again, and it survives the loss of executors. The files last as
    long as the driver, or until ``release``: the DataFrames built on them are lazy.
    """
    spark = df.sparkSession
    where = f"{checkpoint_dir(spark)}/phonoloom-{uuid.uuid4().hex}"
    (df.write.partitionBy(by) if by else df.write).parquet(where)
    if not _kept:
        atexit.register(release)
    _kept.append((spark, where))
    return spark.read.schema(df.schema).parquet(where)


#: Folders written by ``stored`` and their sessions.
_kept: list[tuple[SparkSession, str]] = []


def release() -> None:
    """Deletes what ``stored`` wrote. Called when the driver ends; earlier only once no result is read any more."""
    while _kept:
        spark, where = _kept.pop()
        try:
            path = spark._jvm.org.apache.hadoop.fs.Path(where)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # noqa: BLE001 - the session has ended, and the folder belongs to its owner again
            continue


#: Bytes of a scan that are worth a partition of their own to work that is bound by CPU.
SPREAD_BYTES = 128 * 1024


def spread(df: DataFrame) -> DataFrame:
    """A scan for work that is bound by CPU: as it is if it has a split for each core, else spread evenly over two for each.

    Fewer splits than cores means less than ``spark.sql.files.maxPartitionBytes`` for each core, so what is shuffled is small.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    if splits >= cores:
        return df
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    wanted = min(2 * cores, 1 + size // SPREAD_BYTES)
    return df.repartition(wanted) if wanted > splits else df
