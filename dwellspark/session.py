"""Session settings and the cutting of lineage."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Capturing the Python call site of every column makes plans slow to build.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}
#: Setting of a session whose inputs are single small files: partitions to deal fact tables to.
SCAN_PARTITIONS = "spark.dwellspark.scanPartitions"
_SPLIT_HOT = "spark.sql.adaptive.forceOptimizeSkewedJoin"
_FREE_EXCHANGES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cpus: int | str = 8, name: str = "dwellspark", **extra: str) -> SparkSession:
    """Session for tests and the benchmark; on a cluster the session comes from outside."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(cpus),
        SCAN_PARTITIONS: str(cpus),
        # Small shuffles still use all cores; on a cluster the default fits.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
        "spark.driver.memory": os.environ.get("SPARK_DRIVER_MEMORY", "12g"),
        **{k.replace("__", "."): v for k, v in extra.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def split_hot_keys(spark: SparkSession) -> None:
    """Split skewed joins also where what follows then needs an exchange of its own; a session's own choice stays."""
    if spark.conf.get(_SPLIT_HOT, None) is None:
        spark.conf.set(_SPLIT_HOT, "true")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named in spark.checkpoint.dir; make one only for a local run."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        context.setCheckpointDir(shared)
    elif re.fullmatch(r"local(\[.*\])?", context.master):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="dwellspark-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def run_folder(spark: SparkSession) -> str:
    """A folder of this application in the shared one, for tables of a run."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/run-{spark.sparkContext.applicationId}"


def materialise(df: DataFrame) -> DataFrame:
    """Write the rows once as Parquet to shared storage and read them from there afterwards.

    Readers get only the columns they use, and their filters reach the files. The files stay until
    `release` or the end of the shared folder; the exchanges behind them go once they are written.
    """
    spark = df.sparkSession
    path = f"{run_folder(spark)}/{uuid.uuid4().hex}"
    before = spark.conf.get(_FREE_EXCHANGES, None)
    spark.conf.set(_FREE_EXCHANGES, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_FREE_EXCHANGES)
        else:
            spark.conf.set(_FREE_EXCHANGES, before)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete what `materialise` has written for this application; its tables cannot be read any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
