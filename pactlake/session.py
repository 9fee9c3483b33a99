"""Session construction and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_local_folder: str | None = None


def build_session(master: str | None = None, app: str = "pactlake", **conf: str) -> SparkSession:
    """A session with the settings the jobs are written for; `conf` keys use __ for dots.

    Shuffle partitions are left to the cluster: AQE coalesces them to the advisory size at run time,
    splits skewed join partitions and broadcasts a side only when its measured size is small.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    global _local_folder
    if _local_folder is None:  # one machine, one process: its own folder, gone with it
        _local_folder = tempfile.mkdtemp(prefix="pactlake-")
        atexit.register(shutil.rmtree, _local_folder, ignore_errors=True)
    return _local_folder


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A folder of its own in the application's part of the shared folder (see `release`)."""
    return f"{_application_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Delete what this application has stored in fresh folders and with `materialize`; frames read from there are no longer
    readable. To be called when the application's results are written elsewhere."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_application_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Cut the lineage of `df` through a Parquet table in the application's part of the shared folder (see `release`)."""
    return materialize_counted(df, purpose)[0]


def materialize_counted(df: DataFrame, purpose: str) -> tuple[DataFrame, int]:
    """`materialize`, and the number of rows, observed while writing."""
    folder = fresh_folder(df.sparkSession, purpose)
    observed = Observation()
    df.observe(observed, F.count(F.lit(1)).alias("rows")).write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder), observed.get["rows"]
