"""Stage tables: cut lineage by writing to the shared folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_own_folders: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``, or else the folder given to ``setCheckpointDir``. Where
    neither is set, a session on one machine (tests) gets one new folder per application; a cluster
    has no folder to fall back to, as its machines do not share their own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        app = spark.sparkContext.applicationId
        if app not in _own_folders:
            _own_folders[app] = tempfile.mkdtemp(prefix="pairmill-")
        folder = _own_folders[app]
    return folder.rstrip("/")


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/pairmill/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once and read it back, columnar and prunable.

    The table outlives lost executors, and every consumer starts from it
    instead of repeating the work behind ``df``.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Give a scan of few files as many tasks as there are cores.

    Text steps are bound by the processor, so moving the raw rows once pays off;
    scans that already have enough splits are left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
