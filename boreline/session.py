"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "boreline", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the library expects.

    ``shuffle_partitions`` is only the starting point: AQE coalesces small
    partitions and splits skewed ones at run time.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return use_utc(builder.getOrCreate())


def use_utc(spark: SparkSession) -> SparkSession:
    """Telemetry times are UTC without a zone, so epoch arithmetic needs a UTC session."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_local_root: str | None = None


def work_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; a
    cluster session must name one that every executor can reach.
    """
    global _local_root
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):  # local-cluster has executors of its own
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="boreline-")
    return _local_root


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{work_root(spark)}/boreline/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store, if it is there."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def clear_work(spark: SparkSession) -> None:
    """Delete everything this application has stored below the shared folder.

    To be called when a job has written its results: frames that the library
    returned before read from there.
    """
    remove_path(spark, f"{work_root(spark)}/boreline/{spark.sparkContext.applicationId}")


def stored(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Write a frame below the shared folder and read it back.

    Cuts the lineage of a result that several steps use, so it is computed
    once and an executor lost later costs only a reread.
    """
    spark = df.sparkSession
    path = work_path(spark, label)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
