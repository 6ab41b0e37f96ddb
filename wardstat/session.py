"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession


#: The JVM leaves methods above 8,000 bytes uncompiled; wider stages run faster in several methods.
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit", "8000"


def compile_in_parts(spark: SparkSession) -> None:
    """Have wide stages run in several methods, for sessions that others made without a limit of their own."""
    name, limit = METHOD_LIMIT
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, limit)


def session(app: str = "wardstat", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the operators are planned for; a cluster's own settings win."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config(*METHOD_LIMIT)
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Where that is unset, a folder in the session's warehouse, which executors share as well.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_scratch")
    return re.sub("^file:/+", "file:///", named)


def use_checkpoints(spark: SparkSession) -> None:
    """Make sure ``checkpoint()`` and the boosted-tree trainer have a shared folder to write to."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; nothing is created yet."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


#: Lets shuffle files go as soon as the query that wrote them ends.
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, for what several passes read.

    Its shuffle files go when it is written: nothing reads them again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_SHUFFLE_CLEANUP) if before is None else spark.conf.set(_SHUFFLE_CLEANUP, before)
    found = spark.read.schema(df.schema).parquet(path)
    found.stored_at = path
    return found


def discard(*tables: DataFrame) -> None:
    """Remove tables that ``stored`` wrote and nothing will read again; others, and None, are left alone."""
    for df in tables:
        path = getattr(df, "stored_at", None)
        if path:
            spark = df.sparkSession
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)
