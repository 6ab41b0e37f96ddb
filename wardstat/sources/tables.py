"""Parquet tables and CSV exports."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardstat.sources.schemas import METRICS

log = logging.getLogger(__name__)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at the path; asks its file system for that one entry."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(target)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A stored table; pass its schema to skip reading file footers for it."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def write_table(df: DataFrame, path: str) -> None:
    """Replace the table at ``path``."""
    df.write.mode("overwrite").parquet(path)


def append_predictions(df: DataFrame, path: str, run_id: str, run_timestamp=None) -> None:
    """Add one run to the prediction log; the same run written again replaces itself only."""
    run = df.withColumn("run_id", F.lit(run_id))
    if run_timestamp is not None:
        run = run.withColumn("run_timestamp", F.lit(run_timestamp).cast("timestamp"))
    (
        run.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .parquet(path)
    )


# Quotes are doubled inside quoted cells and blanks around a value belong to it, for reading and writing.
CSV_FORMAT = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def export_csv(df: DataFrame, path: str) -> None:
    """Replace the folder at ``path`` by CSV part files, each with a header line.

    Cells with line breaks are quoted; who reads them back must say so (``multi_line``).
    """
    df.write.mode("overwrite").options(**CSV_FORMAT).csv(path)


def export_metrics(spark: SparkSession, source: str, target: str) -> DataFrame | None:
    """Copy the metrics file; where there is none yet, say so and do nothing."""
    if not path_exists(spark, source):
        log.warning("no metrics at %s: train the models first", source)
        return None
    metrics = spark.read.schema(METRICS).options(**CSV_FORMAT, enforceSchema=False).csv(source)
    export_csv(metrics.coalesce(1), target)
    return metrics
