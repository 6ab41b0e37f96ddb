"""Scoring a file of engineered rows."""

from __future__ import annotations

from pyspark.sql import SparkSession

from wardstat.operators.classifiers import load_model
from wardstat.operators.scoring import score
from wardstat.sources.encounters import read_feature_rows
from wardstat.sources.tables import export_csv


def score_file(spark: SparkSession, source: str, models: str, target: str, short: str = "gbt") -> None:
    """Read rows, score them with the stored model and write them with their risk."""
    export_csv(score(read_feature_rows(spark, source), load_model(spark, models, short)), target)
