"""The four dashboard exports."""

from __future__ import annotations

import logging

from pyspark.sql import SparkSession

from wardstat.operators.exports import labelled_features, predictions_export
from wardstat.operators.segments import segment_kpis
from wardstat.sources.schemas import FEATURES, PREDICTIONS
from wardstat.sources.tables import export_csv, export_metrics, path_exists, read_table

log = logging.getLogger(__name__)


def export_all(spark: SparkSession, tables: str, target: str) -> None:
    """Write features, KPIs, metrics and predictions as CSV; the last two only if a model was trained."""
    features = read_table(spark, f"{tables}/patient_features", FEATURES)
    export_csv(labelled_features(features), f"{target}/patient_features")
    export_csv(segment_kpis(features, "export").coalesce(1), f"{target}/kpis")
    export_metrics(spark, f"{tables}/metrics/model_metrics", f"{target}/model_metrics")
    logged = f"{tables}/model_predictions"
    if path_exists(spark, logged):
        export_csv(predictions_export(read_table(spark, logged, PREDICTIONS), features), f"{target}/predictions")
    else:
        log.warning("no predictions at %s: train the models first", logged)
