"""Split, train, evaluate, store and log."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from wardstat.operators.classifiers import (
    TrainedModel,
    TrainingSettings,
    feature_importance,
    predict,
    save_model,
    train_models,
)
from wardstat.operators.metrics import best_model, confusion_matrix, model_metrics, pr_curve, roc_curve, rounded_metrics
from wardstat.operators.scoring import log_predictions
from wardstat.operators.split import stratified_split
from wardstat.session import stored
from wardstat.sources.tables import export_csv, read_table, write_table


@dataclass(frozen=True)
class TrainingRun:
    models: list[TrainedModel]
    predictions: DataFrame
    metrics: DataFrame
    importances: DataFrame
    best: str


def train_and_log(
    features: DataFrame,
    target: str,
    run_id: str,
    run_timestamp,
    settings: TrainingSettings = TrainingSettings(),
) -> TrainingRun:
    """Train the three models, store them, and log the best one's test predictions.

    The split is stored once for training and test. Test predictions of all models are written once; every metric reads that table instead of scoring again, and
    is computed once. Curves, confusion counts and importances are stored beside the metrics.
    """
    spark = features.sparkSession
    write_table(stratified_split(features, seed=settings.seed), f"{target}/split")
    split = read_table(spark, f"{target}/split")
    models = train_models(split.filter("split = 'train'"), settings=settings)
    for model in models:
        save_model(model, f"{target}/models")
    write_table(predict(models, split.filter("split = 'test'")), f"{target}/test_predictions")
    preds = read_table(spark, f"{target}/test_predictions")
    found = stored(model_metrics(preds).coalesce(1), "metrics")
    table = rounded_metrics(found)
    export_csv(table, f"{target}/metrics/model_metrics")
    best = best_model(found).first()["model_name"]
    log_predictions(preds, best, f"{target}/model_predictions", run_id, run_timestamp)
    trees = [feature_importance(spark, model) for model in models if model.short != "lr"]
    points = {
        "roc_points": roc_curve(preds),
        "pr_points": pr_curve(preds),
        "confusion_matrix": confusion_matrix(preds),
        "feature_importance": trees[0].unionByName(trees[1]),
    }
    for name, df in points.items():
        write_table(df, f"{target}/metrics/{name}")
    return TrainingRun(models, preds, table, read_table(spark, f"{target}/metrics/feature_importance"), best)
