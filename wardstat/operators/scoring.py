"""Batch scoring and the prediction log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstat.functions.risk import flagged, proba_tier
from wardstat.operators.classifiers import TrainedModel, with_probability
from wardstat.sources.tables import append_predictions


def with_score(df: DataFrame, proba: str, model_used: str) -> DataFrame:
    """Shown probability, flag, tier and model name for a probability column, which is dropped.

    Flag and tier look at the unrounded probability. Input columns of the same names are replaced.
    """
    p = F.col(proba)
    result = {
        "readmission_probability": F.round(p, 4),
        "predicted_readmission_<30d": flagged(p),
        "risk_tier": proba_tier(p),
        "model_used": F.upper(F.lit(model_used)),
    }
    kept = [f"`{name}`" for name in df.columns if name not in result and name != proba]
    return df.select(*kept, *[col.alias(name) for name, col in result.items()])


def score(df: DataFrame, model: TrainedModel) -> DataFrame:
    """Every input row with its return risk, in one pass."""
    return with_score(with_probability(df, model).drop(f"{model.short}_label"), f"{model.short}_proba", model.short)


def log_predictions(preds: DataFrame, model_name: str, path: str, run_id: str, run_timestamp, key: str = "encounter_id") -> None:
    """Write one model's predictions to the prediction log under its run."""
    run = preds.filter(F.col("model_name") == model_name).select(
        F.col(key).alias("encounter_id"), "model_name", "predicted_proba", "predicted_label", "actual_label"
    )
    append_predictions(run, path, run_id, run_timestamp)
