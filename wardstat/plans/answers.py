"""The eight questions, the summaries, and the stored KPI table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardstat.operators import segments, stats
from wardstat.sources.schemas import FEATURES, PREDICTIONS
from wardstat.sources.tables import path_exists, read_table, write_table


def answers(features: DataFrame, preds: DataFrame | None = None) -> dict[str, DataFrame]:
    """The analysis questions over the feature table and, if given, the prediction log."""
    found = {
        "overall": segments.overall_rates(features),
        "by_age": segments.rate_by_age(features),
        "high_risk": segments.high_risk_profile(features),
        "by_insulin": segments.rate_by_insulin(features),
        "by_a1c": segments.rate_by_a1c(features),
        "by_diagnosis": segments.rate_by_diagnosis(features),
        "kpis": segments.with_kpi_id(segments.segment_kpis(features, "sql")),
    }
    if preds is not None:
        found["prediction_accuracy"] = segments.prediction_accuracy(preds)
    return found


def summaries(features: DataFrame) -> dict[str, DataFrame]:
    """The points behind the six exploratory charts."""
    return {
        "outcome_distribution": stats.outcome_distribution(features),
        "age_rate_points": stats.age_rate_points(features),
        "stay_histogram": stats.histogram_density(features),
        "correlation_pairs": stats.correlation_pairs(features),
        "insulin_effect": segments.insulin_effect(features),
        "medication_boxplot": stats.boxplot_stats(features),
    }


def refresh_summaries(features: DataFrame, folder: str) -> None:
    """Replace the stored points of the six charts, a table each."""
    for name, df in summaries(features).items():
        write_table(df.coalesce(1), f"{folder}/{name}")


def stored_answers(spark: SparkSession, tables: str) -> dict[str, DataFrame]:
    """The questions over the stored feature table and, once a model is trained, the stored prediction log."""
    logged = f"{tables}/model_predictions"
    preds = read_table(spark, logged, PREDICTIONS) if path_exists(spark, logged) else None
    return answers(read_table(spark, f"{tables}/patient_features", FEATURES), preds)


def refresh_kpis(features: DataFrame, path: str) -> None:
    """Replace the stored KPI table; its dozen rows go to one file."""
    write_table(segments.with_kpi_id(segments.segment_kpis(features, "sql")).coalesce(1), path)
