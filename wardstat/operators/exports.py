"""Labelled views for dashboards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstat.functions.labels import AGE_EDGES_EXPORT, AGE_LABELS, cut, map_labels
from wardstat.functions.risk import risk_tier

# Fixed label texts.
GENDER_LABELS = {0: "Female", 1: "Male"}
INSULIN_LABELS = {0: "No Insulin", 1: "On Insulin"}
RETURN_LABELS = {0: "Not Readmitted", 1: "Readmitted <30d"}


def labelled_features(features: DataFrame) -> DataFrame:
    """The feature table with readable labels and the rule-based tier; no shuffle."""
    return features.withColumns(
        {
            "age_group": cut(F.col("age_mid"), AGE_EDGES_EXPORT, [f"{label} yrs" for label in AGE_LABELS]),
            "gender_label": map_labels(F.col("gender_enc"), GENDER_LABELS),
            "insulin_label": map_labels(F.col("on_insulin"), INSULIN_LABELS),
            "readmit_label": map_labels(F.col("readmitted_30"), RETURN_LABELS),
            "risk_tier": risk_tier(),
        }
    )


def predictions_export(preds: DataFrame, features: DataFrame, key: str = "encounter_id") -> DataFrame:
    """Logged predictions with five features of their encounter and a gender label."""
    shown = features.select(key, "age_mid", "gender_enc", "time_in_hospital", "num_medications", "total_visits")
    return preds.join(shown, key).withColumn("gender_label", map_labels(F.col("gender_enc"), GENDER_LABELS))
