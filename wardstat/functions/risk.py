"""Rule-based and probability-based risk."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed points per rule: (column, lowest value that earns them, points). Rules on one column add up.
RISK_POINTS = [
    ("total_visits", 5, 2),
    ("total_visits", 3, 1),
    ("num_medications", 20, 2),
    ("num_medications", 15, 1),
    ("time_in_hospital", 7, 1),
]


def risk_score() -> Column:
    """Points of an encounter, 0 to 8; an unknown value earns none."""
    score = F.when(F.col("a1c_high") == 1, 1).otherwise(0)
    for name, least, points in RISK_POINTS:
        score = score + F.when(F.col(name) >= least, points).otherwise(0)
    return score


def risk_tier() -> Column:
    """Tier of an encounter by its points."""
    score = risk_score()
    return F.when(score >= 5, "High Risk").when(score >= 3, "Medium Risk").otherwise("Low Risk")


def proba_tier(proba: Column) -> Column:
    """Tier of an unrounded probability."""
    return F.when(proba >= 0.5, "HIGH").when(proba >= 0.3, "MEDIUM").otherwise("LOW")


def flagged(proba: Column, threshold: float = 0.5) -> Column:
    """Scoring label: the threshold itself counts as positive."""
    return proba >= threshold
