"""Checks on keys and progress counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count. No row means the key is unique."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def orphan_rows(child: DataFrame, parent: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``child`` whose key is set but absent from ``parent``.

    Of ``parent`` only distinct keys are shuffled, so a hot key there collapses in the map tasks; a hot key of ``child``
    is split by the adaptive planner, as the left side of an anti or semi join can be. The wide rows are picked by
    the missing keys, which that planner broadcasts where they are few.
    """
    key = list(key)
    missing = child.select(key).dropna().distinct().join(parent.select(key).distinct(), key, "left_anti")
    return child.join(missing, key, "left_semi")


def stage_counts(raw: DataFrame, cohort: DataFrame, features: DataFrame) -> DataFrame:
    """One row per load stage with its row and column count."""

    def count(stage: str, ordinal: int, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(ordinal).alias("ordinal"),
            F.lit(stage).alias("stage"),
            "n_rows",
            F.lit(len(df.columns)).alias("n_columns"),
        )

    return (
        count("raw", 1, raw)
        .unionByName(count("cohort", 2, cohort))
        .unionByName(count("features", 3, features))
    )
