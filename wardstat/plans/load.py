"""From raw files to the stored cohort and feature table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from wardstat.operators.cohort import build_cohort
from wardstat.operators.features import engineer_features
from wardstat.operators.quality import duplicate_keys, stage_counts
from wardstat.session import stored
from wardstat.sources.encounters import NA_TOKENS, read_encounters
from wardstat.sources.schemas import FEATURES
from wardstat.sources.tables import export_csv, read_table, write_table


def load_features(spark: SparkSession, source: str, target: str, na_tokens: Iterable[str] = NA_TOKENS) -> DataFrame:
    """Read, clean, derive and store; returns the row count per stage.

    The raw files are parsed once, into a columnar table aside, whose rows are then counted for nothing. The cohort is
    stored aside too, and nothing is replaced before its key is known to be unique.
    """
    raw = stored(read_encounters(spark, source, na_tokens), "raw")
    cohort = stored(build_cohort(raw, na_tokens), "cohort")
    clash = duplicate_keys(cohort, ["encounter_id"]).take(1)
    if clash:
        raise ValueError(f"encounter_id is not unique, for example {clash[0]['encounter_id']}")
    write_table(cohort, f"{target}/patient_encounters")
    write_table(engineer_features(cohort), f"{target}/patient_features")
    features = read_table(spark, f"{target}/patient_features", FEATURES)
    export_csv(features, f"{target}/patient_features_clean_csv")
    return stage_counts(raw, cohort, features)
