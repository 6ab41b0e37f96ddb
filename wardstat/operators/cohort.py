"""Filters and the cohort."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardstat.sources.encounters import NA_TOKENS, normalise_nulls

# Fixed values of the cohort rules.
KEPT_GENDERS = ["Male", "Female"]
DEATH_OR_HOSPICE = [11, 13, 14, 19, 20, 21]


def keep_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Rows whose value is in the list; a null is not."""
    return df.filter(F.col(col).isin(list(values)))


def drop_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Rows whose value is not in the list; a null stays."""
    return df.filter(F.col(col).isNull() | ~F.col(col).isin(list(values)))


def first_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row with the lowest ``order`` per key; nulls order last and null keys form one group.

    Spark limits each map task to one row per key before the shuffle, so a key that holds a large
    share of all rows arrives as one row per map task. Equal ``order`` values are settled by the
    other columns, which makes a re-run task pick the same row.
    """
    others = [F.col(f"`{name}`").asc_nulls_last() for name in df.columns if name not in (key, order)]
    rows = Window.partitionBy(key).orderBy(F.col(order).asc_nulls_last(), *others)
    return df.withColumn("_nth", F.row_number().over(rows)).filter("_nth = 1").drop("_nth")


def known_rows(raw: DataFrame, na_tokens: Iterable[str] = NA_TOKENS, gender: str = "gender") -> DataFrame:
    """Cleaned rows of known gender.

    The gender filter runs on the stored text, where the scan can use it; cleaning cannot turn another text into a kept
    gender.
    """
    tokens = list(na_tokens)
    genders = [value for value in KEPT_GENDERS if value not in tokens]
    return normalise_nulls(keep_values(raw, gender, genders), tokens)


def build_cohort(
    raw: DataFrame,
    na_tokens: Iterable[str] = NA_TOKENS,
    key: str = "patient_nbr",
    order: str = "encounter_id",
    gender: str = "gender",
    disposition: str = "discharge_disposition_id",
) -> DataFrame:
    """First encounter of each patient of known gender, unless that one ended in death or hospice.

    The disposition is looked at last: a patient whose first encounter ended that way is not
    represented by a later one.
    """
    known = known_rows(raw, na_tokens, gender)
    return drop_values(first_per_key(known, key, order), disposition, DEATH_OR_HOSPICE)
