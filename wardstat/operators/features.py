"""The feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from wardstat.functions.clinical import (
    A1C_HIGH,
    ICD9_CIRCULATORY,
    ICD9_DIABETES,
    ICD9_RESPIRATORY,
    INSULIN_IN_USE,
    age_bounds,
    age_midpoint,
    differs,
    flag,
    icd9_number,
    in_ranges,
)
from wardstat.functions.numbers import required, whole_number
from wardstat.session import compile_in_parts
from wardstat.sources.schemas import COUNTS, FEATURES


def _count(df: DataFrame, name: str, kind: str, strict: bool) -> Column:
    col = F.col(name)
    number = whole_number(col, kind) if isinstance(df.schema[name].dataType, StringType) else col.try_cast(kind)
    return required(number, name) if strict else number


def cast_counts(df: DataFrame, cols: Sequence[str] = tuple(COUNTS), strict: bool = True) -> DataFrame:
    """Named columns as whole numbers. Strict: a null or junk stops the job; else it becomes null."""
    return df.withColumns({name: _count(df, name, "int", strict) for name in cols})


def engineer_features(encounters: DataFrame, strict: bool = True) -> DataFrame:
    """The 24 feature columns of each encounter, without a shuffle.

    The parsed diagnosis code and age bounds feed several rules, so they are columns of a projection
    below: as plain sub-expressions they would be parsed again for every rule. All rules in one method are more than the
    JVM compiles, so the session gets a limit if it has none.
    """
    compile_in_parts(encounters.sparkSession)
    parsed = encounters.withColumns({"_code": icd9_number(F.col("diag_1")), "_ages": age_bounds(F.col("age"))})
    ids = {name: _count(encounters, name, "bigint", strict) for name in ("encounter_id", "patient_nbr")}
    counts = {name: _count(encounters, name, "int", strict) for name in COUNTS}
    visits = counts["number_outpatient"] + counts["number_emergency"] + counts["number_inpatient"]
    code = F.col("_code")
    rules = {
        **ids,
        **counts,
        "age_mid": age_midpoint(F.col("_ages")),
        "gender_enc": flag(F.col("gender") == "Male"),
        "total_visits": visits,
        "on_insulin": flag(F.col("insulin").isin(INSULIN_IN_USE)),
        "change_meds": flag(F.col("change") == "Ch"),
        "on_diabetes_med": flag(F.col("diabetesMed") == "Yes"),
        "has_a1c_result": differs(F.col("A1Cresult"), "None"),
        "a1c_high": flag(F.col("A1Cresult").isin(A1C_HIGH)),
        "diag_diabetes": in_ranges(code, ICD9_DIABETES),
        "diag_circulatory": in_ranges(code, ICD9_CIRCULATORY),
        "diag_respiratory": in_ranges(code, ICD9_RESPIRATORY),
        "specialty_internal_med": flag(F.lower("medical_specialty").contains("internal")),
        "readmitted_30": flag(F.col("readmitted") == "<30"),
        "readmitted_any": differs(F.col("readmitted"), "NO"),
    }
    return parsed.select([rules[field.name].alias(field.name) for field in FEATURES])
