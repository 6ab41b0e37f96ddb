"""Explicit table schemas; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _table(**columns) -> StructType:
    return StructType([StructField(name, kind(), True) for name, kind in columns.items()])


# Fixed column names and types of the raw encounter file.
RAW = _table(
    encounter_id=LongType, patient_nbr=LongType, race=StringType, gender=StringType, age=StringType,
    weight=StringType, admission_type_id=IntegerType, discharge_disposition_id=IntegerType,
    admission_source_id=IntegerType, time_in_hospital=IntegerType, payer_code=StringType,
    medical_specialty=StringType, num_lab_procedures=IntegerType, num_procedures=IntegerType,
    num_medications=IntegerType, number_outpatient=IntegerType, number_emergency=IntegerType,
    number_inpatient=IntegerType, diag_1=StringType, diag_2=StringType, diag_3=StringType,
    number_diagnoses=IntegerType, max_glu_serum=StringType, A1Cresult=StringType, metformin=StringType,
    insulin=StringType, change=StringType, diabetesMed=StringType, readmitted=StringType,
)

# Columns a row must have a whole number in, or the load stops.
COUNTS = [
    "time_in_hospital", "num_lab_procedures", "num_procedures", "num_medications",
    "number_outpatient", "number_emergency", "number_inpatient", "number_diagnoses",
]

# Fixed column names and types of the feature table.
FEATURES = _table(
    encounter_id=LongType, patient_nbr=LongType, age_mid=IntegerType, gender_enc=IntegerType,
    time_in_hospital=IntegerType, num_lab_procedures=IntegerType, num_procedures=IntegerType,
    num_medications=IntegerType, number_outpatient=IntegerType, number_emergency=IntegerType,
    number_inpatient=IntegerType, number_diagnoses=IntegerType, total_visits=IntegerType,
    on_insulin=IntegerType, change_meds=IntegerType, on_diabetes_med=IntegerType,
    has_a1c_result=IntegerType, a1c_high=IntegerType, diag_diabetes=IntegerType,
    diag_circulatory=IntegerType, diag_respiratory=IntegerType, specialty_internal_med=IntegerType,
    readmitted_30=IntegerType, readmitted_any=IntegerType,
)

# Fixed list of the model's input columns, in vector order.
MODEL_INPUTS = [
    "age_mid", "gender_enc", "time_in_hospital", "num_lab_procedures", "num_procedures", "num_medications",
    "total_visits", "number_diagnoses", "on_insulin", "change_meds", "on_diabetes_med", "has_a1c_result",
    "a1c_high", "diag_diabetes", "diag_circulatory", "diag_respiratory", "specialty_internal_med",
]

TARGET = "readmitted_30"

PREDICTIONS = _table(
    encounter_id=LongType, model_name=StringType, predicted_proba=DoubleType, predicted_label=IntegerType,
    actual_label=IntegerType, run_timestamp=TimestampType, run_id=StringType,
)

KPIS = _table(
    segment_type=StringType, segment_value=StringType, total_encounters=LongType, readmitted_30_count=LongType,
    readmission_rate_30=DoubleType, avg_time_in_hospital=DoubleType, avg_num_medications=DoubleType,
    avg_total_visits=DoubleType,
)

METRICS = _table(
    Model=StringType, ROC_AUC=DoubleType, AUCPR=DoubleType, F1=DoubleType, Precision_class1=DoubleType,
    Recall_class1=DoubleType,
)
