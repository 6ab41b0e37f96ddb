"""Encounter-shaped and score-shaped inputs that Spark derives from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstat.operators.cohort import build_cohort
from wardstat.operators.features import engineer_features
from wardstat.session import scratch_path
from wardstat.sources.encounters import normalise_nulls
from wardstat.sources.schemas import FEATURES
from wardstat.sources.tables import read_table, write_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Column rules over orders, customers and the line summary, as Spark SQL.
_COLUMNS = {
    "encounter_id": "o_orderkey",
    "patient_nbr": "o_custkey",
    "race": "if(o_custkey % 37 = 0, '?', c_mktsegment)",
    "gender": "if(o_custkey % 50 = 0, 'Unknown/Invalid', if(o_custkey % 2 = 0, 'Female', 'Male'))",
    "age": "if(o_custkey % 41 = 0, '?', if(o_custkey % 43 = 0, 'unknown', concat('[', decade, '-', decade + 10, ')')))",
    "discharge_disposition_id": "if(o_orderkey % 29 = 0, null, cast(o_orderkey % 28 + 1 as int))",
    "time_in_hospital": "cast(o_orderkey % 14 + 1 as int)",
    "num_lab_procedures": "cast(coalesce(qty, 0) % 97 as int)",
    "num_procedures": "cast(coalesce(n_li, 0) % 7 as int)",
    "num_medications": "cast(coalesce(qty, 0) div 8 as int)",
    "number_outpatient": "cast(coalesce(n_n, 0) as int)",
    "number_emergency": "cast(coalesce(n_a, 0) as int)",
    "number_inpatient": "cast(coalesce(n_r, 0) as int)",
    "number_diagnoses": "cast(o_orderkey % 9 + 1 as int)",
    "diag_1": "element_at(array('250.83', '250', '410', '785', '486', '786.5', 'V27', 'E885', '?', '251', ' 428 ', '715'),"
    " cast(o_orderkey % 12 + 1 as int))",
    "medical_specialty": "element_at(array('InternalMedicine', 'Cardiology', '?', 'INTERNAL-Other', 'Surgery-General'),"
    " cast(o_orderkey % 5 + 1 as int))",
    "A1Cresult": "element_at(array('>8', '>7', 'Norm', 'None', 'None', 'None'), cast(o_orderkey % 6 + 1 as int))",
    "insulin": "element_at(array('No', 'Up', 'Steady', 'Down'), cast(o_orderkey % 4 + 1 as int))",
    "change": "if(o_orderkey % 3 = 0, 'Ch', 'No')",
    "diabetesMed": "if(o_orderkey % 7 < 5, 'Yes', 'No')",
    "readmitted": "if(o_orderpriority = '1-URGENT', '<30', if(o_orderpriority = '2-HIGH', '>30', 'NO'))",
}


def encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw encounter per order, with its customer as the patient."""
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.expr("count(1) as n_li"),
            F.expr("cast(sum(l_quantity) as bigint) as qty"),
            *[F.expr(f"count_if(l_returnflag = '{flag}') as n_{flag.lower()}") for flag in ("N", "A", "R")],
        )
    )
    customers = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    joined = table(spark, sf_dir, "orders").join(customers, "o_custkey").join(lines, "o_orderkey", "left")
    return joined.withColumn("decade", F.expr("10 * (o_custkey % 10)")).selectExpr(
        *[f"{rule} as {name}" for name, rule in _COLUMNS.items()]
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature rows of every encounter, not only of the cohort."""
    return engineer_features(normalise_nulls(encounters(spark, sf_dir)))


def stored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows written to the shared folder, for operators that pass over their input several times."""
    path = scratch_path(spark, "features")
    write_table(features(spark, sf_dir), path)
    return read_table(spark, path, FEATURES)


def cohort_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return engineer_features(build_cohort(encounters(spark, sf_dir)))


def scores(spark: SparkSession, sf_dir: str, models: int = 1) -> DataFrame:
    """Scored rows with heavily tied scores, shaped like a prediction log of ``models`` models and two runs."""
    events = table(spark, sf_dir, "events")
    proba = F.floor(F.least(F.col("value"), F.lit(100.0)) * 100).cast("int") / F.lit(10000.0)
    run = F.when(F.col("event_id") % 4 < 2, "2024-01-01 00:00:00").otherwise("2024-01-02 00:00:00")
    return events.select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("m"), (F.col("event_id") % models).cast("string")).alias("model_name"),
        proba.alias("predicted_proba"),
        F.when(proba > 0.5, 1).otherwise(0).alias("predicted_label"),
        F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("actual_label"),
        run.cast("timestamp").alias("run_timestamp"),
    )
