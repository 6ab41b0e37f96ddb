import pytest
from pyspark.sql import functions as F

from wardstat.operators.cohort import build_cohort, drop_values, first_per_key, keep_values
from wardstat.operators.quality import duplicate_keys, orphan_rows, stage_counts
from wardstat.sources.encounters import PANDAS_NA_TOKENS, normalise_nulls

SCHEMA = "encounter_id long, patient_nbr long, gender string, discharge_disposition_id int"
ROWS = [
    (10, 1, "Male", 1), (5, 1, "Male", 11), (20, 2, "Female", None), (30, 3, "Unknown/Invalid", 1), (31, 3, "Male", 1),
    (40, 4, None, 1), (50, 5, "Male", 1), (51, 5, "Male", 1), (60, None, "Male", 1), (61, None, "Male", 1),
]


def ids(df):
    return sorted(row["encounter_id"] for row in df.collect())


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_cohort_edge_rows(raw):
    assert ids(build_cohort(raw)) == [20, 31, 50, 60]


def test_disposition_before_dedupe_would_differ(raw):
    early = first_per_key(
        drop_values(keep_values(raw, "gender", ["Male", "Female"]), "discharge_disposition_id", [11]),
        "patient_nbr",
        "encounter_id",
    )
    assert 10 in ids(early) and 10 not in ids(build_cohort(raw))


def test_unknown_disposition_is_kept(raw):
    assert 20 in ids(drop_values(raw, "discharge_disposition_id", [11]))


def test_null_order_comes_last(spark):
    df = spark.createDataFrame([(None, 1, "a"), (7, 1, "b")], "encounter_id long, patient_nbr long, tag string")
    assert first_per_key(df, "patient_nbr", "encounter_id").first()["tag"] == "b"


def test_equal_order_is_settled_by_the_other_columns(spark):
    rows = [(1, 1, tag) for tag in "dbca"]
    for partitions in (1, 4):
        df = spark.createDataFrame(rows, "encounter_id long, patient_nbr long, tag string").repartition(partitions)
        assert first_per_key(df, "patient_nbr", "encounter_id").first()["tag"] == "a"


def test_hot_patient_is_cut_down_before_the_shuffle(spark):
    """A patient with a third of all rows: one row per task is shuffled, and the plan says so."""
    df = spark.range(0, 30_000, numPartitions=4).select(
        F.col("id").alias("encounter_id"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 100).alias("patient_nbr"),
        F.lit("Male").alias("gender"),
        F.lit(1).alias("discharge_disposition_id"),
    )
    cohort = build_cohort(df)
    plan = cohort._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert cohort.count() == 20_001
    assert cohort.filter("patient_nbr = 7").first()["encounter_id"] == 0


def test_gender_filter_reaches_the_scan(spark, raw, tmp_path):
    raw.write.parquet(str(tmp_path / "raw"))
    plan = build_cohort(spark.read.parquet(str(tmp_path / "raw")))._jdf.queryExecution().executedPlan().toString()
    assert "In(gender, [Female,Male])" in plan or "In(gender, [Male,Female])" in plan


def test_null_tokens(spark):
    df = spark.createDataFrame([("?", "None", 1), ("a?", "", 2)], "a string, b string, c int")
    assert [tuple(r) for r in normalise_nulls(df).orderBy("c").collect()] == [(None, "None", 1), ("a?", None, 2)]
    assert normalise_nulls(df, PANDAS_NA_TOKENS).orderBy("c").first()["b"] is None


def test_duplicates_and_orphans(spark):
    child = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "e")], "k long, v string")
    parent = spark.createDataFrame([(1,), (1,), (3,)], "k long")
    assert [tuple(r) for r in duplicate_keys(child.dropna(), ["k"]).collect()] == [(1, 2)]
    assert [r["v"] for r in orphan_rows(child, parent, ["k"]).collect()] == ["c"]


def test_orphans_meet_distinct_parents_without_a_forced_broadcast(spark):
    child = spark.range(100).withColumnRenamed("id", "k")
    parent = child.filter("k < 10").union(spark.range(5000).selectExpr("3 as k"))
    found = orphan_rows(child, parent, ["k"])
    assert sorted(r["k"] for r in found.collect()) == list(range(10, 100))
    plan = found._jdf.queryExecution()
    assert "ResolvedHint" not in plan.analyzed().toString()
    # The parent's keys are made distinct below the join.
    assert "Aggregate" in plan.optimizedPlan().toString().split("LeftAnti")[1]


def test_stage_counts(raw):
    cohort = build_cohort(raw)
    rows = {r["stage"]: (r["n_rows"], r["n_columns"]) for r in stage_counts(raw, cohort, cohort).collect()}
    assert rows == {"raw": (10, 4), "cohort": (4, 4), "features": (4, 4)}
