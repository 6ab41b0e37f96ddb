"""Input that must stop a job or survive it whole."""

import pytest
from pyspark.sql import functions as F

from wardstat.functions.clinical import icd9_number
from wardstat.functions.numbers import round_ratio
from wardstat.operators import metrics, running
from wardstat.operators.classifiers import coarse_inputs
from wardstat.operators.running import running_totals
from wardstat.operators.split import with_class_weight
from wardstat.plans.load import load_features
from wardstat.sources.encounters import read_encounters, read_feature_rows
from wardstat.sources.schemas import MODEL_INPUTS
from wardstat.sources.tables import export_csv, path_exists


def test_rows_without_a_class_stop_the_weights(spark):
    df = spark.createDataFrame([(1, 1), (2, 0), (3, None)], "encounter_id long, readmitted_30 int")
    with pytest.raises(Exception, match="readmitted_30"):
        with_class_weight(df).collect()


def test_rows_without_a_guess_stop_the_cells(spark):
    preds = "model_name string, predicted_proba double, predicted_label int, actual_label int"
    for rows in ([("m", 0.4, None, 1)], [("m", 0.4, 0, None)]):
        for metric in (metrics.confusion_matrix, metrics.classification_report, metrics.model_metrics):
            with pytest.raises(Exception, match="_label"):
                metric(spark.createDataFrame(rows, preds)).collect()


def test_ratios_of_fractions_stop(spark):
    df = spark.createDataFrame([(0.8, 2.0)], "num double, den double")
    with pytest.raises(Exception, match="must be whole"):
        df.select(round_ratio(F.col("num"), F.col("den"), 2)).collect()
    assert df.select(round_ratio(F.lit(5), F.lit(4), 1)).first()[0] == 1.3


def test_short_and_long_lines_stop_the_read(spark, tmp_path):
    for i, line in enumerate(("7,Male", "7,Male,[50-60),x")):
        (tmp_path / f"{i}.csv").write_text(f"encounter_id,gender,age\n1,Female,[0-10)\n{line}\n")
        with pytest.raises(Exception, match="(?i)malformed"):
            read_encounters(spark, str(tmp_path / f"{i}.csv")).collect()


def test_line_breaks_survive_when_asked_for(spark, tmp_path):
    rows = [(1, 'a\nb "c", d', "x"), (2, "plain", "e\r\nf")]
    export_csv(spark.createDataFrame(rows, "encounter_id long, diag_1 string, insulin string"), str(tmp_path / "c"))
    got = read_encounters(spark, str(tmp_path / "c"), multi_line=True).collect()
    assert sorted((r["encounter_id"], r["diag_1"].replace("\r\n", "\n"), r["insulin"].replace("\r\n", "\n")) for r in got) == [
        (1, 'a\nb "c", d', "x"),
        (2, "plain", "e\nf"),
    ]


def test_scoring_input_keeps_fractions(spark, tmp_path):
    export_csv(spark.createDataFrame([(1, 65.9, 2.5)], "encounter_id long, age_mid double, total_visits double"), str(tmp_path / "c"))
    row = read_feature_rows(spark, str(tmp_path / "c")).first()
    assert (row["encounter_id"], row["age_mid"], row["total_visits"]) == (1, 65.9, 2.5)


def test_all_blanks_around_a_code_are_cut(spark):
    for blank in "     　\x1c ":
        df = spark.createDataFrame([(f"{blank}250.5{blank}",)], "c string")
        assert float(df.select(icd9_number(F.col("c"))).first()[0]) == 250.5


def test_a_repeated_key_replaces_nothing(spark, tmp_path):
    from checks.inputs import encounters
    from tests.helpers import SF_DIR

    rows = encounters(spark, SF_DIR).withColumn("encounter_id", F.lit(1).cast("long"))
    export_csv(rows, str(tmp_path / "raw"))
    with pytest.raises(ValueError, match="not unique"):
        load_features(spark, str(tmp_path / "raw"), str(tmp_path / "tables"))
    assert not path_exists(spark, str(tmp_path / "tables"))


def test_ranges_follow_the_number_of_points(spark, monkeypatch):
    monkeypatch.setattr(running, "POINTS_PER_BUCKET", 50)
    df = spark.range(1000).select(F.lit("a").alias("g"), F.col("id").alias("x"), F.lit(1).alias("n"))
    got = running_totals(df, ["g"], "x", {"n": F.col("n")})
    assert [r["cum_n"] for r in got.orderBy("x").collect()] == list(range(1, 1001))
    kept = running._with_bucket(df, "x", None)
    sizes = [r["count"] for r in kept.groupBy("_bucket").count().collect()]
    assert len(sizes) >= 15 and max(sizes) <= 200


def test_inputs_with_more_values_than_bins_are_named(spark):
    df = spark.range(2000).select(*[(F.col("id") % (1000 if c == "age_mid" else 5)).alias(c) for c in MODEL_INPUTS])
    assert list(coarse_inputs(df, 256)) == ["age_mid"]
