import datetime

import pytest
from pyspark.sql import functions as F

from checks.inputs import encounters
from tests.helpers import SF_DIR
from wardstat.operators.classifiers import TrainingSettings
from wardstat.operators.exports import labelled_features
from wardstat.plans.answers import answers, refresh_kpis, refresh_summaries, stored_answers, summaries
from wardstat.plans.export import export_all
from wardstat.plans.load import load_features
from wardstat.plans.score import score_file
from wardstat.plans.train import train_and_log
from wardstat.sources.encounters import PANDAS_NA_TOKENS, read_encounters
from wardstat.sources.schemas import MODEL_INPUTS
from wardstat.sources.tables import append_predictions, export_csv, export_metrics, read_table, write_table

RUN = datetime.datetime(2024, 3, 1, 12)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("load")
    export_csv(encounters(spark, SF_DIR), str(folder / "raw"))
    counts = load_features(spark, str(folder / "raw"), str(folder / "tables"))
    return folder, {r["stage"]: r["n_rows"] for r in counts.collect()}


def test_load(spark, loaded):
    folder, counts = loaded
    assert counts["raw"] == 1500 and counts["cohort"] == counts["features"] == 115
    assert spark.read.parquet(str(folder / "tables/patient_features")).count() == 115


def test_header_order_is_free_and_unknown_columns_stay(spark, tmp_path):
    (tmp_path / "a.csv").write_text('extra,age,encounter_id,time_in_hospital,A1Cresult\n"x ""y"", z",[50-60),7,?,None\n')
    row = read_encounters(spark, str(tmp_path)).first().asDict()
    assert row == {"extra": 'x "y", z', "age": "[50-60)", "encounter_id": 7, "time_in_hospital": None, "A1Cresult": "None"}
    assert read_encounters(spark, str(tmp_path), PANDAS_NA_TOKENS).first()["A1Cresult"] is None


def test_only_asked_columns_are_parsed(spark, loaded):
    df = read_encounters(spark, str(loaded[0] / "raw")).select("gender", "num_medications")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<gender:string,num_medications:string>" in plan


def test_blanks_and_nulls_survive_a_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, " a ", None), (2, 'q"u', "b,c")], "encounter_id long, diag_1 string, insulin string")
    export_csv(df, str(tmp_path / "c"))
    assert sorted(map(tuple, read_encounters(spark, str(tmp_path / "c")).collect())) == sorted(map(tuple, df.collect()))


def test_same_run_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.createDataFrame([(1, "m", 0.4, 0, 1)], "encounter_id long, model_name string, predicted_proba double, predicted_label int, actual_label int")
    append_predictions(rows, path, "a", RUN)
    append_predictions(rows.withColumn("predicted_proba", F.lit(0.9)), path, "b", RUN)
    append_predictions(rows.withColumn("predicted_proba", F.lit(0.7)), path, "b", RUN)
    got = {r["run_id"]: r["predicted_proba"] for r in read_table(spark, path).collect()}
    assert got == {"a": 0.4, "b": 0.7}
    plan = read_table(spark, path).filter("run_id = 'b'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan


def test_write_replaces(spark, tmp_path):
    write_table(spark.range(5), str(tmp_path / "t"))
    write_table(spark.range(3), str(tmp_path / "t"))
    assert read_table(spark, str(tmp_path / "t")).count() == 3


def test_answers_and_summaries(spark, features, tmp_path):
    assert set(answers(features)) == {"overall", "by_age", "high_risk", "by_insulin", "by_a1c", "by_diagnosis", "kpis"}
    assert all(df.count() > 0 for df in summaries(features).values())
    refresh_kpis(features, str(tmp_path / "kpis"))
    assert read_table(spark, str(tmp_path / "kpis")).count() == 7


def test_labelled_view_has_29_columns_and_no_shuffle(features):
    df = labelled_features(features)
    assert len(df.columns) == 29
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_missing_metrics_are_skipped(spark, tmp_path, caplog):
    assert export_metrics(spark, str(tmp_path / "none"), str(tmp_path / "out")) is None
    assert "train the models first" in caplog.text


def test_train_export_and_score(spark, features, tmp_path):
    base = str(tmp_path)
    write_table(features, f"{base}/patient_features")
    export_all(spark, base, f"{base}/early")
    assert not (tmp_path / "early/predictions").exists()
    run = train_and_log(features, base, "run-1", RUN, TrainingSettings(rf_trees=3, gbt_rounds=2))
    assert run.metrics.count() == 3 and run.best in [m.name for m in run.models]
    kept = {name: read_table(spark, f"{base}/metrics/{name}") for name in ("roc_points", "pr_points", "confusion_matrix", "feature_importance")}
    assert kept["confusion_matrix"].count() == 12 and kept["feature_importance"].count() == 30
    assert kept["roc_points"].filter("fpr = 1 and tpr = 1").count() == kept["pr_points"].filter("recall = 0 and threshold is null").count() == 3
    refresh_summaries(features, f"{base}/summaries")
    assert read_table(spark, f"{base}/summaries/medication_boxplot").count() == 2
    assert stored_answers(spark, base)["prediction_accuracy"].count() >= 1
    export_all(spark, base, f"{base}/out")
    logged = read_table(spark, f"{base}/model_predictions")
    assert logged.count() == 300 and logged.select("model_name").distinct().first()[0] == run.best
    assert {r["run_timestamp"] for r in logged.select("run_timestamp").distinct().collect()} == {RUN}
    exported = spark.read.option("header", True).csv(f"{base}/out/predictions")
    assert exported.count() == 300 and "gender_label" in exported.columns
    assert spark.read.option("header", True).csv(f"{base}/out/model_metrics").count() == 3
    export_csv(features.select("encounter_id", *MODEL_INPUTS), f"{base}/rows")
    for short in ("lr", "gbt"):
        score_file(spark, f"{base}/rows", f"{base}/models", f"{base}/scored-{short}", short)
        scored = spark.read.option("header", True).csv(f"{base}/scored-{short}")
        assert scored.count() == 1500 and scored.first()["model_used"] == short.upper()
