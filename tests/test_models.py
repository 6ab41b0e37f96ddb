import numpy as np
import pytest
from pyspark.sql import functions as F

from wardstat.operators import classifiers
from wardstat.operators.classifiers import (
    TrainingSettings,
    feature_importance,
    load_model,
    newton,
    predict,
    save_model,
    train_models,
    with_probability,
)
from wardstat.operators.metrics import model_metrics
from wardstat.operators.scoring import score, with_score
from wardstat.operators.scaling import apply_scaler, fit_scaler
from wardstat.operators.split import stratified_split
from wardstat.sources.schemas import MODEL_INPUTS

SHORT = TrainingSettings(rf_trees=10, gbt_rounds=5)
# Fixed sample record for scoring.
SAMPLE = (65, 1, 7, 55, 2, 18, 6, 9, 1, 1, 1, 1, 1, 1, 0, 0, 1)


@pytest.fixture(scope="module")
def signal(spark, tmp_path_factory):
    """Feature rows whose label depends on visits and medications."""
    rng = np.random.default_rng(8)
    rows = []
    for i in range(1500):
        values = [int(v) for v in rng.integers(0, 20, 8)] + [int(v) for v in rng.integers(0, 2, 9)]
        odds = 0.25 * (values[6] - 10) + 0.15 * (values[5] - 10) - 1.0
        rows.append((i, *values, int(rng.random() < 1 / (1 + np.exp(-odds)))))
    path = str(tmp_path_factory.mktemp("signal") / "t")
    columns = ", ".join(f"{name} int" for name in MODEL_INPUTS)
    spark.createDataFrame(rows, f"encounter_id long, {columns}, readmitted_30 int").write.parquet(path)
    return stratified_split(spark.read.parquet(path))


@pytest.fixture(scope="module")
def models(signal):
    return train_models(signal.filter("split = 'train'"), settings=SHORT)


@pytest.fixture(scope="module")
def preds(signal, models):
    return predict(models, signal.filter("split = 'test'"))


def test_all_models_learn(preds):
    auc = {r["model_name"]: r["roc_auc"] for r in model_metrics(preds).collect()}
    assert len(auc) == 3 and all(0.75 < value < 0.95 for value in auc.values())


def test_predictions_are_one_row_per_model_and_test_row(signal, preds):
    n = signal.filter("split = 'test'").count()
    assert preds.count() == 3 * n == preds.select("encounter_id", "model_name").distinct().count()
    assert preds.filter(~F.col("predicted_proba").between(0, 1)).isEmpty()
    assert preds.filter((F.col("predicted_proba") > 0.5) != (F.col("predicted_label") == 1)).isEmpty()


def test_one_scan_scores_all_models(preds):
    plan = preds._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "EvalPython" not in plan


def test_logistic_regression_minimises_its_objective(signal, models):
    """Gradient of sum(weight * loss) + |b|^2 / (2 C) at the fitted point, in numpy."""
    train = signal.filter("split = 'train'").toPandas()
    x = train[MODEL_INPUTS].to_numpy(float)
    deviation = x.std(axis=0)
    x = (x - x.mean(axis=0)) / np.where(deviation == 0, 1, deviation)
    y = train["readmitted_30"].to_numpy(float)
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    lr = models[0]
    b = np.array(lr.coefficients)
    error = weight * (1 / (1 + np.exp(-(x @ b + lr.intercept))) - y)
    assert np.abs(x.T @ error + b / 0.1).max() / len(y) < 1e-6
    assert abs(error.sum()) / len(y) < 1e-6


def test_importances(spark, models):
    rows = feature_importance(spark, models[1], k=17).collect()
    assert sum(r["importance"] for r in rows) == pytest.approx(1.0)
    assert {rows[0]["feature"], rows[1]["feature"]} == {"total_visits", "num_medications"}
    assert feature_importance(spark, models[2]).count() == 15


@pytest.mark.parametrize("place", [0, 1, 2])
def test_stored_models_score_the_same(spark, signal, models, tmp_path, place):
    model = models[place]
    save_model(model, str(tmp_path))
    loaded = load_model(spark, str(tmp_path), model.short)
    a, b = (
        with_probability(signal, m).orderBy("encounter_id").select(f"{model.short}_proba").limit(50).collect()
        for m in (model, loaded)
    )
    assert a == b


def test_missing_model_is_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="gbt: train the models first"):
        load_model(spark, str(tmp_path))
    with pytest.raises(ValueError):
        load_model(spark, str(tmp_path), "svm")


def test_sample_record_scores(spark, models):
    df = spark.createDataFrame([SAMPLE], ", ".join(f"{name} int" for name in MODEL_INPUTS))
    for model in models:
        got = score(df, model).first().asDict()
        assert list(got)[:17] == MODEL_INPUTS and got["model_used"] == model.short.upper()
        assert got["predicted_readmission_<30d"] == (got["risk_tier"] == "HIGH")


def test_shown_columns_replace_inputs(spark):
    df = spark.createDataFrame([(1, "old", 0.49996), (2, "old", 0.5)], "id int, risk_tier string, p double")
    rows = with_score(df, "p", "gbt").orderBy("id").collect()
    assert rows[0].asDict() == {
        "id": 1, "readmission_probability": 0.5, "predicted_readmission_<30d": False, "risk_tier": "MEDIUM",
        "model_used": "GBT",
    }
    assert rows[1]["risk_tier"] == "HIGH" and rows[1]["predicted_readmission_<30d"] is True


def test_passes_of_the_regression_read_packed_blocks_in_few_tasks(spark, signal, monkeypatch):
    """However many partitions the rows have; scaled in the pass or before it, with fractions too, the point is the same."""
    rows = signal.selectExpr("*", "double(readmitted_30) label", "1.5D weight", "age_mid * 100000 + 0.25D wide").repartition(40)
    names = ["age_mid", "total_visits", "num_medications", "wide"]
    scaler = fit_scaler(rows, names)
    seen = []
    plain = classifiers.loss_sums

    def sums(blocks, *rest):
        seen.append((blocks.rdd.getNumPartitions(), blocks.columns))
        return plain(blocks, *rest)

    monkeypatch.setattr(classifiers, "loss_sums", sums)
    monkeypatch.setattr(classifiers, "LOSS_ROWS", 100)
    got = newton(rows, names, "weight", 0.1, scaler=scaler)
    want = newton(apply_scaler(rows, scaler, "_s"), [f"{name}_s" for name in names], "weight", 0.1)
    assert np.allclose(got[0], want[0], atol=1e-9) and abs(got[1] - want[1]) < 1e-9 and got[2] == want[2]
    most = spark.sparkContext.defaultParallelism
    assert {tuple(columns) for _, columns in seen} == {("block",)} and max(n for n, _ in seen) <= most
