import numpy as np
import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from checks.inputs import scores
from tests.helpers import SF_DIR, column
from wardstat.operators import metrics

SCHEMA = "model_name string, id long, predicted_proba double, predicted_label int, actual_label int"
HAND = [("m", 1, 0.9, 1, 1), ("m", 2, 0.8, 1, 0), ("m", 3, 0.8, 1, 1), ("m", 4, 0.4, 0, 0), ("m", 5, 0.1, 0, 1)]


@pytest.fixture(scope="module")
def hand(spark):
    return spark.createDataFrame(HAND, SCHEMA)


def test_rank_metrics_by_hand(hand):
    assert metrics.roc_auc(hand).first()["roc_auc"] == pytest.approx(0.583333, abs=1e-6)
    assert metrics.average_precision(hand).first()["average_precision"] == pytest.approx(0.755556, abs=1e-6)


def test_cells_by_hand(hand):
    got = {(r["actual_label"], r["predicted_label"]): r["n"] for r in metrics.confusion_matrix(hand).collect()}
    assert got == {(0, 0): 1, (0, 1): 1, (1, 0): 1, (1, 1): 2}


def test_report_by_hand(hand):
    got = {r["class"]: r for r in metrics.classification_report(hand).collect()}
    one = got["1"]
    assert [one["precision"], one["recall"], one["f1"]] == pytest.approx([2 / 3] * 3)
    assert (got["accuracy"]["f1"], got["accuracy"]["support"]) == (pytest.approx(0.6), 5)
    assert got["macro avg"]["precision"] == pytest.approx((0.5 + 2 / 3) / 2)
    assert got["weighted avg"]["recall"] == pytest.approx((0.5 * 2 + 2 / 3 * 3) / 5)


def test_report_without_predicted_positives(spark):
    df = spark.createDataFrame([("m", 1, 0.1, 0, 1), ("m", 2, 0.2, 0, 0)], SCHEMA)
    one = metrics.classification_report(df).filter("class = '1'").first()
    assert (one["precision"], one["recall"], one["f1"]) == (0.0, 0.0, 0.0)


def test_capture_by_hand(hand):
    row = metrics.capture_at(hand, 0.4).first()
    assert (row["top_rows"], row["captured"]) == (2, 1)
    assert row["capture"] == pytest.approx(1 / 3) and row["lift"] == pytest.approx(1 / 3 / 0.4)


def test_capture_inside_one_big_tie(spark):
    """All scores equal: the first rows by key count, whatever the table's layout."""
    df = spark.range(1000, numPartitions=5).select(
        F.lit("m").alias("model_name"), "id", F.lit(0.5).alias("predicted_proba"), F.lit(0).alias("predicted_label"),
        F.when(F.col("id") < 30, 1).otherwise(0).alias("actual_label"),
    )
    assert metrics.capture_at(df, 0.02).first()["captured"] == 20
    assert metrics.capture_at(df, 0.3).first()["captured"] == 30


def test_one_class_only(spark):
    df = spark.createDataFrame([("m", 1, 0.1, 0, 0), ("m", 2, 0.2, 0, 0)], SCHEMA)
    assert metrics.roc_auc(df).first()["roc_auc"] is None
    assert metrics.average_precision(df).first()["average_precision"] is None
    assert metrics.capture_at(df, 0.5).first()["capture"] is None


def test_unknown_label_stops(spark):
    df = spark.createDataFrame([("m", 1, 0.1, 0, None)], SCHEMA)
    with pytest.raises(Exception, match="actual_label holds a null"):
        metrics.roc_auc(df).collect()


def brute_auc(scores, labels):
    pos, neg = scores[labels == 1], scores[labels == 0]
    return ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))


def brute_ap(scores, labels):
    total, last = 0.0, 0.0
    for threshold in sorted(set(scores), reverse=True):
        chosen = scores >= threshold
        recall = labels[chosen].sum() / labels.sum()
        total += (recall - last) * labels[chosen].mean()
        last = recall
    return total


def brute_roc(scores, labels):
    points = [(int(((scores >= t) & (labels == 0)).sum()), int(((scores >= t) & (labels == 1)).sum())) for t in sorted(set(scores), reverse=True)]
    kept = [
        p for i, p in enumerate(points)
        if i in (0, len(points) - 1)
        or points[i + 1][0] - 2 * p[0] + points[i - 1][0] != 0
        or points[i + 1][1] - 2 * p[1] + points[i - 1][1] != 0
    ]
    n, p = (labels == 0).sum(), (labels == 1).sum()
    return sorted([(0.0, 0.0)] + [(a / n, b / p) for a, b in kept])


@settings(
    max_examples=6,
    deadline=None,
    phases=[Phase.explicit, Phase.generate],
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 1)), min_size=4, max_size=60))
def test_rank_metrics_match_brute_force(spark, rows):
    labels = np.array([label for _, label in rows] + [0, 1])
    values = np.array([score / 12 for score, _ in rows] + [0.5, 0.25])
    df = spark.createDataFrame(
        [("m", i, float(s), int(s > 0.5), int(y)) for i, (s, y) in enumerate(zip(values, labels))], SCHEMA
    )
    got = metrics.model_metrics(df).first()
    assert got["roc_auc"] == pytest.approx(brute_auc(values, labels))
    assert got["average_precision"] == pytest.approx(brute_ap(values, labels))
    curve = sorted((r["fpr"], r["tpr"]) for r in metrics.roc_curve(df).collect())
    np.testing.assert_allclose(curve, brute_roc(values, labels))


def test_reversed_scores_mirror_the_area(spark):
    preds = scores(spark, SF_DIR, 2)
    mirrored = preds.withColumn("predicted_proba", 1 - F.col("predicted_proba"))
    a, b = (column(metrics.roc_auc(df), "model_name", "roc_auc") for df in (preds, mirrored))
    assert {m: a[m] + b[m] for m in a} == pytest.approx(dict.fromkeys(a, 1.0))


def test_area_agrees_with_the_library_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    preds = scores(spark, SF_DIR)
    library = BinaryClassificationEvaluator(rawPredictionCol="predicted_proba", labelCol="y", numBins=0).evaluate(
        preds.withColumn("y", F.col("actual_label").cast("double"))
    )
    assert metrics.roc_auc(preds).first()["roc_auc"] == pytest.approx(library, abs=1e-9)


def test_pr_curve_ends(hand):
    rows = metrics.pr_curve(hand).collect()
    assert len(rows) == 5 and all(r["prevalence"] == 0.6 for r in rows)
    assert [(r["precision"], r["recall"]) for r in rows if r["threshold"] is None] == [(1.0, 0.0)]
    assert max(r["recall"] for r in rows) == 1.0


def test_best_model_tie_goes_to_the_first_trained(spark):
    table = spark.createDataFrame(
        [("Random Forest", 0.7), ("Logistic Regression", 0.7), ("Other", 0.7), ("Gradient-Boosted Trees", 0.6)],
        "model_name string, roc_auc double",
    )
    assert metrics.best_model(table).first()["model_name"] == "Logistic Regression"
