"""Evaluation of scored rows.

Input is one long frame ``(model_name, id, predicted_proba, predicted_label, actual_label)``; every metric
is computed for all models at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstat.functions.numbers import required, safe_ratio
from wardstat.operators.running import running_totals
from wardstat.operators.small import settle

MODEL, SCORE, LABEL, GUESS = "model_name", "predicted_proba", "actual_label", "predicted_label"
# Training order, which settles ties between models.
TRAINING_ORDER = ["Logistic Regression", "Random Forest", "Gradient-Boosted Trees"]


def _by_class() -> dict[str, Column]:
    positive = F.col(LABEL) == 1
    return {"pos": F.when(positive, 1).otherwise(0), "neg": F.when(positive, 0).otherwise(1)}


def score_table(preds: DataFrame) -> DataFrame:
    """One row per model and distinct score, best first, with positives, negatives and running counts.

    Every curve and rank metric reads this table, in which tied scores are already one row.
    """
    checked = preds.select(
        MODEL, required(F.col(SCORE), SCORE).alias(SCORE), required(F.col(LABEL), LABEL).alias(LABEL)
    )
    return running_totals(checked, [MODEL], SCORE, _by_class(), descending=True)


def _area_terms() -> Column:
    """Twice the ROC area in units of (positive, negative) pairs; whole numbers, so sums are exact."""
    pairs = F.col("neg").cast("decimal(18,0)") * (2 * F.col("cum_pos") - F.col("pos")).cast("decimal(19,0)")
    return F.sum(pairs)


def _roc_auc() -> Column:
    whole = F.max("all_pos").cast("decimal(18,0)") * F.max("all_neg").cast("decimal(19,0)")
    return safe_ratio(_area_terms(), whole) / 2


def _average_precision() -> Column:
    step = F.col("pos") * safe_ratio(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg"))
    return safe_ratio(F.sum(step), F.max("all_pos"))


def roc_auc(preds: DataFrame) -> DataFrame:
    """Area under the ROC curve per model, ties at mid-rank; null if a class is absent."""
    return score_table(preds).groupBy(MODEL).agg(_roc_auc().alias("roc_auc"))


def average_precision(preds: DataFrame) -> DataFrame:
    """Precision averaged over recall steps, one step per distinct score; null without positives."""
    return score_table(preds).groupBy(MODEL).agg(_average_precision().alias("average_precision"))


def roc_curve(preds: DataFrame) -> DataFrame:
    """ROC points from the origin, without points on a straight stretch between their neighbours."""
    table = score_table(preds)
    best = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
    end = F.col("next_pos").isNull()
    bend = (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
    point = F.struct(
        F.col(SCORE).cast("double").alias("threshold"),
        safe_ratio(F.col("cum_neg"), F.col("all_neg")).alias("fpr"),
        safe_ratio(F.col("cum_pos"), F.col("all_pos")).alias("tpr"),
    )
    origin = F.struct(F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    # The best score of a model brings the origin along.
    rows = F.when(best, F.array(origin, point)).otherwise(F.array(point))
    return table.filter(best | end | bend).select(MODEL, F.inline(rows))


def pr_curve(preds: DataFrame) -> DataFrame:
    """Precision and recall per distinct score, the end point (1, 0), and the share of positives."""
    share = safe_ratio(F.col("all_pos"), F.col("all_pos") + F.col("all_neg"))
    point = F.struct(
        F.col(SCORE).cast("double").alias("threshold"),
        safe_ratio(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
        safe_ratio(F.col("cum_pos"), F.col("all_pos")).alias("recall"),
    )
    end = F.struct(F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    rows = F.when(F.col("next_pos").isNull(), F.array(point, end)).otherwise(F.array(point))
    return score_table(preds).select(MODEL, F.inline(rows), share.alias("prevalence"))


def _cells(preds: DataFrame) -> DataFrame:
    """The four confusion counts, one row per model."""
    actual, guess = required(F.col(LABEL), LABEL) == 1, required(F.col(GUESS), GUESS) == 1
    return preds.groupBy(MODEL).agg(
        F.count_if(~actual & ~guess).alias("tn"),
        F.count_if(~actual & guess).alias("fp"),
        F.count_if(actual & ~guess).alias("fn"),
        F.count_if(actual & guess).alias("tp"),
    )


def confusion_matrix(preds: DataFrame) -> DataFrame:
    """Rows per model, actual and predicted class; all four cells show."""
    cells = F.array(
        *[
            F.struct(F.lit(actual).alias(LABEL), F.lit(guess).alias(GUESS), F.col(name).alias("n"))
            for actual, guess, name in [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
        ]
    )
    return _cells(preds).select(MODEL, F.inline(cells))


def _or_zero(num: Column, den: Column) -> Column:
    return F.coalesce(safe_ratio(num, den), F.lit(0.0))


def _class_scores(hit: Column, guessed: Column, actual: Column) -> dict[str, Column]:
    return {
        "precision": _or_zero(hit, guessed),
        "recall": _or_zero(hit, actual),
        "f1": _or_zero(2 * hit, guessed + actual),
    }


def classification_report(preds: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, and the plain and weighted means."""
    tn, fp, fn, tp = (F.col(name) for name in ("tn", "fp", "fn", "tp"))
    size = tn + fp + fn + tp
    classes = {"0": (_class_scores(tn, tn + fn, tn + fp), tn + fp), "1": (_class_scores(tp, tp + fp, tp + fn), tp + fn)}

    def line(name: str, scores: dict[str, Column], support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            *[scores[key].alias(key) for key in ("precision", "recall", "f1")],
            support.cast("long").alias("support"),
        )

    (zero, n_zero), (one, n_one) = classes["0"], classes["1"]
    accuracy = _or_zero(tp + tn, size)
    macro = {key: (zero[key] + one[key]) / 2 for key in zero}
    weighted = {key: _or_zero(zero[key] * n_zero + one[key] * n_one, size) for key in zero}
    lines = F.array(
        line("0", zero, n_zero),
        line("1", one, n_one),
        line("accuracy", dict.fromkeys(zero, accuracy), size),
        line("macro avg", macro, size),
        line("weighted avg", weighted, size),
    )
    return _cells(preds).select(MODEL, F.inline(lines))


def model_metrics(preds: DataFrame) -> DataFrame:
    """Unrounded metrics per model: rank metrics from the score table, the others from the four cells."""
    ranked = score_table(preds).groupBy(MODEL).agg(
        _roc_auc().alias("roc_auc"), _average_precision().alias("average_precision")
    )
    fp, fn, tp = (F.col(name) for name in ("fp", "fn", "tp"))
    scores = _class_scores(tp, tp + fp, tp + fn)
    at_label = _cells(preds).select(MODEL, *[scores[name].alias(name) for name in ("f1", "precision", "recall")])
    return ranked.join(at_label, MODEL)


def metrics_table(preds: DataFrame) -> DataFrame:
    """The metrics file: four decimals, one row per model."""
    return rounded_metrics(model_metrics(preds))


def rounded_metrics(found: DataFrame) -> DataFrame:
    """The metrics file from the unrounded metrics."""
    names = {
        "ROC_AUC": "roc_auc", "AUCPR": "average_precision", "F1": "f1",
        "Precision_class1": "precision", "Recall_class1": "recall",
    }
    return found.select(
        F.col(MODEL).alias("Model"), *[F.round(col, 4).alias(name) for name, col in names.items()]
    )


def best_model(metrics: DataFrame, order: Sequence[str] = tuple(TRAINING_ORDER)) -> DataFrame:
    """The model with the highest unrounded ROC area; ties go to the one trained first, then by name."""
    place = F.array_position(F.array(*[F.lit(name) for name in order]), F.col(MODEL))
    trained = F.when(place > 0, place).otherwise(len(order) + 1)
    return metrics.orderBy(F.desc_nulls_last("roc_auc"), trained, MODEL).limit(1)


def capture_at(preds: DataFrame, share: float = 0.3, key: str = "id") -> DataFrame:
    """Part of all positives among the top ``ceil(share * n)`` rows by (score desc, key), and its lift.

    Scores above the cut-off score count as a whole. Of the rows tied at the cut-off, which may be a
    large part of the table, running counts over the key find the first ones.
    """
    ratio = F.lit(Decimal(str(share)))
    scores = score_table(preds).withColumns(
        {
            "_upto": F.col("cum_pos") + F.col("cum_neg"),
            "_size": F.col("all_pos") + F.col("all_neg"),
        }
    )
    scores = scores.withColumn("_top", F.ceil(F.col("_size").cast("decimal(18,0)") * ratio).cast("long"))
    before = F.col("_upto") - F.col("pos") - F.col("neg")
    cut = scores.filter((before < F.col("_top")) & (F.col("_top") <= F.col("_upto"))).select(
        MODEL,
        F.col(SCORE),
        (F.col("_top") - before).alias("_needed"),
        (F.col("cum_pos") - F.col("pos")).alias("_above"),
        F.col("all_pos").alias("positives"),
        F.col("_top").alias("top_rows"),
    )
    cut = settle(cut)
    tied = preds.select(MODEL, SCORE, key, LABEL).join(cut, [MODEL, SCORE])
    ranked = running_totals(tied, [MODEL], key, _by_class())
    taken = ranked.join(cut.drop(SCORE), MODEL).filter(
        F.col("cum_pos") + F.col("cum_neg") <= F.col("_needed")
    )
    captured = F.max("_above") + F.sum("pos")
    return (
        taken.groupBy(MODEL)
        .agg(F.max("top_rows").alias("top_rows"), captured.alias("captured"), F.max("positives").alias("positives"))
        .withColumn("capture", safe_ratio(F.col("captured"), F.col("positives")))
        .withColumn("lift", F.col("capture") / F.lit(float(share)))
    )
