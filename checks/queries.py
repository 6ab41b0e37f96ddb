"""Registered queries: one per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks.inputs import cohort_features, encounters, features, scores, stored_features, table
from wardstat.functions.clinical import (
    ICD9_CIRCULATORY,
    ICD9_DIABETES,
    ICD9_RESPIRATORY,
    age_bounds,
    age_midpoint,
    icd9_number,
    in_ranges,
)
from wardstat.functions.labels import AGE_EDGES_EXPORT, AGE_EDGES_SUMMARY, AGE_LABELS, age_band, cut
from wardstat.functions.risk import flagged, proba_tier, risk_score, risk_tier
from wardstat.operators import metrics, quality, segments, split, stats
from wardstat.operators.classifiers import (
    TrainingSettings,
    feature_importance,
    load_model,
    newton,
    predict,
    save_model,
    split_ledger,
    train_models,
    with_probability,
)
from wardstat.operators.cohort import (
    DEATH_OR_HOSPICE,
    KEPT_GENDERS,
    build_cohort,
    drop_values,
    first_per_key,
    keep_values,
)
from wardstat.operators.exports import labelled_features, predictions_export
from wardstat.operators.features import cast_counts, engineer_features
from wardstat.operators.scaling import apply_scaler, fit_scaler
from wardstat.operators.scoring import log_predictions, score, with_score
from wardstat.plans.answers import refresh_kpis
from wardstat.plans.incremental import kpis_by_part, merge_encounters, merged_cohort, refresh_kpis_by_part
from wardstat.session import scratch_path, stored
from wardstat.sources.encounters import PANDAS_NA_TOKENS, normalise_nulls, read_encounters, read_feature_rows
from wardstat.sources.schemas import FEATURES, KPIS, METRICS, MODEL_INPUTS
from wardstat.sources.tables import append_predictions, export_csv, export_metrics, path_exists, read_table, write_table

Query = Callable[[SparkSession, str], DataFrame]

RUN_TIME = "2024-03-01 12:00:00"
# Stored split and models by application and tables folder: trained once, with the default settings, whichever query
# asks first.
_TRAINED: dict[tuple[str, str], str] = {}


def _on(view: Callable[[SparkSession, str], DataFrame], operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(view(spark, sf_dir))


def _two_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(spark, sf_dir, models=2)


def _split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every feature row with its part of the split, written once per call: what reads it reads no more than that."""
    return stored(split.stratified_split(stored_features(spark, sf_dir)), "split")


def use_trained(spark: SparkSession, sf_dir: str, folder: str, parts: DataFrame) -> None:
    """Let the queries of trained models use what ``folder`` holds, trained on the training rows of ``parts``."""
    write_table(parts, f"{folder}/split")
    _TRAINED[spark.sparkContext.applicationId, sf_dir] = folder


def _trained(spark: SparkSession, sf_dir: str, *shorts: str) -> str:
    """The folder with the split and the asked models; what is missing is trained first."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TRAINED:
        folder = scratch_path(spark, "trained")
        write_table(split.stratified_split(stored_features(spark, sf_dir)), f"{folder}/split")
        _TRAINED[key] = folder
    folder = _TRAINED[key]
    missing = [short for short in shorts if not path_exists(spark, f"{folder}/{short}")]
    if missing:
        train = read_table(spark, f"{folder}/split").filter("split = 'train'")
        for model in train_models(train, missing):
            save_model(model, folder)
    return folder


def _train_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split_rows(spark, sf_dir).filter("split = 'train'").drop("split")


def _stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = encounters(spark, sf_dir)
    cohort = build_cohort(raw)
    return quality.stage_counts(raw, cohort, engineer_features(cohort))


def _diagnosis(name: str, ranges: list) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = normalise_nulls(encounters(spark, sf_dir))
        return rows.select("encounter_id", "diag_1", in_ranges(icd9_number(F.col("diag_1")), ranges).alias(name))

    return run


def _age_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bands of every whole-number age from -1 up, so that each band edge is met."""
    age = (F.col("o_orderkey") % 125 - 1).cast("int")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", age.alias("age"))
    return rows.withColumns(
        {
            "band": age_band(F.col("age")),
            "summary_band": cut(F.col("age"), AGE_EDGES_SUMMARY, AGE_LABELS),
            "export_band": cut(F.col("age"), AGE_EDGES_EXPORT, AGE_LABELS),
        }
    )


def _csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "encounters-csv")
    export_csv(encounters(spark, sf_dir), path)
    return read_encounters(spark, path)


def _table_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "features")
    write_table(features(spark, sf_dir).limit(0), path)
    write_table(features(spark, sf_dir), path)
    return read_table(spark, path, FEATURES)


def _feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "feature-rows")
    rows = features(spark, sf_dir).select("encounter_id", *MODEL_INPUTS)
    export_csv(rows.withColumn("age_mid", F.col("age_mid") + 0.25), path)
    return read_feature_rows(spark, path)


def _prediction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs, the second written twice: it must show once."""
    path = scratch_path(spark, "prediction-log")
    preds = scores(spark, sf_dir).withColumnRenamed("id", "encounter_id")
    append_predictions(preds, path, "a")
    append_predictions(preds, path, "b", RUN_TIME)
    append_predictions(preds, path, "b", RUN_TIME)
    return read_table(spark, path).groupBy("run_id", "run_timestamp", "model_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum("actual_label").alias("positives"), F.sum("encounter_id").alias("id_sum")
    )


def _stored_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "kpis")
    refresh_kpis(cohort_features(spark, sf_dir), path)
    refresh_kpis(features(spark, sf_dir), path)
    return spark.read.schema(f"kpi_id int, {', '.join(f'{f.name} {f.dataType.simpleString()}' for f in KPIS)}").parquet(path)


def _merged_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encounters that arrive in three loads, late ones last and some of them twice."""
    path = scratch_path(spark, "merged-cohort")
    raw = encounters(spark, sf_dir)
    for load in ("encounter_id % 3 = 2", "encounter_id % 3 = 0 or encounter_id % 7 = 0", "encounter_id % 3 = 1"):
        merge_encounters(raw.where(load), path)
    return merged_cohort(spark, path, normalise_nulls(raw).schema)


def _kpis_by_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KPI sums of four parts, of which one is then written anew, one taken away and one more added."""
    base, path = scratch_path(spark, "kpi-parts"), scratch_path(spark, "kpi-sums")
    rows = stored_features(spark, sf_dir).withColumn("part", F.col("encounter_id") % 4)
    parts = {f"p{i}": f"{base}/p{i}" for i in range(4)}
    for i in range(4):
        write_table(rows.where(F.col("part") == (0 if i == 1 else i)).drop("part"), parts[f"p{i}"])
    gone = {"old": f"{base}/old"}
    write_table(rows.where("part = 3").drop("part"), gone["old"])
    refresh_kpis_by_part(spark, {**gone, **{k: parts[k] for k in ("p0", "p1", "p2")}}, path)
    write_table(rows.where("part = 1").drop("part"), parts["p1"])
    refresh_kpis_by_part(spark, parts, path)
    return segments.with_kpi_id(kpis_by_part(spark, path))


def _exported_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = scratch_path(spark, "metrics"), scratch_path(spark, "metrics-export")
    export_csv(metrics.metrics_table(_two_models(spark, sf_dir)), source)
    export_metrics(spark, source, target)
    return spark.read.schema(METRICS).option("header", True).csv(target)


def _predictions_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    preds = _two_models(spark, sf_dir).withColumnRenamed("id", "encounter_id")
    return predictions_export(preds, features(spark, sf_dir))


def _duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def _orphan_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return quality.orphan_rows(orders, lines, ["o_orderkey"])


def _risk(df: DataFrame) -> DataFrame:
    return df.select("encounter_id", risk_score().alias("score"), risk_tier().alias("risk_tier"))


def _proba_tiers(df: DataFrame) -> DataFrame:
    proba = F.col("predicted_proba")
    return df.select("id", "predicted_proba", flagged(proba).alias("flag"), proba_tier(proba).alias("tier"))


def _shown_scores(df: DataFrame) -> DataFrame:
    """The columns a scored row shows, on the score fixture; its own tier column is replaced."""
    rows = df.select("id", "predicted_proba", F.lit("old").alias("risk_tier"))
    return with_score(rows, "predicted_proba", "gbt").withColumnRenamed("predicted_readmission_<30d", "flagged")


def _strict_counts(df: DataFrame) -> DataFrame:
    return cast_counts(df.withColumn("num_medications", F.col("num_medications") + 0.75), ["num_medications"]).select(
        "encounter_id", "num_medications"
    )


def _scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of both parts scaled by what the training rows show, rounded for the comparison."""
    rows = _split_rows(spark, sf_dir)
    params = fit_scaler(rows.filter("split = 'train'"))
    scaled = apply_scaler(rows, params)
    return scaled.select("encounter_id", "split", *[F.round(name, 6).alias(name) for name in MODEL_INPUTS])


def _scaler_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = fit_scaler(_train_rows(spark, sf_dir))
    return params.select("feature", F.round("mean", 8).alias("mean"), F.round("scale", 8).alias("scale"))


def _correlations(df: DataFrame) -> DataFrame:
    return stats.correlation_pairs(df).withColumn("correlation", F.round("correlation", 6))


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 8) for name in names})


def _weighted_sums(df: DataFrame) -> DataFrame:
    both = split.with_class_weight(df, modes={"weight": "balanced", "positive_weight": "positive"})
    return both.groupBy("readmitted_30").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("weight"), 8).alias("weight"),
        F.round(F.avg("positive_weight"), 8).alias("positive_weight"),
    )


def _test_scores(*shorts: str) -> Query:
    """Test-set predictions of models trained on the other rows."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = _trained(spark, sf_dir, *shorts)
        models = [load_model(spark, folder, short) for short in shorts]
        return predict(models, read_table(spark, f"{folder}/split").filter("split = 'test'"))

    return run


def _checked_scores(short: str) -> Query:
    """Test rows of one model, with what must hold of each: a probability from 0 to 1, and the label 1 above one half."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        p = F.col("predicted_proba")
        return _test_scores(short)(spark, sf_dir).select(
            "encounter_id",
            "model_name",
            "actual_label",
            p.between(0, 1).alias("is_probability"),
            ((p > 0.5).cast("int") == F.col("predicted_label")).alias("label_fits"),
        )

    return run


def _importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _trained(spark, sf_dir, "rf", "gbt")
    rf, gbt = (feature_importance(spark, load_model(spark, folder, short)) for short in ("rf", "gbt"))
    return rf.unionByName(gbt)


def _checked_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per tree model: inputs shown, whether importances fall and stay within 0 to 1, and their sum over all inputs."""
    folder = _trained(spark, sf_dir, "rf", "gbt")
    out = []
    for short in ("rf", "gbt"):
        model = load_model(spark, folder, short)
        weights = [row["importance"] for row in feature_importance(spark, model).collect()]
        everything = [row["importance"] for row in feature_importance(spark, model, len(MODEL_INPUTS)).collect()]
        fall = weights == sorted(weights, reverse=True) and 0 <= weights[-1] and weights[0] <= 1
        out.append((model.name, len(weights), len(everything), fall, round(sum(everything), 9)))
    return spark.createDataFrame(out, "model_name string, n_shown int, n_inputs int, in_order boolean, total double")


def _lr_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per input, whether the gradient of the published objective vanishes at the trained coefficients.

    The objective is the weighted log loss summed over all training rows plus half the squared coefficients over C.
    The gradient is taken relative to the sum of weights.
    """
    folder = _trained(spark, sf_dir, "lr")
    model = load_model(spark, folder, "lr")
    weights = model.coefficients
    train = read_table(spark, f"{folder}/split").filter("split = 'train'").select("encounter_id", *MODEL_INPUTS, "readmitted_30")
    rows = split.with_class_weight(apply_scaler(with_probability(train, model), model.scaler))
    error = (F.col("lr_proba") - F.col("readmitted_30")) * F.col("weight")
    sums = rows.agg(F.sum("weight").alias("_all"), F.sum(error).alias("intercept"), *[F.sum(error * F.col(c)).alias(c) for c in MODEL_INPUTS])
    parts = [F.struct(F.lit("intercept").alias("feature"), (F.col("intercept") / F.col("_all")).alias("g"))]
    for name, weight in zip(MODEL_INPUTS, weights, strict=True):
        slope = F.col(name) + F.lit(weight / TrainingSettings().lr_c)
        parts.append(F.struct(F.lit(name).alias("feature"), (slope / F.col("_all")).alias("g")))
    return sums.select(F.inline(F.array(*parts))).select("feature", (F.abs("g") < 1e-6).alias("is_flat"))


#: Few steps whose every number SQL can follow: trees of one split, from all rows and all inputs.
STUMPS = TrainingSettings(
    gbt_rounds=3, gbt_depth=1, gbt_step=0.3, gbt_rows=1.0, gbt_columns=1.0, rf_trees=1, rf_depth=1, rf_inputs=len(MODEL_INPUTS), rf_bootstrap=False
)


def _stumps(short: str) -> Query:
    """Every node of the trees, with its split, gain, rows and value."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        (model,) = train_models(_train_rows(spark, sf_dir), [short], STUMPS)
        numbers = [F.round(name, 4).alias(name) for name in ("gain", "weight")]
        return split_ledger(spark, model).select("tree", "node", "feature", "threshold", "n_rows", *numbers, F.round("value", 6).alias("value"))

    return run


def _lr_one_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logistic regression of the label on the scaled length of stay alone."""
    rows = _train_rows(spark, sf_dir).select("time_in_hospital", "readmitted_30")
    scaled = split.with_class_weight(apply_scaler(rows, fit_scaler(rows, ["time_in_hospital"]), "_scaled"))
    frame = scaled.withColumn("label", F.col("readmitted_30").cast("double"))
    (slope,), intercept, passes = newton(frame, ["time_in_hospital_scaled"], "weight", TrainingSettings().lr_c)
    found = [(round(slope, 6), round(intercept, 6), passes <= 10)]
    return spark.createDataFrame(found, "slope double, intercept double, few_passes boolean")


def _planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models of a label that is 1 for stays of 5 to 10 days, but for each tenth row: trees can tell, a line cannot."""
    hit = F.col("time_in_hospital").between(5, 10) != (F.col("encounter_id") % 10 == 3)
    rows = stored_features(spark, sf_dir).withColumn("readmitted_30", hit.cast("int"))
    parts = stored(split.stratified_split(rows), "planted")
    few = TrainingSettings(rf_trees=40, gbt_rounds=20, gbt_step=0.3)
    trained = train_models(parts.where("split = 'train'"), settings=few)
    folder = scratch_path(spark, "planted-models")
    for model in trained:
        save_model(model, folder)
    test = parts.where("split = 'test'")
    preds = stored(predict(trained, test), "planted-scores")
    again = predict([load_model(spark, folder, model.short) for model in trained], test)
    same = preds.join(again.withColumnRenamed("predicted_proba", "again"), ["encounter_id", "model_name"])
    same = same.groupBy("model_name").agg(F.max(F.abs(F.col("predicted_proba") - F.col("again"))).alias("change"), F.count("*").alias("n_rows"))
    areas = metrics.roc_auc(preds)
    best = Window.partitionBy(F.lit(0)).orderBy(F.desc("roc_auc"))
    return areas.join(same, "model_name").select(
        "model_name",
        "n_rows",
        (F.col("roc_auc") > 0.8).alias("tells"),
        (F.col("roc_auc") < 0.65).alias("does_not_tell"),
        (F.row_number().over(best) <= 2).alias("is_among_best"),
        (F.col("change") < 1e-12).alias("same_when_reloaded"),
    )


def _batch_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored model of the default kind, loaded, over every feature row."""
    return score(features(spark, sf_dir), load_model(spark, _trained(spark, sf_dir, "gbt")))


def _checked_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every scored row: the flag and the tier that its probability asks for, and the model's name."""
    p = F.col("readmission_probability")
    tier = F.expr("if(readmission_probability < 0.3, 'LOW', if(readmission_probability < 0.5, 'MEDIUM', 'HIGH'))")
    # The shown probability is rounded; at a limit exactly it doesn't tell.
    return _batch_scores(spark, sf_dir).select(
        "encounter_id",
        "model_used",
        p.between(0, 1).alias("is_probability"),
        ((p == 0.5) | ((p > 0.5) == F.col("`predicted_readmission_<30d`").cast("boolean"))).alias("flag_fits"),
        (p.isin(0.3, 0.5) | (F.col("risk_tier") == tier)).alias("tier_fits"),
    )


def _checked_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The logged run: exactly the test rows, of one model, the one of greatest ROC area.

    The area is counted anew, as the share of pairs of a positive and a negative row that the model puts in order.
    """
    logged = _logged_best(spark, sf_dir)
    preds = stored(_test_scores("lr", "rf", "gbt")(spark, sf_dir), "test-predictions")
    at = preds.groupBy("model_name", "predicted_proba").agg(F.sum("actual_label").alias("pos"), F.sum(1 - F.col("actual_label")).alias("neg"))
    below = F.sum("neg").over(Window.partitionBy("model_name").orderBy("predicted_proba")) - F.col("neg") / 2
    areas = at.withColumn("below", below).groupBy("model_name").agg((F.sum(F.col("pos") * F.col("below")) / (F.sum("pos") * F.sum("neg"))).alias("area"))
    best = areas.orderBy(F.desc("area")).first()["model_name"]
    return logged.select("run_id", "run_timestamp", "encounter_id", "actual_label", (F.col("model_name") == best).alias("is_best"))


def _logged_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "best-log")
    preds = stored(_test_scores("lr", "rf", "gbt")(spark, sf_dir), "test-predictions")
    best = metrics.best_model(metrics.model_metrics(preds)).first()["model_name"]
    log_predictions(preds, best, path, "run-1", RUN_TIME)
    return read_table(spark, path)


QUERIES: dict[str, Query] = {
    # sources and sinks
    "read_encounters": _csv_round_trip,
    "normalise_nulls": _on(encounters, normalise_nulls),
    "normalise_pandas_nulls": _on(encounters, lambda df: normalise_nulls(df, PANDAS_NA_TOKENS)),
    "table_round_trip": _table_round_trip,
    "read_feature_rows": _feature_rows,
    "prediction_log": _prediction_log,
    "stored_kpis": _stored_kpis,
    "kpis_by_part": _kpis_by_part,
    "exported_metrics": _exported_metrics,
    # cohort
    "keep_gender": _on(encounters, lambda df: keep_values(df, "gender", KEPT_GENDERS)),
    "drop_disposition": _on(encounters, lambda df: drop_values(df, "discharge_disposition_id", DEATH_OR_HOSPICE)),
    "first_encounter": _on(encounters, lambda df: first_per_key(df, "patient_nbr", "encounter_id")),
    "build_cohort": _on(encounters, build_cohort),
    "merged_cohort": _merged_cohort,
    "stage_counts": _stage_counts,
    # features
    "engineer_features": features,
    "cohort_features": cohort_features,
    "features_pandas_nulls": _on(encounters, lambda df: engineer_features(normalise_nulls(df, PANDAS_NA_TOKENS))),
    "cast_counts": _on(encounters, _strict_counts),
    "age_midpoint": _on(
        encounters, lambda df: df.select("encounter_id", age_midpoint(age_bounds(F.col("age"))).alias("age_mid"))
    ),
    "diag_diabetes": _diagnosis("diag_diabetes", ICD9_DIABETES),
    "diag_circulatory": _diagnosis("diag_circulatory", ICD9_CIRCULATORY),
    "diag_respiratory": _diagnosis("diag_respiratory", ICD9_RESPIRATORY),
    "age_bands": _age_bands,
    # quality
    "duplicate_keys": _duplicate_keys,
    "orphan_rows": _orphan_orders,
    # segments
    "q1_overall": _on(features, segments.overall_rates),
    "q2_age": _on(features, segments.rate_by_age),
    "q2_age_cohort": _on(cohort_features, segments.rate_by_age),
    "q3_high_risk": _on(features, segments.high_risk_profile),
    "q4_insulin": _on(features, segments.rate_by_insulin),
    "q5_a1c": _on(features, segments.rate_by_a1c),
    "q6_diagnosis": _on(features, segments.rate_by_diagnosis),
    "q7_accuracy": _on(_two_models, segments.prediction_accuracy),
    "q8_kpis": _on(features, lambda df: segments.with_kpi_id(segments.segment_kpis(df, "sql"))),
    "kpi_export": _on(features, lambda df: segments.segment_kpis(df, "export")),
    "insulin_effect": _on(features, segments.insulin_effect),
    "risk_scores": _on(features, _risk),
    "risk_tiers": _on(features, segments.risk_tier_distribution),
    "overview_kpis": _on(features, segments.overview_kpis),
    # statistics
    "outcome_distribution": _on(features, stats.outcome_distribution),
    "age_rate_points": _on(features, stats.age_rate_points),
    "los_histogram": _on(features, lambda df: _rounded(stats.histogram_density(df), "density", "mean")),
    "correlation_pairs": _on(features, _correlations),
    "medication_boxplot": _on(stored_features, lambda df: _rounded(stats.boxplot_stats(df), "notch_low", "notch_high")),
    # split and scaling
    "class_balance": _on(features, split.class_balance),
    "class_weights": _on(features, lambda df: _rounded(split.class_weights(df), "weight")),
    "weighted_rows": _on(features, _weighted_sums),
    "stratified_split": lambda spark, sf_dir: _split_rows(spark, sf_dir).select("encounter_id", "readmitted_30", "split"),
    "scaler_params": _scaler_params,
    "scaled_features": _scaled,
    # metrics
    "confusion_matrix": _on(_two_models, metrics.confusion_matrix),
    "roc_auc": _on(_two_models, lambda df: _rounded(metrics.roc_auc(df), "roc_auc")),
    "average_precision": _on(_two_models, lambda df: _rounded(metrics.average_precision(df), "average_precision")),
    "roc_points": _on(_two_models, lambda df: _rounded(metrics.roc_curve(df), "fpr", "tpr")),
    "pr_points": _on(_two_models, lambda df: _rounded(metrics.pr_curve(df), "precision", "recall", "prevalence")),
    "classification_report": _on(
        _two_models, lambda df: _rounded(metrics.classification_report(df), "precision", "recall", "f1")
    ),
    "metrics_table": _on(_two_models, metrics.metrics_table),
    "best_model": _on(
        _two_models, lambda df: metrics.best_model(metrics.model_metrics(df)).select("model_name", F.round("roc_auc", 8).alias("roc_auc"))
    ),
    "capture_at_30": _on(_two_models, lambda df: _rounded(metrics.capture_at(df, 0.3), "capture", "lift")),
    # scoring and exports
    "proba_tiers": _on(scores, _proba_tiers),
    "shown_scores": _on(scores, _shown_scores),
    "labelled_features": _on(features, labelled_features),
    "predictions_export": _predictions_export,
    # trained models
    "lr_scores": _test_scores("lr"),
    "rf_scores": _test_scores("rf"),
    "gbt_scores": _test_scores("gbt"),
    "feature_importance": _importances,
    "batch_scores": _batch_scores,
    "log_predictions": _logged_best,
    # what must hold of trained models, with SQL
    "lr_checked": _checked_scores("lr"),
    "rf_checked": _checked_scores("rf"),
    "gbt_checked": _checked_scores("gbt"),
    "importances_checked": _checked_importances,
    "gbt_stumps": _stumps("gbt"),
    "rf_stump": _stumps("rf"),
    "lr_one_input": _lr_one_input,
    "planted_models": _planted,
    "lr_gradient": _lr_gradient,
    "batch_checked": _checked_batch,
    "log_checked": _checked_log,
}
