"""Wall time of the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores. Each query is planned and run over its whole
input, and every row of its result is produced (``noop`` sink). The whole way from raw file to exports, with the
default 300 trees and 400 boosting rounds, is timed by stage (``full_*``); the queries of trained models then load
what it stored, so their times are of scoring. ``BENCH_FULL=0`` leaves the whole way out; then the first of these
queries trains.
"""

from __future__ import annotations

import datetime
import json
import os
import time

from checks.inputs import encounters, features
from checks.queries import QUERIES, use_trained
from wardstat.plans.answers import answers, refresh_kpis, summaries
from wardstat.plans.export import export_all
from wardstat.plans.load import load_features
from wardstat.plans.score import score_file
from wardstat.plans.train import train_and_log
from wardstat.session import scratch_path, session
from wardstat.sources.schemas import MODEL_INPUTS
from wardstat.sources.tables import export_csv, read_table, write_table

HEADLINE = [
    "read_encounters", "build_cohort", "engineer_features", "cohort_features", "stage_counts", "duplicate_keys", "orphan_rows",
    "q1_overall", "q2_age", "q3_high_risk", "q4_insulin", "q5_a1c", "q6_diagnosis", "q7_accuracy", "q8_kpis",
    "kpi_export", "risk_tiers", "overview_kpis", "outcome_distribution", "age_rate_points", "los_histogram",
    "correlation_pairs", "insulin_effect", "medication_boxplot", "class_weights", "stratified_split", "scaler_params",
    "scaled_features", "confusion_matrix", "roc_auc", "average_precision", "roc_points", "pr_points",
    "classification_report", "metrics_table", "capture_at_30", "proba_tiers", "labelled_features",
    "predictions_export", "lr_scores", "rf_scores", "gbt_scores", "batch_scores",
]


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def full_run(spark, sf_dir: str) -> dict[str, float]:
    """Seconds per stage of the whole way, on all encounters."""
    base = scratch_path(spark, "bench")
    seconds = {}

    def timed(name, action):
        start = time.time()
        action()
        seconds[name] = round(time.time() - start, 3)

    export_csv(encounters(spark, sf_dir), f"{base}/raw")
    timed("full_load", lambda: load_features(spark, f"{base}/raw", f"{base}/tables").collect())
    # The cohort keeps one row per customer; training gets every encounter, as the bigger load.
    write_table(features(spark, sf_dir), f"{base}/tables/patient_features")
    table = read_table(spark, f"{base}/tables/patient_features")
    timed("full_answers", lambda: [drain(df) for df in answers(table).values()])
    timed("full_kpis", lambda: refresh_kpis(table, f"{base}/tables/readmission_kpis"))
    timed("full_summaries", lambda: [drain(df) for df in summaries(table).values()])
    run = datetime.datetime(2024, 3, 1)
    timed("full_train", lambda: train_and_log(table, f"{base}/tables", "bench", run))
    timed("full_export", lambda: export_all(spark, f"{base}/tables", f"{base}/exports"))
    split = read_table(spark, f"{base}/tables/split")
    use_trained(spark, sf_dir, f"{base}/tables/models", split)
    export_csv(table.select("encounter_id", *MODEL_INPUTS), f"{base}/rows")
    timed("full_score", lambda: score_file(spark, f"{base}/rows", f"{base}/tables/models", f"{base}/scored"))
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session("bench", f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    drain(QUERIES["q1_overall"](spark, sf_dir))
    full = full_run(spark, sf_dir) if os.environ.get("BENCH_FULL", "1") != "0" else {}
    seconds = {}
    for name in HEADLINE:
        start = time.time()
        drain(QUERIES[name](spark, sf_dir))
        seconds[name] = round(time.time() - start, 3)
    total = round(sum(seconds.values()), 3)
    seconds.update(full)
    print(json.dumps({"metric": "total_wall_time", "value": total, "unit": "sec", "queries": seconds, "sf": sf_dir.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
