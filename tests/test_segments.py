import pytest
from pyspark.sql import functions as F

from wardstat.operators import segments
from wardstat.sources.schemas import FEATURES


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], FEATURES)


def test_overall_of_nothing(empty):
    assert tuple(segments.overall_rates(empty).first()) == (0, None, None, None, None)


def test_grouped_answers_of_nothing(empty):
    assert segments.rate_by_age(empty).count() == 0
    assert segments.high_risk_profile(empty).count() == 0


def test_empty_segments_show(empty):
    rows = {(r["segment_type"], r["segment_value"]): r for r in segments.segment_kpis(empty, "export").collect()}
    assert len(rows) == 6
    assert all(r["total_encounters"] == 0 and r["readmitted_30_count"] == 0 for r in rows.values())
    assert all(r["avg_total_visits"] is None and r["readmission_rate_30"] is None for r in rows.values())
    assert [tuple(r)[:4] for r in segments.segment_kpis(empty, "sql").collect()] == [("overall", "All Patients", 0, None)]


@pytest.mark.parametrize("spec", ["sql", "export"])
def test_kpis_take_one_scan(features, spec):
    plan = segments.segment_kpis(features, spec)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "partial_sum" in plan and "Python" not in plan


def test_age_rows_add_up_to_overall(features):
    rows = segments.segment_kpis(features, "export").collect()
    overall = next(r for r in rows if r["segment_type"] == "overall")
    ages = [r for r in rows if r["segment_type"] == "age_group"]
    assert sum(r["total_encounters"] for r in ages) == overall["total_encounters"] == features.count()
    assert sum(r["readmitted_30_count"] for r in ages) == overall["readmitted_30_count"]


def test_kpi_ids_follow_segment_order(features):
    rows = segments.with_kpi_id(segments.segment_kpis(features, "sql")).orderBy("kpi_id").collect()
    assert [r["kpi_id"] for r in rows] == list(range(1, 8))
    assert [r["segment_value"] for r in rows] == [
        "All Patients", "0-30", "31-50", "51-70", "71+", "Not on Insulin", "On Insulin",
    ]


def test_top_k_is_not_a_full_sort(features):
    plan = segments.high_risk_profile(features)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    rows = segments.high_risk_profile(features, 7).collect()
    assert [(-r["total_visits"], -r["num_medications"], r["encounter_id"]) for r in rows] == sorted(
        (-r["total_visits"], -r["num_medications"], r["encounter_id"]) for r in rows
    )


def test_diagnosis_rates_come_highest_first(features):
    rates = [r["readmission_rate_30_pct"] for r in segments.rate_by_diagnosis(features).collect()]
    assert rates == sorted(rates, reverse=True)


def test_only_needed_columns_are_read(features):
    plan = segments.overall_rates(features)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<readmitted_30:int,readmitted_any:int>" in plan


def test_risk_tiers_cover_all_rows(features):
    assert segments.risk_tier_distribution(features).agg(F.sum("encounters")).first()[0] == features.count()


def test_newest_run_first(spark):
    rows = [("m", "2024-01-01", 0.2, 0, 0), ("m", "2024-01-02", 0.6, 1, 0), ("m", "2024-01-02", 0.7, 1, 1)]
    preds = spark.createDataFrame(
        rows, "model_name string, run_timestamp string, predicted_proba double, predicted_label int, actual_label int"
    )
    got = segments.prediction_accuracy(preds).collect()
    assert [(r["run_timestamp"], r["correct"], r["accuracy_pct"], r["avg_predicted_proba"]) for r in got] == [
        ("2024-01-02", 1, 50.0, 0.65), ("2024-01-01", 1, 100.0, 0.2),
    ]
