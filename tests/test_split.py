import math

import pytest
from pyspark.sql import functions as F

from tests.helpers import column
from wardstat.operators.scaling import apply_scaler, fit_scaler
from wardstat.operators.split import class_balance, class_weights, split_quotas, stratified_split, with_class_weight


def data(spark, sizes):
    rows = [(label * 10_000 + i, label) for label, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "encounter_id long, readmitted_30 int")


@pytest.mark.parametrize("sizes", [{0: 900, 1: 101}, {0: 7, 1: 3}, {0: 50, 1: 50, 2: 33}, {1: 11}])
def test_sizes_are_exact(spark, sizes):
    df = data(spark, sizes)
    got = stratified_split(df).groupBy("readmitted_30", "split").count().collect()
    test = {r["readmitted_30"]: r["count"] for r in got if r["split"] == "test"}
    n = sum(sizes.values())
    assert sum(test.values()) == math.ceil(n / 5)
    assert sum(r["count"] for r in got) == n
    for label, size in sizes.items():
        assert abs(test.get(label, 0) - math.ceil(n / 5) * size / n) < 1


def test_quota_ties_go_to_the_lower_label(spark):
    counts = spark.createDataFrame([(0, 5), (1, 5), (2, 5)], "c int, n long")
    assert column(split_quotas(counts, "c", 0.2), "c", "quota") == {0: 1, 1: 1, 2: 1}
    counts = spark.createDataFrame([(1, 3), (0, 3)], "c int, n long")
    assert column(split_quotas(counts, "c", 0.2), "c", "quota") == {0: 1, 1: 1}
    counts = spark.createDataFrame([(1, 2), (0, 2)], "c int, n long")
    assert column(split_quotas(counts, "c", 0.2), "c", "quota") == {0: 1, 1: 0}


def test_membership_ignores_the_layout(spark):
    df = data(spark, {0: 300, 1: 60})
    a = sorted(map(tuple, stratified_split(df.coalesce(1)).collect()))
    b = sorted(map(tuple, stratified_split(df.repartition(7, "encounter_id")).collect()))
    assert a == b
    assert sorted(map(tuple, stratified_split(df, seed=7).collect())) != a


def test_table_is_not_shuffled_for_the_split(features):
    plan = stratified_split(features)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan


def test_unknown_label_stops_the_split(spark):
    df = spark.createDataFrame([(1, 0), (2, None), (3, 1)], "encounter_id long, readmitted_30 int")
    with pytest.raises(Exception, match="readmitted_30 holds a null"):
        stratified_split(df).collect()


def test_weights(spark):
    df = data(spark, {0: 90, 1: 10})
    assert column(class_balance(df), "readmitted_30", "n") == {0: 90, 1: 10}
    assert column(class_weights(df), "readmitted_30", "weight") == pytest.approx({0: 100 / 180, 1: 5.0})
    assert column(class_weights(df, mode="positive"), "readmitted_30", "weight") == {0: 1.0, 1: 9.0}
    weighted = with_class_weight(df)
    assert weighted.agg(F.sum("weight")).first()[0] == pytest.approx(100)
    assert weighted.count() == 100
    with pytest.raises(ValueError):
        class_weights(df, mode="other")


def test_scaler(spark):
    df = spark.createDataFrame([(float(i), 3) for i in (1, 2, 3, 4)], "x double, c int")
    params = fit_scaler(df, ["x", "c"])
    assert {r["feature"]: (r["mean"], r["scale"]) for r in params.collect()} == {
        "x": (2.5, pytest.approx(1.118034)), "c": (3.0, 1.0),
    }
    assert apply_scaler(df, params).orderBy("x").first()["x"] == pytest.approx(-1.341641, abs=1e-6)
    other = apply_scaler(spark.createDataFrame([(0.0, 5)], "x double, c int"), params, "_z").first()
    assert (other["c_z"], other["c"]) == (2.0, 5)
