import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wardstat.operators import stats


def labelled(spark, values, label=0, kind="int"):
    return spark.createDataFrame([(label, v) for v in values], f"readmitted_30 int, x {kind}")


def test_histogram_edges(spark):
    rows = stats.histogram_density(labelled(spark, [0, 1, 13, 14, 15]), "x").orderBy("bin_low").collect()
    density = [r["density"] for r in rows]
    assert density == pytest.approx([1 / 3] + [0] * 11 + [2 / 3])
    assert all(r["mean"] == pytest.approx(8.6) for r in rows)
    assert [(r["bin_low"], r["bin_high"]) for r in rows][-1] == (13.0, 14.0)


def test_histogram_matches_numpy(spark):
    values = np.random.default_rng(1).normal(5, 4, 500).round(2)
    edges = [0, 1.5, 4, 4.5, 10]
    got = stats.histogram_density(labelled(spark, values.tolist(), kind="double"), "x", edges).orderBy("bin_low")
    expected, _ = np.histogram(values, bins=edges, density=True)
    assert [r["density"] for r in got.collect()] == pytest.approx(expected.tolist())


def test_histogram_without_values_in_range(spark):
    rows = stats.histogram_density(labelled(spark, [99, 100]), "x").collect()
    assert len(rows) == 13 and all(r["density"] is None and r["n"] == 0 for r in rows)


def test_densities_sum_to_one(features):
    sums = stats.histogram_density(features).groupBy("readmitted_30").agg(F.sum("density").alias("s"))
    assert [r["s"] for r in sums.collect()] == pytest.approx([1.0, 1.0])


def test_boxplot_by_hand(spark):
    df = labelled(spark, [1, 2, 3, 4, 100]).union(labelled(spark, [0, 0, 0, 100], 1)).union(labelled(spark, [None], 0))
    got = {r["readmitted_30"]: r for r in stats.boxplot_stats(df, "x").collect()}
    a, b = got[0], got[1]
    assert (a["n"], a["q1"], a["median"], a["q3"], a["whisker_low"], a["whisker_high"], a["fliers"]) == (5, 2, 3, 4, 1, 4, 1)
    assert a["notch_high"] - 3 == pytest.approx(1.4043, abs=1e-4)
    assert (b["q3"], b["whisker_high"], b["fliers"]) == (25, 25, 1)


@pytest.mark.parametrize("exact", [True, False])
def test_boxplot_quartiles_match_numpy(spark, exact):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(size=700), np.full(400, 0.25)])
    df = labelled(spark, values.tolist(), kind="double").repartition(4)
    got = stats.boxplot_stats(df, "x", exact=exact).first()
    expected = np.quantile(values, [0.25, 0.5, 0.75])
    assert [got["q1"], got["median"], got["q3"]] == pytest.approx(expected.tolist(), abs=1e-12 if exact else 0.02)


def test_boxplot_of_nothing(spark):
    assert stats.boxplot_stats(labelled(spark, []), "x").count() == 0


@pytest.mark.parametrize("kind", ["int", "double"])
def test_correlations_are_pairwise_complete(spark, kind):
    rng = np.random.default_rng(5)
    frame = pd.DataFrame(rng.integers(0, 50, (400, 4)).astype(float), columns=list("abcd"))
    frame["d"] = 3.0
    frame.loc[rng.random(400) < 0.2, "a"] = None
    frame.loc[rng.random(400) < 0.3, "b"] = None
    rows = [tuple(None if pd.isna(v) else (int(v) if kind == "int" else float(v)) for v in row) for row in frame.to_numpy()]
    df = spark.createDataFrame(rows, ", ".join(f"{c} {kind}" for c in "abcd"))
    expected = frame.corr()
    got = {(r["column_a"], r["column_b"]): r["correlation"] for r in stats.correlation_pairs(df, list("abcd")).collect()}
    assert len(got) == 6
    for (x, y), value in got.items():
        if "d" in (x, y):
            assert value is None
        else:
            assert value == pytest.approx(expected.loc[x, y], abs=1e-12)


def test_correlation_pairs_take_one_scan(features):
    df = stats.correlation_pairs(features)
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert df.count() == 28


def test_outcomes(spark):
    df = spark.createDataFrame([(1, 1), (0, 1), (0, 0), (0, 0)], "readmitted_30 int, readmitted_any int")
    got = {r["outcome"]: (r["encounters"], r["pct"]) for r in stats.outcome_distribution(df).collect()}
    assert got == {
        "Readmitted < 30 days": (1, 25.0), "Readmitted > 30 days": (1, 25.0), "Not Readmitted": (2, 50.0),
    }
    nothing = {r["outcome"]: (r["encounters"], r["pct"]) for r in stats.outcome_distribution(df.limit(0)).collect()}
    assert set(nothing.values()) == {(0, None)}
