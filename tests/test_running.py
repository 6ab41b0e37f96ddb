import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from wardstat.operators.running import running_totals


def brute(frame, descending):
    points = frame.groupby(["g", "x"], as_index=False)["n"].sum()
    points = points.sort_values(["g", "x"], ascending=[True, not descending])
    by = points.groupby("g")["n"]
    points["cum_n"], points["all_n"], points["next_n"] = by.cumsum(), by.transform("sum"), by.shift(-1)
    return points.reset_index(drop=True)


def check(spark, frame, descending, buckets=None):
    df = spark.createDataFrame(frame).repartition(4)
    got = running_totals(df, ["g"], "x", {"n": F.col("n")}, descending=descending, buckets=buckets)
    got = got.select("g", "x", "n", "cum_n", "all_n", "next_n").toPandas()
    got = got.sort_values(["g", "x"], ascending=[True, not descending]).reset_index(drop=True)
    expected = brute(frame, descending)
    pd.testing.assert_frame_equal(got.astype(float, errors="ignore"), expected.astype(float, errors="ignore"), check_dtype=False)


def test_skewed_values_and_groups(spark):
    """A third of the rows share one value, scores crowd at one end, and one group holds most rows."""
    rng = np.random.default_rng(11)
    x = np.where(rng.random(3000) < 1 / 3, 0.1, rng.beta(0.3, 30, 3000).round(5))
    g = np.where(rng.random(3000) < 0.9, "big", "small")
    frame = pd.DataFrame({"g": g, "x": x, "n": rng.integers(0, 3, 3000)})
    check(spark, frame, descending=True, buckets=16)
    check(spark, frame, descending=False, buckets=200)


def test_one_value(spark):
    check(spark, pd.DataFrame({"g": ["a"] * 5, "x": [0.5] * 5, "n": [1] * 5}), descending=True)


def test_long_keys_beyond_double_precision(spark):
    base = 2**60
    frame = pd.DataFrame({"g": ["a"] * 40, "x": [base + i for i in range(40)], "n": [1] * 40})
    df = spark.createDataFrame(frame)
    got = running_totals(df, ["g"], "x", {"n": F.col("n")}).orderBy("x").collect()
    assert [r["cum_n"] for r in got] == list(range(1, 41))


def test_groups_are_spread_over_buckets(spark):
    """The ordered step works per bucket: no window over a whole group of rows is in the plan."""
    df = spark.range(1000).select(F.lit("a").alias("g"), F.rand(1).alias("x"), F.lit(1).alias("n"))
    plan = running_totals(df, ["g"], "x", {"n": F.col("n")})._jdf.queryExecution().executedPlan().toString()
    rows = [line for line in plan.splitlines() if "Window [sum(n" in line]
    assert rows and all("_bucket" in line for line in rows)
