"""Distribution and correlation summaries."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from wardstat.functions.labels import AGE_EDGES_SUMMARY, AGE_LABELS, cut
from wardstat.functions.numbers import round_ratio, safe_ratio
from wardstat.operators.running import running_totals
from wardstat.operators.small import settle
from wardstat.session import stored
from wardstat.sources.schemas import TARGET

# Fixed list of the correlated columns.
CORRELATED = [
    "age_mid", "time_in_hospital", "num_lab_procedures", "num_procedures", "num_medications", "total_visits",
    "number_diagnoses", "readmitted_30",
]


def outcome_distribution(features: DataFrame) -> DataFrame:
    """Encounters and share in percent of the three outcomes."""
    counts = features.agg(
        F.sum("readmitted_30").alias("early"),
        F.sum(F.col("readmitted_any") - F.col("readmitted_30")).alias("late"),
        F.count(F.when(F.col("readmitted_any") == 0, 1)).alias("never"),
    )
    outcomes = F.array(
        *[
            F.struct(F.lit(label).alias("outcome"), F.coalesce(F.col(name), F.lit(0)).alias("encounters"))
            for label, name in [
                ("Readmitted < 30 days", "early"),
                ("Readmitted > 30 days", "late"),
                ("Not Readmitted", "never"),
            ]
        ]
    )
    everyone = F.coalesce("early", F.lit(0)) + F.coalesce("late", F.lit(0)) + F.col("never")
    return counts.select(F.inline(outcomes), everyone.alias("everyone")).select(
        "outcome", "encounters", round_ratio(F.col("encounters"), F.col("everyone"), 1, scale=100).alias("pct")
    )


def age_rate_points(features: DataFrame) -> DataFrame:
    """Count, positives and rate in percent per binned age; ages outside the bins are left out."""
    return (
        features.groupBy(cut(F.col("age_mid"), AGE_EDGES_SUMMARY, AGE_LABELS).alias("age_group"))
        .agg(F.count(TARGET).alias("total"), F.sum(TARGET).alias("readmitted"))
        .filter(F.col("age_group").isNotNull())
        .withColumn("rate", safe_ratio(F.col("readmitted"), F.col("total")) * 100)
    )


def histogram_density(
    df: DataFrame, col: str = "time_in_hospital", edges: Sequence[float] = tuple(range(1, 15)), by: str = TARGET
) -> DataFrame:
    """Density per bin and group; bins are left-closed, the last one closed on both sides.

    Values outside the edges count towards the mean only. Every bin of a seen group shows, empty ones
    with 0. The input collapses to one row per group and bin before the groups are put together.
    """
    value = F.col(col)
    index = F.when(F.lit(False), F.lit(None).cast("int"))
    last = len(edges) - 2
    for i, (low, high) in enumerate(zip(edges, edges[1:])):
        below = value <= high if i == last else value < high
        index = index.when((value >= low) & below, i)
    cells = df.groupBy(by, index.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(col).alias("total"), F.count(col).alias("known")
    )
    binned = F.col("bin").isNotNull()
    groups = cells.groupBy(by).agg(
        F.sum(F.when(binned, F.col("n")).otherwise(0)).alias("in_range"),
        safe_ratio(F.sum("total"), F.sum("known")).alias("mean"),
        F.map_from_entries(F.collect_list(F.when(binned, F.struct("bin", "n")))).alias("filled"),
    )
    bins = F.array(
        *[
            F.struct(F.lit(i).alias("bin"), F.lit(float(low)).alias("bin_low"), F.lit(float(high)).alias("bin_high"))
            for i, (low, high) in enumerate(zip(edges, edges[1:]))
        ]
    )
    return (
        groups.select(by, "in_range", "mean", "filled", F.inline(bins))
        .withColumn("n", F.coalesce(F.try_element_at("filled", F.col("bin")), F.lit(0)))
        .select(
            by,
            "bin_low",
            "bin_high",
            "n",
            (safe_ratio(F.col("n"), F.col("in_range")) / (F.col("bin_high") - F.col("bin_low"))).alias("density"),
            "mean",
        )
    )


def _whole_number_correlations(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Correlations from exact sums of whole numbers; a sum beyond 64 bits stops the job.

    Rows are summed per pattern of missing values (one pattern where nothing is missing), so each
    column and product is summed once and not again for every partner column. A pair then adds up the
    patterns in which both of its columns are known.
    """
    cols = list(dict.fromkeys(name for pair in pairs for name in pair))
    products = [(name, name) for name in cols] + pairs
    patterns = df.groupBy(*[F.col(name).isNotNull().alias(f"has_{name}") for name in cols]).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.col(name).cast("long")).alias(f"s_{name}") for name in cols],
        *[F.sum(F.col(a).cast("long") * F.col(b)).alias(f"p_{a}_{b}") for a, b in products],
    )
    parts = ["n", "x", "y", "xx", "yy", "xy"]
    rows = [
        f"if(has_{a} and has_{b}, named_struct('column_a', '{b}', 'column_b', '{a}', 'n', n, 'x', s_{a}, 'y', s_{b}, "
        f"'xx', p_{a}_{a}, 'yy', p_{b}_{b}, 'xy', p_{a}_{b}), named_struct('column_a', '{b}', 'column_b', '{a}', "
        + ", ".join(f"'{part}', cast(null as bigint)" for part in parts)
        + "))"
        for a, b in pairs
    ]
    sums = (
        patterns.selectExpr(f"inline(array({', '.join(rows)}))")
        .groupBy("column_a", "column_b")
        .agg(*[F.sum(F.col(part).cast("decimal(19,0)")).alias(part) for part in parts])
    )
    return sums.selectExpr(
        "column_a",
        "column_b",
        "try_divide(cast(n * xy - x * y as double),"
        " sqrt(cast(n * xx - x * x as double)) * sqrt(cast(n * yy - y * y as double))) as correlation",
    )


def correlation_pairs(df: DataFrame, cols: Sequence[str] = tuple(CORRELATED)) -> DataFrame:
    """Pearson correlation of every pair of columns, over the rows where both are known.

    All pairs come from one scan. A constant column has no correlation and shows null; the built-in
    ``corr`` stops with a division error there.
    """
    pairs = list(combinations(cols, 2))
    if all(isinstance(df.schema[name].dataType, IntegralType) for name in cols):
        return _whole_number_correlations(df, pairs)
    measures = []
    for i, (a, b) in enumerate(pairs):
        x = F.when(F.col(b).isNotNull(), F.col(a).cast("double"))
        y = F.when(F.col(a).isNotNull(), F.col(b).cast("double"))
        spread = F.stddev_pop(x) * F.stddev_pop(y)
        measures.append(F.try_divide(F.covar_pop(x, y), spread).alias(f"_{i}"))
    rows = [f"named_struct('column_a', '{b}', 'column_b', '{a}', 'correlation', _{i})" for i, (a, b) in enumerate(pairs)]
    return df.agg(*measures).selectExpr(f"inline(array({', '.join(rows)}))")


def exact_quantiles(values: DataFrame, by: str, col: str, shares: dict[str, float]) -> DataFrame:
    """Linear-interpolation quantiles per group from a (group, value, n) table, plus the group's count.

    Runs on running counts instead of a per-group list, so one group may hold any number of values.
    """
    ranks = running_totals(values, [by], col, {"n": F.col("n")})
    first, last = F.col("cum_n") - F.col("n"), F.col("cum_n") - 1
    picks = [F.max("all_n").alias("n")]
    for name, share in shares.items():
        place = (F.col("all_n") - 1) * F.lit(share)
        for side, rank in (("low", F.floor(place)), ("high", F.ceil(place))):
            picks.append(F.max(F.when((first <= rank) & (rank <= last), F.col(col))).alias(f"{name}_{side}"))
    found = ranks.groupBy(by).agg(*picks)

    def between(name: str, share: float) -> Column:
        place = (F.col("n") - 1) * F.lit(share)
        low, high = F.col(f"{name}_low").cast("double"), F.col(f"{name}_high").cast("double")
        return (low + (high - low) * (place - F.floor(place))).alias(name)

    return found.select(by, "n", *[between(name, share) for name, share in shares.items()])


def boxplot_stats(df: DataFrame, col: str = "num_medications", by: str = TARGET, exact: bool = True) -> DataFrame:
    """Quartiles, whiskers, flier count and median notch of ``col`` per group.

    Whiskers reach the furthest value within 1.5 interquartile ranges of the box and stop at the box
    where no value lies beyond it. Rows without group or value are left out. ``exact=False`` takes
    approximate quartiles.
    """
    counted = df.filter(F.col(by).isNotNull() & F.col(col).isNotNull()).groupBy(by, col)
    values = stored(counted.agg(F.count(F.lit(1)).alias("n")), "values")
    shares = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    if exact:
        boxes = exact_quantiles(values, by, col, shares)
    else:
        quartiles = F.percentile_approx(F.col(col).cast("double"), list(shares.values()), 10_000)
        boxes = (
            df.filter(F.col(by).isNotNull() & F.col(col).isNotNull())
            .groupBy(by)
            .agg(F.count(F.lit(1)).alias("n"), quartiles.alias("q"))
            .select(by, "n", *[F.col("q")[i].alias(name) for i, name in enumerate(shares)])
        )
    reach = (F.col("q3") - F.col("q1")) * 1.5
    boxes = boxes.withColumnsRenamed({"n": "rows"}).withColumns(
        {"low_fence": F.col("q1") - reach, "high_fence": F.col("q3") + reach}
    )
    x = F.col(col).cast("double")
    half_notch = (F.col("q3") - F.col("q1")) * 1.57 / F.sqrt("rows")
    return (
        values.join(settle(boxes), by)
        .groupBy(by)
        .agg(
            *[F.first(name).alias(name) for name in ["rows", "q1", "median", "q3"]],
            F.min(F.when(x >= F.col("low_fence"), x)).alias("lowest"),
            F.max(F.when(x <= F.col("high_fence"), x)).alias("highest"),
            F.sum(F.when((x < F.col("low_fence")) | (x > F.col("high_fence")), F.col("n")).otherwise(0)).alias("fliers"),
        )
        .select(
            by,
            F.col("rows").alias("n"),
            "q1",
            "median",
            "q3",
            F.least("lowest", "q1").alias("whisker_low"),
            F.greatest("highest", "q3").alias("whisker_high"),
            "fliers",
            (F.col("median") - half_notch).alias("notch_low"),
            (F.col("median") + half_notch).alias("notch_high"),
        )
    )
