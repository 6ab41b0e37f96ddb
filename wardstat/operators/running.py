"""Exact running totals over an ordered column, without sorting any group in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardstat.session import stored

#: Distinct points that one bucket holds about: what is sorted together.
POINTS_PER_BUCKET = 100_000


def _with_bucket(points: DataFrame, order: str, buckets: int | None) -> DataFrame:
    """The points, stored once, with the number of their range of the order column.

    Ranges are as many as the points ask for. Spark's range partitioning finds their edges from a bounded sample per
    partition, and the stored number fixes them for every later use and retry.
    """
    kept = stored(points, "points")
    buckets = buckets or -(-kept.count() // POINTS_PER_BUCKET)
    if buckets < 2:
        return kept.withColumn("_bucket", F.lit(0))
    ranged = kept.repartitionByRange(buckets, order).withColumn("_bucket", F.spark_partition_id())
    return stored(ranged, "ranged-points")


def running_totals(
    df: DataFrame,
    group: Sequence[str],
    order: str,
    sums: Mapping[str, Column],
    descending: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """One row per (group, order value) with sums, running sums and look-ahead.

    For each name ``m`` in ``sums`` the result has ``m`` (the sum at this value), ``cum_m`` (the sum up
    to and including it), ``all_m`` (the group's sum) and ``next_m`` (the sum at the next value, null at
    the end). Order values must not be null.

    Equal values are summed before anything is ordered, so a value held by a large share of the rows
    is one row; ``df`` is read for that and never again. Values are then spread over range buckets. Bucket totals,
    ``buckets`` rows per group, give every bucket what comes before it and what comes next; these join the
    bucket as a first and a last row, and only the rows of one bucket are sorted together.
    """
    keys, names = list(group), list(sums)
    points = df.groupBy(*keys, order).agg(*[F.sum(col).alias(name) for name, col in sums.items()])
    bucketed = _with_bucket(points, order, buckets)
    direction = F.desc if descending else F.asc
    first = F.max_by if descending else F.min_by

    heads = bucketed.groupBy(*keys, "_bucket").agg(
        *[F.sum(name).alias(f"_sum_{name}") for name in names],
        first(F.struct(*names), order).alias("_head"),
    )
    whole = Window.partitionBy(*keys)
    ordered = whole.orderBy(direction("_bucket"))
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    offsets = heads.select(
        *keys,
        "_bucket",
        F.struct(
            F.lit(0).alias("_kind"),
            *[F.coalesce(F.sum(f"_sum_{name}").over(earlier), F.lit(0)).alias(name) for name in names],
        ).alias("_before"),
        F.lead("_head").over(ordered).alias("_next"),
        *[F.sum(f"_sum_{name}").over(whole).alias(f"all_{name}") for name in names],
    )
    after = F.struct(F.lit(2).alias("_kind"), *[F.col(f"_next.{name}").alias(name) for name in names])
    marks = offsets.select(
        *keys, "_bucket", F.inline(F.array("_before", after)), *[f"all_{name}" for name in names]
    ).withColumn(order, F.lit(None).cast(df.schema[order].dataType))
    rows = bucketed.withColumns(
        {"_kind": F.lit(1), **{f"all_{name}": F.lit(None).cast("bigint") for name in names}}
    )

    inside = Window.partitionBy(*keys, "_bucket").orderBy("_kind", direction(order))
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        rows.unionByName(marks)
        .select(
            *keys,
            order,
            "_kind",
            *names,
            *[F.sum(name).over(upto).alias(f"cum_{name}") for name in names],
            *[F.first(f"all_{name}").over(upto).alias(f"all_{name}") for name in names],
            *[F.lead(name).over(inside).alias(f"next_{name}") for name in names],
        )
        .filter("_kind = 1")
        .drop("_kind")
    )
