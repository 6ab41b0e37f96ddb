"""Class balance, class weights and the stratified split."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardstat.functions.numbers import required
from wardstat.operators.small import settle
from wardstat.sources.schemas import TARGET


def class_balance(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Rows per class."""
    return df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))


def _weight(mode: str, target: str) -> Column:
    """Weight of a class over a table with one row per class, which is all the window sees."""
    everyone = Window.partitionBy(F.lit(0))
    if mode == "balanced":
        return F.sum("n").over(everyone) / (F.count("n").over(everyone) * F.col("n"))
    if mode == "positive":
        negatives = F.sum(F.when(F.col(target) == 0, F.col("n"))).over(everyone)
        return F.when(F.col(target) == 1, negatives / F.col("n")).otherwise(1.0)
    raise ValueError(f"unknown weighting {mode!r}")


def class_weights(df: DataFrame, target: str = TARGET, mode: str = "balanced") -> DataFrame:
    """Weight per class.

    ``balanced``: n / (classes * n_class). ``positive``: n_0 / n_1 for class 1, and 1 for the others.
    """
    return class_balance(df, target).select(target, "n", _weight(mode, target).alias("weight"))


def with_class_weight(df: DataFrame, target: str = TARGET, modes: Mapping[str, str] | None = None) -> DataFrame:
    """Rows with the weights of their class, one column per (name, mode); a row without a class stops the job."""
    return weighted(df, class_balance(df, target), target, modes)


def weighted(df: DataFrame, balance: DataFrame, target: str = TARGET, modes: Mapping[str, str] | None = None) -> DataFrame:
    """As ``with_class_weight``, with the rows per class already counted."""
    modes = modes or {"weight": "balanced"}
    weights = [_weight(mode, target).alias(name) for name, mode in modes.items()]
    checked = df.withColumn(target, required(F.col(target), target))
    return checked.join(settle(balance.select(target, *weights)), target)


def _row_hash(key: str, seed: int) -> Column:
    """32 evenly spread bits that depend on the key and the seed only."""
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def split_quotas(counts: DataFrame, label: str, test: float) -> DataFrame:
    """Test rows per class: ceil(test * n) in all, shared by largest remainder, lower label first on ties.

    ``counts`` has one row per class, so the unpartitioned windows see a handful of rows.
    """
    everyone = Window.partitionBy(F.lit(0))
    share = F.lit(Decimal(str(test)))
    sized = counts.withColumn("_all", F.sum("n").over(everyone).cast("decimal(20,0)"))
    sized = sized.withColumn("_test", F.ceil(F.col("_all") * share).cast("decimal(20,0)"))
    product = F.col("_test") * F.col("n").cast("decimal(18,0)")
    sized = sized.withColumn("_floor", F.call_function("div", product, F.col("_all")))
    sized = sized.withColumn("_rest", product - F.col("_floor").cast("decimal(18,0)") * F.col("_all"))
    place = F.row_number().over(everyone.orderBy(F.desc("_rest"), label))
    left = F.col("_test") - F.sum("_floor").over(everyone)
    return sized.select(label, (F.col("_floor") + F.when(place <= left, 1).otherwise(0)).alias("quota"))


def stratified_split(
    df: DataFrame, key: str = "encounter_id", label: str = TARGET, test: float = 0.2, seed: int = 42
) -> DataFrame:
    """Rows with a ``split`` column, ``test`` or ``train``, of exact sizes per class.

    Per class, the test rows are the first ``quota`` rows by (hash of key, key). Counts of 65,536 hash
    buckets show in which bucket the quota ends, and only that bucket is ranked, to find the last
    test row. Membership is then a comparison with that row: the table itself is never shuffled, and the
    answer depends on the keys alone, not on partitions or retries.
    """
    hashed = df.select(
        required(F.col(label), label).alias(label), F.col(key), _row_hash(key, seed).alias("_hash")
    ).withColumn("_bucket", F.shiftright("_hash", 16))
    buckets = hashed.groupBy(label, "_bucket").agg(F.count(F.lit(1)).alias("n"))
    quotas = split_quotas(buckets.groupBy(label).agg(F.sum("n").alias("n")), label, test)
    cumulated = F.sum("n").over(Window.partitionBy(label).orderBy("_bucket"))
    ends = (
        buckets.withColumn("_upto", cumulated)
        .join(quotas, label)
        .filter((F.col("_upto") - F.col("n") < F.col("quota")) & (F.col("quota") <= F.col("_upto")))
        .select(label, "_bucket", (F.col("quota") - F.col("_upto") + F.col("n")).alias("_needed"))
    )
    nth = F.row_number().over(Window.partitionBy(label).orderBy("_hash", key))
    last = (
        hashed.join(settle(ends), [label, "_bucket"])
        .withColumn("_nth", nth)
        .filter(F.col("_nth") == F.col("_needed"))
        .select(label, F.col("_hash").alias("_last_hash"), F.col(key).alias("_last_key"))
    )
    own = df.withColumn("_hash", _row_hash(key, seed))
    earlier = F.col("_hash") < F.col("_last_hash")
    same = (F.col("_hash") == F.col("_last_hash")) & (F.col(key) <= F.col("_last_key"))
    return own.join(settle(last), label, "left").select(
        *df.columns, F.when(earlier | same, "test").otherwise("train").alias("split")
    )
