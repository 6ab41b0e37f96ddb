"""Standard scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstat.sources.schemas import MODEL_INPUTS


def fit_scaler(train: DataFrame, cols: Sequence[str] = tuple(MODEL_INPUTS)) -> DataFrame:
    """Mean and population deviation per column, one row each; a constant column scales by 1."""
    stats = train.agg(
        *[F.avg(name).alias(f"mean_{name}") for name in cols],
        *[F.stddev_pop(name).alias(f"std_{name}") for name in cols],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("feature"),
                F.col(f"mean_{name}").alias("mean"),
                F.when(F.col(f"std_{name}") == 0, 1.0).otherwise(F.col(f"std_{name}")).alias("scale"),
            )
            for name in cols
        ]
    )
    return stats.select(F.inline(rows))


def apply_scaler(df: DataFrame, params: DataFrame, suffix: str = "") -> DataFrame:
    """Scaled columns, in place or beside the originals under a suffix; ``params`` has one row per column."""
    fitted = {row["feature"]: (row["mean"], row["scale"]) for row in params.collect()}
    return df.withColumns(
        {name + suffix: (F.col(name) - F.lit(mean)) / F.lit(scale) for name, (mean, scale) in fitted.items()}
    )
