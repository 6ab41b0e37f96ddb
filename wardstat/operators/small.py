"""Sides of a join that are small by construction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def settle(side: DataFrame) -> DataFrame:
    """``side`` as fixed rows marked for broadcast. Only for sides with a row per class, model or group of a summary;
    what they are computed from is then read once, and not again by the join's plan."""
    return F.broadcast(side.sparkSession.createDataFrame(side.collect(), side.schema))
