"""Members of lists that meet pairwise, in cells of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstat.llm.common import stored


def cut(postings: DataFrame, cell: int, load: str | None = None, most: int = 0) -> DataFrame:
    """``postings`` (a column ``key``, and what its members carry) without lists of one, each row once per cell it is in.

    A list of more than ``cell`` members, or with more than ``most`` of ``load`` in all, is cut by hash into parts, and each
    two parts meet in a cell of their own, each part also in one alone. Rows have ``key``, ``low`` and ``high`` (the parts
    that meet), ``own`` (the row's part), then the other columns.
    """
    others = [c for c in postings.columns if c != "key"]
    cells = F.ceil(F.count("*") / cell)
    if load is not None:
        cells = F.greatest(cells, F.ceil(F.sum(load) / most))
    sizes = postings.groupBy("key").agg(F.count("*").alias("members"), cells.alias("parts")).where("members > 1")
    sizes = stored(sizes.select("key", "parts"), "list-sizes")
    return (
        postings.join(sizes, "key")
        .withColumn("own", F.pmod(F.xxhash64(*others), "parts"))
        .select("key", "own", *others, F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("met"))
        .select("key", F.least("own", "met").alias("low"), F.greatest("own", "met").alias("high"), "own", *others)
    )


def together(rows: DataFrame, *order: str) -> DataFrame:
    """The rows of ``cut`` such that cells lie together, sorted by ``order`` within."""
    return rows.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", *order)


def dealt(postings: DataFrame, cell: int, *order: str) -> DataFrame:
    """``postings`` cut into cells of ``cell`` members of a part, and dealt out by cell."""
    return together(cut(postings, cell), *order)


def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The rows of ``together`` again, such that no cell is cut between two batches, and where its cells begin."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch if held is None else pa.concat_batches([held, batch])
        place = np.stack([rows.column(i).to_numpy() for i in range(3)], axis=1)
        begins = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]).any(axis=1)]))
        if begins[-1]:
            yield rows.slice(0, int(begins[-1])), begins[:-1]
        held = rows.slice(int(begins[-1]))
    if held is not None:
        yield held, np.zeros(1, np.int64)


def pairs(begins: np.ndarray, n: int, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows i < j of one cell, about ``most`` at once. Cells begin at ``begins``, the last one ends at ``n``."""
    ends = np.repeat(np.append(begins[1:], n), np.diff(np.append(begins, n)))
    count = ends - np.arange(n) - 1
    total = np.cumsum(count)
    start = 0
    while start < n:
        stop = max(start + 1, int(np.searchsorted(total, (total[start - 1] if start else 0) + most, side="right")))
        own = count[start:stop]
        i = np.repeat(np.arange(start, stop), own)
        if len(i):
            yield i, i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(own) - own, own)
        start = stop
