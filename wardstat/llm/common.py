"""Tables, scratch tables in the shared folder and Arrow batches of bounded size."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from wardstat.session import stored

__all__ = ["CHUNK_BYTES", "Shared", "aside", "chunks", "fresh", "held_out", "sql_type", "stored", "table", "text_of"]

#: Text bytes that a Python worker works on at once; a longer document is worked on alone.
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Shared:
    """A value of bounded size that every executor gets once. Classes of this package travel with it."""

    def __init__(self, spark: SparkSession, value: object):
        self.held = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def load(self) -> Any:
        return pickle.loads(self.held.value)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def held_out(key: str, modulus: int, remainder: int) -> Column:
    """True where crc32 of the key as text leaves ``remainder``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def fresh(columns: list[str], name: str) -> str:
    """``name``, lengthened until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def aside(docs: DataFrame, *reserved: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns of reserved names renamed, and how to name them back."""
    names = {}
    for c in docs.columns:
        if c.lower() in reserved:
            names[c] = fresh([*docs.columns, *names.values(), *reserved], c)
    return docs.withColumnsRenamed(names), {new: old for old, new in names.items()}


def sql_type(df: DataFrame, column: str) -> DataType:
    return df.schema[column].dataType


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches of at most ``limit`` text bytes, or of one row."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(text)).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            size = size or 0
            if i > start and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)
