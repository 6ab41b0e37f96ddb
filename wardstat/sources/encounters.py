"""Raw encounter files."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegralType, StringType, StructField, StructType

from wardstat.functions.numbers import whole_number
from wardstat.sources.schemas import FEATURES, MODEL_INPUTS, RAW
from wardstat.sources.tables import CSV_FORMAT

# Fixed texts that stand for "no value". The default keeps the word None as a category of its own.
NA_TOKENS = ["?", ""]
# Fixed list: what a pandas CSV reader also takes for a missing value, plus the question mark.
PANDAS_NA_TOKENS = [
    "?", "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def _without(col: Column, tokens: list[str]) -> Column:
    return F.when(~col.isin(tokens), col) if tokens else col


def normalise_nulls(df: DataFrame, tokens: Iterable[str] = NA_TOKENS) -> DataFrame:
    """Null in every text cell that holds exactly one of the tokens."""
    tokens = list(tokens)
    texts = [field.name for field in df.schema if isinstance(field.dataType, StringType)]
    return df.withColumns({name: _without(F.col(f"`{name}`"), tokens) for name in texts})


def _read_text(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    """Every column as text, named by the header; column order is free, but one for all files of the path.

    A line with too few or too many cells stops the job, and so does a file with another header.
    """
    options = {**CSV_FORMAT, "multiLine": multi_line, "inferSchema": False}
    text = StructType([StructField(name, StringType(), True) for name in spark.read.options(**options).csv(path).columns])
    return spark.read.schema(text).options(**options, enforceSchema=False, mode="FAILFAST").csv(path)


def _is_number(token: str) -> bool:
    try:
        return math.isfinite(float(token))
    except ValueError:
        return False


def _typed(df: DataFrame, schema: StructType, tokens: Iterable[str]) -> DataFrame:
    """Known columns in their type, tokens as null; a text that is no number is null in a number column."""
    tokens = list(tokens)
    numeric_tokens = [token for token in tokens if _is_number(token)]
    kinds = {field.name: field.dataType for field in schema if isinstance(field.dataType, IntegralType)}
    fractions = {field.name for field in schema if isinstance(field.dataType, DoubleType)}
    columns = []
    for name in df.columns:
        text = F.col(f"`{name}`")
        if name in kinds:
            columns.append(whole_number(_without(text, numeric_tokens), kinds[name].simpleString()).alias(name))
        elif name in fractions:
            columns.append(_without(text, numeric_tokens).try_cast("double").alias(name))
        else:
            columns.append(_without(text, tokens).alias(name))
    return df.select(columns)


def read_encounters(
    spark: SparkSession, path: str, na_tokens: Iterable[str] = NA_TOKENS, multi_line: bool = False
) -> DataFrame:
    """Scan delimited encounter files with a header line; unknown columns stay text.

    The only eager step reads the header line. Columns nobody asks for are never parsed. Cells with line breaks need
    ``multi_line``; such files are read by one task each.
    """
    return _typed(_read_text(spark, path, multi_line), RAW, na_tokens)


def read_feature_rows(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Scan delimited files of engineered rows, the input of batch scoring; model inputs keep their fractions."""
    inputs = StructType([StructField(name, DoubleType(), True) for name in MODEL_INPUTS])
    rest = [field for field in FEATURES if field.name not in MODEL_INPUTS]
    return _typed(_read_text(spark, path, multi_line), StructType([*inputs, *rest]), NA_TOKENS)
