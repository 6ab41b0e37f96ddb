"""Run registered queries and their SQL side by side: ``python -m checks.compare SF_DIR [NAME ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

from checks.oracles import ORACLES
from checks.queries import QUERIES
from wardstat.session import session


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def _key(row: tuple) -> tuple:
    return tuple((value is None, str(value)) for value in row)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    rows = [tuple(_plain(row[name]) for name in names) for row in df.collect()]
    return names, sorted(rows, key=_key)


def oracle_rows(connection, sql: str) -> tuple[list[str], list[tuple]]:
    result = connection.execute(sql)
    columns = [entry[0] for entry in result.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(_plain(row[i]) for i in order) for row in result.fetchall()]
    return [columns[i] for i in order], sorted(rows, key=_key)


def connect(sf_dir: str):
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def difference(spark, connection, sf_dir: str, name: str) -> str | None:
    """What differs between a query and its SQL, or None."""
    names, rows = spark_rows(QUERIES[name](spark, sf_dir))
    expected_names, expected = oracle_rows(connection, ORACLES[name])
    if names != expected_names:
        return f"columns {names} != {expected_names}"
    if len(rows) != len(expected):
        return f"{len(rows)} rows != {len(expected)}"
    for row, other in zip(rows, expected):
        if row != other:
            return f"{dict(zip(names, row))} != {dict(zip(names, other))}"
        if [type(a) for a in row] != [type(b) for b in other]:
            return f"types {row} != {other}"
    return None


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:] or [name for name in QUERIES if name in ORACLES]
    spark = session("compare", "local[8]", 8)
    spark.sparkContext.setLogLevel("OFF")
    connection, failed = connect(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            problem = difference(spark, connection, sf_dir, name)
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:26s} {time.time() - start:6.2f}s {'ok' if problem is None else problem}", flush=True)
    print(f"{len(names) - failed} of {len(names)} equal")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
