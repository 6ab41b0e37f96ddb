"""Tables in parts, of which a manifest alone says which are visible.

A part is written to a folder of its own that no reader knows yet; a new manifest then makes it visible, with all other
changes of the same call at once. A writer that dies on the way leaves what was visible before. Manifests are numbered files,
each created only if it does not exist yet, so of two writers one has to look again; one that was cut off in the
middle is not valid and does not count.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_FOLDER = "_manifest"


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _at(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _names(spark: SparkSession, path: str) -> list[str]:
    fs = _file_system(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(_at(spark, path))] if fs.exists(_at(spark, path)) else []


def _current(spark: SparkSession, path: str) -> tuple[int, dict[str, str]]:
    """Number and parts of the last valid manifest, and the number that the next one must have."""
    fs, folder = _file_system(spark, path), f"{path}/{_FOLDER}"
    numbers = sorted((int(name.split(".")[0]) for name in _names(spark, folder) if name.endswith(".json")), reverse=True)
    for number in numbers:
        stream = fs.open(_at(spark, f"{folder}/{number:09d}.json"))
        try:
            return numbers[0], json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        except json.JSONDecodeError:
            continue
        finally:
            stream.close()
    return (numbers[0] if numbers else 0), {}


def visible(spark: SparkSession, path: str) -> dict[str, str]:
    """The folders of the visible parts, by name; empty where nothing was published."""
    return _current(spark, path)[1]


def _commit(spark: SparkSession, path: str, changes: Mapping[str, str | None]) -> None:
    fs = _file_system(spark, path)
    while True:
        number, parts = _current(spark, path)
        parts = {name: folder for name, folder in {**parts, **changes}.items() if folder is not None}
        target = _at(spark, f"{path}/{_FOLDER}/{number + 1:09d}.json")
        if fs.exists(target):
            continue
        try:
            stream = fs.create(target, False)
        except Exception:
            if fs.exists(target):  # another writer was first: its changes are read, and ours added
                continue
            raise
        stream.write(json.dumps(parts, sort_keys=True).encode())
        stream.close()
        return


def publish(spark: SparkSession, path: str, parts: Mapping[str, DataFrame | None], removed: tuple[str, ...] = ()) -> None:
    """Write each part, replacing the one of its name, and make all visible at once; ``removed`` ones vanish."""
    folders: dict[str, str | None] = dict.fromkeys(removed)
    for name, df in parts.items():
        folders[name] = f"part-{uuid.uuid4().hex}"
        df.write.parquet(f"{path}/{folders[name]}")
    if folders:
        _commit(spark, path, folders)


def publish_by(spark: SparkSession, path: str, df: DataFrame, column: str) -> list[str]:
    """Write ``df`` once, a part per value of ``column``, each replacing the part of its name; returns their names."""
    folder = f"part-{uuid.uuid4().hex}"
    df.write.partitionBy(column).parquet(f"{path}/{folder}")
    names = [name for name in _names(spark, f"{path}/{folder}") if name.startswith(f"{column}=")]
    if names:
        _commit(spark, path, {name: f"{folder}/{name}" for name in names})
    return names


def read_visible(spark: SparkSession, path: str, schema: StructType | str, names: list[str] | None = None) -> DataFrame:
    """The rows of the visible parts, or of those of the given names; no part gives no rows."""
    parts = visible(spark, path)
    folders = [f"{path}/{folder}" for name, folder in sorted(parts.items()) if names is None or name in names]
    reader = spark.read.schema(schema)
    return reader.parquet(*folders) if folders else spark.createDataFrame([], schema)


def vacuum(spark: SparkSession, path: str) -> None:
    """Remove the folders that the manifest does not name. Not while others write or read older versions."""
    kept = {folder.split("/")[0] for folder in visible(spark, path).values()}
    fs = _file_system(spark, path)
    for name in _names(spark, path):
        if name.startswith("part-") and name not in kept:
            fs.delete(_at(spark, f"{path}/{name}"), True)
