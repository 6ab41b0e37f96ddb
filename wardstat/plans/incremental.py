"""Results that follow their input: only what arrives or changes is read."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstat.operators import segments
from wardstat.operators.cohort import DEATH_OR_HOSPICE, drop_values, first_per_key, known_rows
from wardstat.sources.encounters import NA_TOKENS
from wardstat.sources.manifest import publish, publish_by, read_visible, visible
from wardstat.sources.schemas import FEATURES
from wardstat.sources.tables import read_table

#: Parts of the cohort's state; new rows rewrite only the parts of their patients.
PATIENT_PARTS = 256
_PART = "patient_part"


def merge_encounters(
    raw: DataFrame, path: str, na_tokens: Iterable[str] = NA_TOKENS, key: str = "patient_nbr", order: str = "encounter_id"
) -> list[str]:
    """Merge raw encounters into the first known one of each patient, kept at ``path``; returns the parts rewritten.

    The order of arrival doesn't matter: an earlier encounter that arrives late takes the place of the later one, and
    rows that arrive again change nothing. The disposition is looked at by ``merged_cohort`` only, so that a first
    encounter that ended in death or hospice keeps hiding later ones.
    """
    spark = raw.sparkSession
    part = F.pmod(F.xxhash64(key), F.lit(PATIENT_PARTS)).cast("int")
    new = first_per_key(known_rows(raw, na_tokens), key, order)
    touched = [f"{_PART}={row[0]}" for row in new.select(part).distinct().collect()]
    held = read_visible(spark, path, new.schema, touched)
    return publish_by(spark, path, first_per_key(held.unionByName(new), key, order).withColumn(_PART, part), _PART)


def merged_cohort(spark: SparkSession, path: str, schema, disposition: str = "discharge_disposition_id") -> DataFrame:
    """The cohort of all encounters merged so far, as ``build_cohort`` would find it in all of them together."""
    return drop_values(read_visible(spark, path, schema), disposition, DEATH_OR_HOSPICE)


def _signature(spark: SparkSession, folder: str) -> str:
    """Changes when a file of the folder is added, removed or written anew."""
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    files = sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(target))
    return hashlib.sha256(repr(files).encode()).hexdigest()[:16]


def refresh_kpis_by_part(spark: SparkSession, parts: Mapping[str, str], path: str, kind: str = "sql") -> list[str]:
    """Bring the KPI sums at ``path`` up to date with the feature folders ``parts``; returns the parts that were read.

    Of each part the sums per combination of labels are kept, some hundred rows. A part is read again only if its files
    changed; sums of parts that are no longer given vanish.
    """
    known = visible(spark, path)
    wanted = {f"{name}@{_signature(spark, folder)}": (name, folder) for name, folder in parts.items()}
    new = {stamp: own for stamp, own in wanted.items() if stamp not in known}
    sums = {
        stamp: segments.label_sums(read_table(spark, folder, FEATURES), segments.named_segments(kind)).coalesce(1)
        for stamp, (_, folder) in new.items()
    }
    publish(spark, path, sums, tuple(stamp for stamp in known if stamp not in wanted))
    return sorted(name for name, _ in new.values())


def kpis_by_part(spark: SparkSession, path: str, kind: str = "sql") -> DataFrame:
    """The KPI table of all parts together, from their sums."""
    chosen = segments.named_segments(kind)
    schema = segments.label_sums(spark.createDataFrame([], FEATURES), chosen).schema
    return segments.kpis_of_sums(read_visible(spark, path, schema), chosen)
