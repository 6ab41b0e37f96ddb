"""Bands and labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed band edges and names.
AGE_LABELS = ["0-30", "31-50", "51-70", "71+"]
AGE_EDGES_SUMMARY = [0, 30, 50, 70, 110]
AGE_EDGES_EXPORT = [0, 30, 50, 70, 120]


def age_band(col: Column) -> Column:
    """Band by closed whole-number ranges; everything outside them, null too, falls in the last band."""
    return (
        F.when(col.between(0, 30), "0-30")
        .when(col.between(31, 50), "31-50")
        .when(col.between(51, 70), "51-70")
        .otherwise("71+")
    )


def cut(col: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the right-closed bin ``(edges[i], edges[i+1]]``; null outside all bins."""
    band = F.when(F.lit(False), F.lit(None).cast("string"))
    for low, high, label in zip(edges[:-1], edges[1:], labels, strict=True):
        band = band.when((col > low) & (col <= high), label)
    return band


def map_labels(col: Column, labels: Mapping) -> Column:
    """Label of a code; null for a code that is not in the mapping."""
    named = F.when(F.lit(False), F.lit(None).cast("string"))
    for code, label in labels.items():
        named = named.when(col == code, label)
    return named
