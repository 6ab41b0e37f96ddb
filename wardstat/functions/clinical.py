"""Feature rules for one encounter, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the feature rules.
FALLBACK_AGE = 55
INSULIN_IN_USE = ["Up", "Down", "Steady"]
A1C_HIGH = [">8", ">7"]
ICD9_DIABETES = [(250, 251)]
ICD9_CIRCULATORY = [(390, 460), (785, 786)]
ICD9_RESPIRATORY = [(460, 520), (786, 787)]

_BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_NUMBER_CHARACTERS = "0123456789+-.eE"


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it fails or is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def differs(col: Column, value: str) -> Column:
    """1 unless ``col`` equals ``value``; an unknown value counts as different."""
    return (~col.eqNullSafe(F.lit(value))).cast("int")


def age_bounds(col: Column) -> Column:
    """The texts between the dashes of an age bracket such as ``[50-60)``, brackets dropped."""
    return F.split(F.translate(col, "[]()", ""), "-")


def age_midpoint(bounds: Column) -> Column:
    """Whole-number middle of two age bounds; 55 unless there are exactly two whole numbers."""
    low, high = F.get(bounds, F.lit(0)).try_cast("long"), F.get(bounds, F.lit(1)).try_cast("long")
    middle = F.when(F.size(bounds) == 2, F.shiftright(low + high, 1))
    return F.coalesce(middle, F.lit(FALLBACK_AGE)).cast("int")


def icd9_number(col: Column) -> Column:
    """The code as a number; null for E and V codes and for anything that is not a plain decimal.

    The character check keeps out what only Spark's cast takes for a number (``250d``, ``inf``), without
    a regular expression per row.
    """
    text = F.btrim(col, F.lit(_BLANKS))
    plain = (F.translate(text, _NUMBER_CHARACTERS, "") == "") & ~text.startswith("E")
    return F.when(plain, text.try_cast("double"))


def in_ranges(number: Column, ranges: list[tuple[float, float]]) -> Column:
    """1 where the number lies in one of the half-open ranges."""
    hit = F.lit(False)
    for low, high in ranges:
        hit = hit | ((number >= low) & (number < high))
    return flag(hit)
