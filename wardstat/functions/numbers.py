"""Exact rounding of ratios, and casts that refuse bad input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_ratio(num: Column, den: Column, digits: int, scale: int = 1) -> Column:
    """``scale * num / den`` rounded half away from zero at ``digits``; null when ``den`` is 0 or null.

    Both sides must be whole numbers; a fraction stops the job. The quotient is taken in integers, so no digit is
    lost to binary fractions and the answer does not depend on the order rows were summed in.
    """
    step = 10**digits
    whole = _whole(num)
    parts = F.nullif(_whole(den), F.lit(0).cast("decimal(20,0)"))
    doubled = F.abs(whole) * F.lit(2 * scale * step).cast("decimal(10,0)") + parts
    units = F.call_function("div", doubled, parts * F.lit(2).cast("decimal(1,0)"))
    return F.when(whole < 0, -units).otherwise(units).cast("double") / F.lit(float(step))


def _whole(value: Column) -> Column:
    whole = value.cast("decimal(20,0)")
    broken = value.cast("double") != whole.cast("double")
    return F.when(broken, F.raise_error(F.lit("a sum or count that must be whole has a fraction"))).otherwise(whole)


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den`` as a double, null where ``den`` is 0."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def required(value: Column, name: str) -> Column:
    """``value``, or an error that names the column where it is null."""
    return F.coalesce(value, F.raise_error(F.lit(f"column {name} holds a null or a value that is not a number")))


def whole_number(text: Column, kind: str = "int") -> Column:
    """A text as a whole number: fractions are cut off, anything that is not a decimal becomes null."""
    return F.coalesce(text.try_cast(kind), text.try_cast("decimal(38,18)").try_cast(kind))
