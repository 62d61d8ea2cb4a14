"""Number expressions shared by the roll-ups and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postura.functions.dates import as_column


def lenient_number(c: Column | str) -> Column:
    """Text or number to DOUBLE; NULL, blank and non-numeric text count as 0."""
    return F.coalesce(as_column(c).try_cast("double"), F.lit(0.0))


def safe_ratio(a: Column | str, b: Column | str, default: float | None = 0.0) -> Column:
    """``a / b``, or ``default`` (which may be None) where the division has no answer."""
    ratio = F.try_divide(as_column(a), as_column(b))
    return ratio if default is None else F.coalesce(ratio, F.lit(default))


def percent(score: Column | str, digits: int = 2, mode: str = "half_even") -> Column:
    """``score`` in percent, rounded on the binary double.

    ``half_even`` is what console tables and alert lines show, ``half_up`` what
    charts and cards show.  Both stay in generated code; no decimals are built.
    """
    scale = float(10**digits)
    scaled = as_column(score) * F.lit(100.0) * F.lit(scale)
    if mode == "half_even":
        return F.rint(scaled) / F.lit(scale)
    if mode == "half_up":
        return F.floor(scaled + F.lit(0.5)).cast("double") / F.lit(scale)
    raise ValueError(f"unknown rounding mode {mode!r}")


def plain_number(c: Column | str) -> Column:
    """A number as text, without a trailing ``.0`` when it is whole."""
    value = as_column(c).cast("double")
    whole = value.cast("bigint")
    return F.when(value == whole, whole.cast("string")).otherwise(value.cast("string"))
