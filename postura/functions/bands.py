"""Red / amber / green bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postura.functions.dates import as_column

# Fixed values: (met, between minimum and target, missed).
ICONS = ("🟢", "🟡", "🔴")
STATUS = ("success", "warning", "error")


def rag_columns(
    score: Column | str = "score", slo: Column | str = "slo", slo_min: Column | str = "slo_min"
) -> dict[str, Column]:
    """Three nullable columns, of which the one for the score's band holds it."""
    s, top, low = as_column(score), as_column(slo), as_column(slo_min)
    return {
        "red": F.when(s < low, s),
        "amber": F.when((s >= low) & (s < top), s),
        "green": F.when(s >= top, s),
    }


def rag_label(
    score: Column | str = "score",
    slo: Column | str = "slo",
    slo_min: Column | str = "slo_min",
    labels: tuple[str, str, str] = STATUS,
) -> Column:
    s = as_column(score)
    met, near, missed = labels
    return F.when(s >= as_column(slo), met).when(s >= as_column(slo_min), near).otherwise(missed)
