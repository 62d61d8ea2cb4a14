"""Detail rows to sums: the summary, the score table and the alert table.

The rows may be compact (``operators.matching``); the sums are the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postura import schemas
from postura.functions.bands import ICONS, rag_label
from postura.functions.numbers import percent, safe_ratio
from postura.operators.matching import COPIES, copies


def _totals(detail: DataFrame) -> list[Column]:
    """Compliant and counted rows; compact rows count as often as they stand for."""
    if COPIES not in detail.columns:
        return [
            F.sum("compliance").cast("double").alias("totalok"),
            F.count("compliance").alias("total"),
        ]
    n = copies(detail)
    counted = F.sum(F.when(F.col("compliance").isNotNull(), n).otherwise(0))
    return [
        F.sum(F.col("compliance") * n).cast("double").alias("totalok"),
        counted.cast("bigint").alias("total"),
    ]


def summarise(detail: DataFrame, drop_null_keys: bool = False) -> DataFrame:
    """The summary rows of some detail rows: a partial, then a final hash aggregate.

    SQL semantics by default.  ``drop_null_keys`` gives data-frame semantics: rows with
    a NULL key are left out and a group without any compliance value sums to 0.
    """
    if drop_null_keys:
        detail = detail.dropna(subset=list(schemas.SUMMARY_KEYS))
    rolled = detail.groupBy(*schemas.SUMMARY_KEYS).agg(*_totals(detail))
    if drop_null_keys:
        rolled = rolled.withColumn("totalok", F.coalesce("totalok", F.lit(0.0)))
    return rolled


def metric_scores(detail: DataFrame) -> DataFrame:
    """Score in percent per metric, as the console shows it."""
    return (
        detail.groupBy("metric_id")
        .agg(*_totals(detail))
        .withColumn("score", percent(safe_ratio("totalok", "total", default=None), 2))
    )


def failed(total: str = "total", totalok: str = "totalok") -> Column:
    return F.col(total) - F.col(totalok)


def alert_table(detail: DataFrame) -> DataFrame:
    """Score, failures and band icon per metric and run date."""
    keys = ("datestamp", "metric_id", "title", "category", "slo", "slo_min")
    return (
        detail.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(*_totals(detail))
        .withColumns(
            {
                "score": safe_ratio("totalok", "total", default=None),
                "failed": failed(),
            }
        )
        .withColumn("icon", rag_label(labels=ICONS))
    )
