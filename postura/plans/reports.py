"""The reports, each a function of the summary and the reader's filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postura.functions.bands import rag_label
from postura.functions.numbers import percent
from postura.operators.pivots import chart_map, chart_wide, series_latest
from postura.operators.scoring import (
    Filters,
    metric_cards,
    categories_ranked,
    weighted_score,
    weighted_trend,
    with_bands,
)


def overview_rag(summary: DataFrame, filters: Filters = None) -> DataFrame:
    """Organisation score per date in its band's column."""
    return with_bands(weighted_trend(summary, filters), "datestamp").orderBy("datestamp")


def categories_rag(summary: DataFrame, filters: Filters = None) -> DataFrame:
    """Score per category at the newest date in its band's column, worst first."""
    return with_bands(categories_ranked(summary, filters), "category")


def overview_page(
    summary: DataFrame, filters: Filters = None, business_units: Sequence[str] | None = None
) -> dict[str, DataFrame]:
    """Organisation trend with targets, and one score column per business unit.

    ``business_unit_series`` has the same scores as a map: it needs no names and no job to find them.
    """
    by_unit = weighted_score(summary, filters, "business_unit")
    return {
        "organisation": chart_wide(
            weighted_score(summary, filters), "datestamp", ["value", "slo", "slo_min"]
        ),
        "business_units": chart_wide(
            by_unit, "datestamp", ["value"], "business_unit", series=business_units
        ),
        "business_unit_series": chart_map(by_unit, "datestamp", "value", "business_unit"),
    }


def category_sparkline(summary: DataFrame, filters: Filters = None) -> DataFrame:
    """Every point of every category's line, beside the category's latest value."""
    points = weighted_score(summary, filters, "category").select("category", "datestamp", "value")
    latest = F.max_by("value", "datestamp").over(Window.partitionBy("category"))
    return points.withColumn("gauge", percent(latest, 2, "half_up"))


def metric_page(summary: DataFrame, metric_id: str, filters: Filters = None) -> DataFrame:
    """One metric's score and targets over time."""
    chosen = {**(filters or {}), "metric_id": metric_id}
    trend = weighted_score(summary, chosen, "category")
    return chart_wide(trend, "datestamp", ["value", "slo", "slo_min"])


def metrics_page(summary: DataFrame, filters: Filters = None) -> DataFrame:
    """Categories with their latest score, and in each the cards of its metrics."""
    gauges = series_latest(
        weighted_score(summary, filters, "category"), "datestamp", "value", "category"
    ).select("category", percent("value", 2, "half_up").alias("category_score"))
    cards = metric_cards(summary, filters).select(
        "category",
        "metric_id",
        "title",
        percent("score", 0, "half_up").cast("bigint").alias("score_percent"),
        percent("slo", 0, "half_up").cast("bigint").alias("target_percent"),
        rag_label().alias("status"),
    )
    return cards.join(gauges, "category")
