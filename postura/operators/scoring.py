"""Weighted scores.

All of them have two layers.  The first turns summary rows into one row per metric and
date (and dimension); it is combined map-side, so what is shuffled is that small result
and not the summary.  The second weighs the metrics against each other.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postura.functions.bands import rag_columns
from postura.functions.dates import as_column
from postura.functions.numbers import safe_ratio
from postura.functions.predicates import match_choices, match_criteria, match_present
from postura.operators.pivots import dimension_label
from postura.operators.selection import latest_only

Filters = Mapping[str, object] | None

def _weighted(summary: DataFrame, filters: Filters, axis: str) -> DataFrame:
    """SQL report rule: a metric counts once per weight, targets are plain averages."""
    per_metric = (
        match_choices(summary, filters)
        .groupBy("metric_id", axis, "weight")
        .agg(
            F.sum("totalok").alias("_ok"),
            F.sum("total").alias("_all"),
            F.avg("slo").alias("slo"),
            F.avg("slo_min").alias("slo_min"),
        )
        .withColumn("_weighted", safe_ratio("_ok", "_all", default=None) * F.col("weight"))
    )
    return per_metric.groupBy(axis).agg(
        F.try_divide(F.sum("_weighted"), F.sum("weight")).alias("score"),
        F.avg("slo").alias("slo"),
        F.avg("slo_min").alias("slo_min"),
    )


def weighted_trend(summary: DataFrame, filters: Filters = None) -> DataFrame:
    """Organisation score and targets per date."""
    return _weighted(summary, filters, "datestamp")


def weighted_categories(summary: DataFrame, filters: Filters = None) -> DataFrame:
    """Score and targets per category, at the newest date of the whole ``summary``."""
    return _weighted(latest_only(summary), filters, "category")


def with_bands(scores: DataFrame, axis: str) -> DataFrame:
    return scores.select(axis, *[c.alias(n) for n, c in rag_columns().items()])


def categories_ranked(summary: DataFrame, filters: Filters = None) -> DataFrame:
    """Categories from worst to best, with their place.

    The window has no partition; its input is one row per category.
    """
    worst_first = Window.orderBy("score", "category")
    return (
        weighted_categories(summary, filters)
        .withColumn("rank", F.row_number().over(worst_first).cast("bigint"))
        .orderBy("rank")
    )


def weighted_score(
    summary: DataFrame,
    filters: Filters = None,
    dimension: str | None = None,
    order_by: Column | str | None = None,
) -> DataFrame:
    """Dashboard rule: per metric the *last* weight and targets count, whatever their number.

    A table has no last row, so ``order_by`` names the order.  Without it the largest
    value is taken, which is the same wherever a metric's targets are constant on a date,
    as they are in every summary a run writes.

    A metric whose total is 0 has no score, and neither has any group it belongs to.
    """
    rows = match_present(summary, filters)
    keys = ["datestamp"]
    if dimension is not None:
        rows = rows.withColumn(dimension, dimension_label(dimension))
        keys.append(dimension)

    def last(name: str) -> Column:
        chosen = F.max(name) if order_by is None else F.max_by(name, as_column(order_by))
        return chosen.alias(name)

    layer = [*keys, "metric_id"] if dimension != "metric_id" else keys
    per_metric = (
        rows.groupBy(*layer)
        .agg(
            F.sum("totalok").alias("_ok"),
            F.sum("total").alias("_all"),
            *[last(n) for n in ("weight", "slo", "slo_min")],
        )
        .withColumn("_score", safe_ratio("_ok", "_all", default=None))
    )
    weighted = F.sum(F.col("_score") * F.col("weight"))
    weights = F.sum("weight")
    unscored = F.count("_score") < F.count(F.lit(1))
    return per_metric.groupBy(*keys).agg(
        F.when(weights > 0, F.when(~unscored, F.try_divide(weighted, weights)))
        .otherwise(F.lit(0.0))
        .alias("value"),
        F.avg("slo").alias("slo"),
        F.avg("slo_min").alias("slo_min"),
    )


def _measured(summary: DataFrame, filters: Filters, keys: list[str]) -> DataFrame:
    """Score, weight and targets of each group; a missing number counts as 0."""
    return (
        match_criteria(summary, filters)
        .fillna(0, ["total", "totalok", "weight", "slo", "slo_min"])
        .groupBy(*keys)
        .agg(
            F.sum("totalok").alias("sum_totalok"),
            F.sum("total").cast("double").alias("sum_total"),
            *[F.avg(c).alias(c) for c in ("weight", "slo", "slo_min")],
        )
        .withColumn("score", safe_ratio("sum_totalok", "sum_total"))
    )


def metric_cards(summary: DataFrame, filters: Filters = None) -> DataFrame:
    """The newest score of each metric; "newest" is decided per title.

    Rows are aggregated first.  The window per title then sees one row per date and
    metric, not the summary rows of a title.
    """
    newest = F.max("datestamp").over(Window.partitionBy("title"))
    return (
        _measured(summary, filters, ["datestamp", "category", "title", "metric_id"])
        .withColumn("_newest", newest)
        .filter(F.col("datestamp") == F.col("_newest"))
        .drop("_newest")
    )


def cards_by_category(summary: DataFrame, filters: Filters = None) -> DataFrame:
    """The cards as one array per category; a category holds as many as it has metrics."""
    cards = metric_cards(summary, filters)
    fields = ["title", *[c for c in cards.columns if c not in ("category", "title")]]
    return cards.groupBy("category").agg(
        F.sort_array(F.collect_list(F.struct(*fields))).alias("cards")
    )


def with_weight_total(df: DataFrame, keys: list[str]) -> DataFrame:
    """The weight total of each group beside its rows; one row per metric in a group."""
    return df.withColumn("sum_weight", F.sum("weight").over(Window.partitionBy(*keys)))


def weighted_targets(summary: DataFrame, filters: Filters = None, dim: str = "category") -> DataFrame:
    """Score *and* targets weighted by metric, per date and dimension."""
    keys = ["datestamp", dim]
    layer = list(dict.fromkeys(["datestamp", "metric_id", dim]))
    beside = with_weight_total(_measured(summary, filters, layer), keys)

    def final(name: str) -> Column:
        return safe_ratio(F.sum(F.col(name) * F.col("weight")), F.max("sum_weight"))

    return beside.groupBy(*keys).agg(
        final("score").alias("score_final"),
        final("slo").alias("slo_final"),
        final("slo_min").alias("slo_min_final"),
    )
