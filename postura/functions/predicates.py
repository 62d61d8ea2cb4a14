"""Boolean expressions of metrics and report filters."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the filter choice meaning "no filter".
ALL = "All"


def compliance(condition: Column) -> Column:
    """1.0 where the condition holds; false and unknown are both 0.0."""
    return F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0))


def holds(condition: Column) -> Column:
    """The condition with unknown read as false."""
    return F.coalesce(condition, F.lit(False))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _equal(df: DataFrame, wanted: Mapping[str, object]) -> DataFrame:
    for name, value in wanted.items():
        df = df.filter(F.col(name) == F.lit(value))
    return df


def match_criteria(df: DataFrame, filters: Mapping[str, object] | None) -> DataFrame:
    """Equality filters of a chart: null, blank, 0 and False are no filter."""
    return _equal(df, {k: v for k, v in (filters or {}).items() if v})


def match_present(df: DataFrame, filters: Mapping[str, object] | None) -> DataFrame:
    """Equality filters of a weighted score: null and blank are no filter; 0 and False filter."""
    return _equal(df, {k: v for k, v in (filters or {}).items() if v is not None and v != ""})


def match_choices(df: DataFrame, filters: Mapping[str, object] | None, all_value: str = ALL) -> DataFrame:
    """Equality filters of a report: only the "all" choice is no filter; a blank matches blanks."""
    return _equal(df, {k: v for k, v in (filters or {}).items() if v != all_value})
