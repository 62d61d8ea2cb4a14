"""Row selection on the summary: latest date, trailing year, filter options."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postura import schemas
from postura.functions.dates import DateLike, date_minus


def latest_only(df: DataFrame, date_col: str = "datestamp") -> DataFrame:
    """Rows of the newest date.

    The newest date is a scalar subquery: it is known before the rows are read, so on a
    date-partitioned table only that date's files are opened.
    """
    newest = df.agg(F.max(date_col)).scalar()
    return df.filter(F.col(date_col) == newest)


def last_year(
    df: DataFrame, as_of: DateLike, inclusive: bool = True, date_col: str = "datestamp"
) -> DataFrame:
    """Rows of the year up to ``as_of``; the boundary date itself counts if ``inclusive``."""
    start = date_minus(as_of, months=12)
    c = F.col(date_col)
    return df.filter(c >= start if inclusive else c > start)


def filter_options(df: DataFrame, dims: Sequence[str] = schemas.DIMENSIONS) -> DataFrame:
    """The distinct values of each dimension as ``(dimension, value)``, in one pass.

    Combinations are made distinct before they are unpivoted, so the fact rows are
    never multiplied.
    """
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value")) for d in dims])
    return (
        df.select(*dims)
        .distinct()
        .select(F.explode(pairs).alias("o"))
        .select("o.*")
        .distinct()
    )


def select_series(df: DataFrame, x: str, ys: Sequence[str]) -> DataFrame:
    """The chart's columns, as far as they exist."""
    wanted = dict.fromkeys([x, *ys])
    return df.select(*[c for c in wanted if c in df.columns])
