"""Thinning the history to at most twelve evenly spaced dates.

Both samplers decide on the distinct dates of one year.  Windows without a partition
are used on those dates only: a DATE column has at most 366 values in a year, however
many rows the summary has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postura.functions.dates import DateLike
from postura.operators.selection import last_year

# Fixed value: dates a report shows.
MAX_DATES = 12


def date_rank(summary: DataFrame, as_of: DateLike) -> DataFrame:
    """Distinct dates of the last year with their position and their number."""
    dates = last_year(summary, as_of).select("datestamp").distinct()
    return dates.withColumns(
        {
            "row_num": F.row_number().over(Window.orderBy("datestamp")).cast("bigint"),
            "total_rows": F.count(F.lit(1)).over(Window.partitionBy()),
        }
    )


def sample_dates(
    summary: DataFrame, as_of: DateLike, k: int = MAX_DATES, keep_latest: bool = False
) -> DataFrame:
    """First, last and every ``ceil(n/k)``-th date, of these the first ``k``.

    The cut is part of the rule: when more than ``k`` dates qualify it takes the newest
    away.  ``keep_latest`` instead gives the newest the last of the ``k`` places.
    """
    n, pos = F.col("total_rows"), F.col("row_num")
    step = F.ceil(n / F.lit(float(k)))
    candidates = date_rank(summary, as_of).filter((pos == n) | (pos == 1) | (pos % step == 0))
    if keep_latest:
        by_date, everything = Window.orderBy("datestamp"), Window.partitionBy()
        ranked = candidates.select(
            "datestamp",
            F.row_number().over(by_date).alias("_rank"),
            F.count(F.lit(1)).over(everything).alias("_n"),
        )
        candidates = ranked.filter((F.col("_rank") < k) | (F.col("_rank") == F.col("_n")))
        return candidates.select("datestamp").orderBy("datestamp")
    return candidates.select("datestamp").orderBy("datestamp").limit(k)


def v_summary(
    summary: DataFrame, as_of: DateLike, k: int = MAX_DATES, keep_latest: bool = False
) -> DataFrame:
    """Summary rows of the sampled dates, all of them.

    The limit gives the dates a known size, so they are broadcast and prune the date
    partitions of ``summary`` while it is being read.
    """
    return summary.join(sample_dates(summary, as_of, k, keep_latest), "datestamp").select(
        *summary.columns
    )


def sample_row_dates(
    summary: DataFrame, as_of: DateLike, k: int = MAX_DATES
) -> DataFrame:
    """Dates found at evenly spaced *row* positions of the date-ordered last year.

    With fewer than ``k`` rows every date counts.  Otherwise the positions are the
    first, the last and ``k - 2`` more at a fixed step from the second.  Rows are not
    sorted: counts per date give the range of positions each date covers.
    """
    if k < 3:
        raise ValueError("the first, the last and a date between them take k >= 3")
    inner = k - 2
    upto = Window.orderBy("datestamp").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    dates = (
        last_year(summary, as_of, inclusive=False)
        .groupBy("datestamp")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumns(
            {"_end": F.sum("_rows").over(upto), "_n": F.sum("_rows").over(Window.partitionBy())}
        )
        .withColumn("_start", F.col("_end") - F.col("_rows"))
    )
    n = F.col("_n")
    step = F.floor((n - 2) / inner)
    spaced = F.transform(F.sequence(F.lit(0), F.lit(inner - 1)), lambda i: i * step + 1)
    targets = F.concat(F.array(F.lit(0).cast("bigint"), n - 1), F.filter(spaced, lambda p: p < n - 1))
    hit = F.exists(targets, lambda p: (p >= F.col("_start")) & (p < F.col("_end")))
    # At most k positions, so at most k dates.
    return dates.filter((n < k) | hit).select("datestamp")


def summary_sample(summary: DataFrame, as_of: DateLike, k: int = MAX_DATES) -> DataFrame:
    """The summary rows that go into the published CSV."""
    return summary.join(sample_row_dates(summary, as_of, k), "datestamp", "left_semi")
