"""Generic grouping by any dimensions, and the wide form charts are drawn from."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postura.functions.dates import as_column
from postura.functions.numbers import lenient_number
from postura.operators.selection import latest_only, select_series

Order = Column | str | None

# Fixed value: the label of a blank dimension.
NO_DIMENSION = "None"


def dimension_label(name: str) -> Column:
    """The value of a dimension as charts name it."""
    c = F.col(name).cast("string")
    return F.when(c.isNull() | (c == ""), F.lit(NO_DIMENSION)).otherwise(c)


def _last(field: str, order_by: Order) -> Column:
    if order_by is None:
        raise ValueError("'last' needs order_by: rows of a DataFrame have no order of their own")
    return F.max_by(lenient_number(field), as_column(order_by))


# NULL and blank values are zeros here: in sums, and in averages as well.
AGGREGATES: dict[str, Callable[[str, Order], Column]] = {
    "avg": lambda field, _: F.sum(lenient_number(field)) / F.count(F.lit(1)),
    "sum": lambda field, _: F.sum(lenient_number(field)),
    "count": lambda field, _: F.count(F.lit(1)),
    "last": _last,
}


def pivot_data(
    df: DataFrame,
    dims: Sequence[str],
    aggs: Mapping[str, tuple[str, str]],
    order_by: Order = None,
) -> DataFrame:
    """Group by ``dims``; ``aggs`` maps a result name to ``(operation, field)``."""
    unknown = {op for op, _ in aggs.values()} - AGGREGATES.keys()
    if unknown:
        raise ValueError(f"unsupported aggregation operation: {', '.join(sorted(unknown))}")
    return df.groupBy(*dims).agg(
        *[AGGREGATES[op](field, order_by).alias(name) for name, (op, field) in aggs.items()]
    )


def series_names(df: DataFrame, x: str, z: str, all_series: bool = False) -> list[str]:
    """The series a chart shows: those with a point at the last ``x``, or all.

    The caller's frame is a report (dates by dimension), so this is a short list;
    Spark's own bound on pivot columns is enforced all the same.
    """
    bound = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    source = df if all_series else latest_only(df, x)
    names = [r[0] for r in source.select(z).distinct().limit(bound + 1).collect()]
    if len(names) > bound:
        raise ValueError(f"more than {bound} series in {z!r}")
    return sorted(names)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def chart_wide(
    df: DataFrame,
    x: str,
    ys: Sequence[str],
    z: str | None = None,
    series: Sequence[str] | None = None,
    all_series: bool = False,
    order_by: Order = None,
) -> DataFrame:
    """One row per ``x``: the ``ys`` columns, or one column per value of ``z``.

    Holes and NaN become 0.  Where several rows give one cell, the last by ``order_by``
    counts.  Naming ``series`` saves the job that looks them up.
    """
    if z is None:
        wide = select_series(df, x, ys)
        values = [c for c in wide.columns if c != x]
    else:
        df = df.withColumn(z, dimension_label(z))
        values = list(series) if series is not None else series_names(df, x, z, all_series)
        y = F.col(ys[0])
        cell = F.max(y) if order_by is None else F.max_by(y, as_column(order_by))
        wide = df.groupBy(x).pivot(z, values).agg(cell)
    cells = {v: F.coalesce(F.nanvl(F.col(_quoted(v)), F.lit(0.0)), F.lit(0.0)) for v in values}
    return wide.withColumns(cells).orderBy(x)


def chart_map(
    df: DataFrame, x: str, y: str, z: str, all_series: bool = False, order_by: Order = None
) -> DataFrame:
    """The wide form without a look at the data: one row per ``x``, its ``series`` as a map.

    Series, holes and repeated cells are as in ``chart_wide``, but which series there are is found in
    the same pass, so no job runs before the result is asked for, and new series need no new schema.
    Only the points of one ``x``, and one row for each ``x``, meet in a task.
    """
    points = df.withColumn(z, dimension_label(z))
    cell = F.max(y) if order_by is None else F.max_by(F.col(y), as_column(order_by))
    cells = points.groupBy(x, z).agg(cell.cast("double").alias("_cell"))
    rows = cells.groupBy(x).agg(F.map_from_entries(F.collect_list(F.struct(z, "_cell"))).alias("_points"))
    everything = Window.partitionBy()
    if all_series:
        shown = F.array_distinct(F.flatten(F.collect_list(F.map_keys("_points")).over(everything)))
    else:
        shown = F.max_by(F.map_keys("_points"), F.col(x)).over(everything)
    rows = rows.withColumn("_shown", F.sort_array(shown))

    def filled(name: Column) -> Column:
        return F.coalesce(F.nanvl(F.col("_points")[name], F.lit(0.0)), F.lit(0.0))

    series = F.map_from_arrays("_shown", F.transform("_shown", filled)).alias("series")
    return rows.select(x, series).orderBy(x)


def series_latest(df: DataFrame, x: str, y: str, z: str) -> DataFrame:
    """The last value of each series, as a gauge shows it."""
    return df.groupBy(z).agg(F.max_by(y, x).alias(y))
