"""Calendar expressions.  "Today" is always an explicit ``as_of``; nothing reads the clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DateLike = dt.date | str | Column


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(value: DateLike) -> Column:
    """A DATE from a Python date, an ISO string or a column."""
    return value.cast("date") if isinstance(value, Column) else F.lit(value).cast("date")


def to_date_lenient(c: Column | str) -> Column:
    """Text or timestamp to DATE; ISO timestamps work, blanks and garbage give NULL."""
    return as_column(c).try_cast("date")


def age_days(c: Column | str, as_of: DateLike) -> Column:
    """Calendar days from ``c`` to ``as_of``: boundaries crossed, not 24-hour periods."""
    return F.datediff(as_date(as_of), to_date_lenient(c))


def date_minus(as_of: DateLike, days: int = 0, months: int = 0) -> Column:
    """``as_of`` less an interval; a month end is clipped (29 Feb less a year is 28 Feb)."""
    shifted = F.add_months(as_date(as_of), -months) if months else as_date(as_of)
    return F.date_sub(shifted, days) if days else shifted


def older_than(c: Column | str, as_of: DateLike, days: int) -> Column:
    return to_date_lenient(c) < date_minus(as_of, days=days)
