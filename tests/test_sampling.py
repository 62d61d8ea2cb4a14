"""The samplers against the rules stated on plain lists."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from postura.operators.sampling import (
    date_rank,
    sample_dates,
    sample_row_dates,
    summary_sample,
    v_summary,
)
from postura.operators.selection import filter_options, last_year, latest_only
from tests.conftest import rows

AS_OF = dt.date(2001, 11, 4)


def table(spark, dates):
    return spark.createDataFrame([(d, i) for i, d in enumerate(dates)], "datestamp date, i int")


def days(n, last=AS_OF):
    return [last - dt.timedelta(days=k) for k in range(n)]


def picked(df):
    return sorted(r[0] for r in df.select("datestamp").distinct().collect())


def by_date_position(dates, k=12, keep_latest=False):
    dates = sorted(set(dates))
    n = len(dates)
    step = math.ceil(n / k)
    found = [d for i, d in enumerate(dates, 1) if i in (1, n) or i % step == 0]
    if keep_latest and len(found) > k:
        return [*found[: k - 1], found[-1]]
    return found[:k]


def by_row_position(dates, k=12):
    ordered = sorted(dates)
    n = len(ordered)
    if n < k:
        return sorted(set(ordered))
    step = (n - 2) // (k - 2)
    places = {0, n - 1, *list(range(1, n - 1, step))[: k - 2]}
    return sorted({ordered[p] for p in places})


@pytest.mark.parametrize("n", [1, 2, 11, 12, 13, 22, 23, 24, 34, 121, 122, 365])
@pytest.mark.parametrize("keep_latest", [False, True])
def test_even_dates(spark, n, keep_latest):
    dates = days(n)
    got = picked(sample_dates(table(spark, dates), AS_OF, keep_latest=keep_latest))
    assert got == by_date_position(dates, keep_latest=keep_latest)
    assert len(got) <= 12
    assert max(dates) in got or not keep_latest


def test_the_newest_date_can_be_cut_away(spark):
    """As the rule stands; the variant keeps it."""
    summary = table(spark, days(23))
    assert AS_OF not in picked(v_summary(summary, AS_OF))
    assert AS_OF in picked(v_summary(summary, AS_OF, keep_latest=True))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(0, 400), min_size=1, max_size=150))
def test_row_positions(spark, offsets):
    dates = [AS_OF - dt.timedelta(days=o) for o in offsets]
    in_year = [d for d in dates if d > dt.date(2000, 11, 4)]
    got = picked(sample_row_dates(table(spark, dates), AS_OF))
    assert got == by_row_position(in_year)


def test_row_sample_with_one_date_holding_a_third(spark):
    dates = [*days(100), *[AS_OF - dt.timedelta(days=50)] * 50]
    sample = summary_sample(table(spark, dates), AS_OF)
    assert picked(sample) == by_row_position(dates)
    kept = by_row_position(dates)
    assert sample.count() == sum(d in kept for d in dates)


def test_year_boundary(spark):
    boundary = dt.date(2000, 11, 4)
    summary = table(spark, [boundary, AS_OF])
    assert picked(last_year(summary, AS_OF)) == [boundary, AS_OF]
    assert picked(last_year(summary, AS_OF, inclusive=False)) == [AS_OF]
    leap = table(spark, [dt.date(2003, 2, 27), dt.date(2003, 2, 28)])
    assert picked(last_year(leap, dt.date(2004, 2, 29))) == [dt.date(2003, 2, 28)]


def test_ranks(spark):
    ranks = date_rank(table(spark, [*days(3), *days(2)]), AS_OF)
    assert rows(ranks, "row_num", "total_rows") == [(1, 3), (2, 3), (3, 3)]


def test_latest_and_options(spark):
    df = spark.createDataFrame(
        [(dt.date(2001, 1, 1), "a", "x", "l"), (dt.date(2001, 1, 2), "a", "y", None), (dt.date(2001, 1, 2), "b", "y", "l")],
        "datestamp date, business_unit string, team string, location string",
    )
    assert latest_only(df).count() == 2
    assert rows(filter_options(df)) == [
        ("business_unit", "a"),
        ("business_unit", "b"),
        ("location", "l"),
        ("location", None),
        ("team", "x"),
        ("team", "y"),
    ]
    assert latest_only(df.filter("false")).count() == 0
