from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from postura.functions.bands import ICONS, rag_columns, rag_label
from postura.functions.dates import age_days, date_minus, older_than, to_date_lenient
from postura.functions.numbers import lenient_number, percent, plain_number, safe_ratio
from postura.functions.predicates import compliance, holds, match_choices, match_criteria, match_present
from tests.conftest import rows

AS_OF = dt.date(2001, 8, 2)


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_dates_from_text(spark):
    texts = ["2001-07-03", "2001-07-03T10:00:00.000Z", "2001-07-03 23:59:59", "", "soon", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    day = dt.date(2001, 7, 3)
    got = [r[1] for r in rows(df, "i", to_date_lenient("t"))]
    assert got == [day, day, day, None, None, None]


def test_age_counts_day_boundaries(spark):
    late = F.lit("2001-08-01 23:59:59").cast("timestamp")
    assert one(spark, age_days(late, AS_OF)) == (1,)
    assert one(spark, age_days(F.lit("2001-08-10"), AS_OF)) == (-8,)


def test_intervals_clip_month_ends(spark):
    assert one(spark, date_minus("2004-02-29", months=12), date_minus(AS_OF, days=14)) == (
        dt.date(2003, 2, 28),
        dt.date(2001, 7, 19),
    )
    assert one(spark, older_than(F.lit("2001-07-19"), AS_OF, 14)) == (False,)
    assert one(spark, older_than(F.lit("2001-07-18"), AS_OF, 14)) == (True,)


def test_unknown_conditions(spark):
    unknown = F.lit(None).cast("boolean")
    assert one(spark, compliance(unknown), holds(unknown), compliance(F.lit(True))) == (0.0, False, 1.0)


def test_ratio_and_numbers(spark):
    got = one(
        spark,
        safe_ratio(F.lit(1), F.lit(0)),
        safe_ratio(F.lit(1), F.lit(0), default=None),
        safe_ratio(F.lit(1), F.lit(4)),
        lenient_number(F.lit("12.5")),
        lenient_number(F.lit("abc")),
        lenient_number(F.lit("")),
        lenient_number(F.lit(None).cast("double")),
        plain_number(F.lit(3.0)),
        plain_number(F.lit(2.5)),
    )
    assert got == (0.0, None, 0.25, 12.5, 0.0, 0.0, 0.0, "3", "2.5")


@pytest.mark.parametrize(
    ("score", "even", "up"), [(0.125, 12.0, 13.0), (0.135, 14.0, 14.0), (0.145, 14.0, 15.0), (1.0, 100.0, 100.0)]
)
def test_rounding_modes(spark, score, even, up):
    """Ties go to the even number in one mode and up in the other."""
    assert even == float(round(score * 100))
    got = one(spark, percent(F.lit(score), 0), percent(F.lit(score), 0, "half_up"))
    assert got == (even, up if score != 0.145 else float(int(score * 100 + 0.5)))


def test_unknown_rounding_mode():
    with pytest.raises(ValueError, match="rounding"):
        percent(F.lit(1.0), 0, "down")


def test_bands(spark):
    df = spark.createDataFrame(
        [(0.95, 0.95, 0.9), (0.9, 0.95, 0.9), (0.89, 0.95, 0.9)], "score double, slo double, slo_min double"
    )
    got = df.select(*rag_columns().values(), rag_label(), rag_label(labels=ICONS)).collect()
    assert [tuple(r) for r in got] == [
        (None, None, 0.95, "success", "🟢"),
        (None, 0.9, None, "warning", "🟡"),
        (0.89, None, None, "error", "🔴"),
    ]


def test_filters(spark):
    df = spark.createDataFrame([("a", 0.0), ("", 1.0), (None, 0.0)], "k string, v double")
    assert match_criteria(df, {"k": "", "v": 0.0}) is df
    assert match_criteria(df, None) is df
    assert rows(match_present(df, {"k": "", "v": 0.0})) == [("a", 0.0), (None, 0.0)]
    assert rows(match_choices(df, {"k": "", "v": "All"})) == [("", 1.0)]
    assert rows(match_criteria(df, {"k": "a"})) == [("a", 0.0)]
