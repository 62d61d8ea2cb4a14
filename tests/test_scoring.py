from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postura.operators.pivots import chart_wide, pivot_data, series_latest, series_names
from postura.operators.rollups import alert_table, summarise
from postura.operators.scoring import (
    cards_by_category,
    categories_ranked,
    metric_cards,
    weighted_categories,
    weighted_score,
    weighted_targets,
    weighted_trend,
)
from postura.plans.alerts import alert_lines, alert_message
from postura.plans.reports import categories_rag, overview_rag
from tests.conftest import rows

D1, D2 = dt.date(2001, 1, 1), dt.date(2001, 1, 2)
SCHEMA = (
    "datestamp date, metric_id string, title string, category string, slo double, slo_min double, weight double,"
    "business_unit string, team string, location string, totalok double, total long"
)


def row(date, metric, unit, ok, total, weight=1.0, category="C", slo=0.9, slo_min=0.5, title=None):
    return (date, metric, title or metric.upper(), category, slo, slo_min, weight, unit, "t", "l", float(ok), total)


@pytest.fixture(scope="module")
def summary(spark):
    return spark.createDataFrame(
        [
            row(D1, "a", "u", 1, 2, weight=3.0),
            row(D1, "a", "v", 1, 2, weight=3.0),
            row(D1, "b", "u", 4, 4, weight=1.0, category="D", slo=0.7, slo_min=0.3),
            row(D2, "a", "", 3, 4, weight=3.0),
            row(D2, "a", None, 1, 4, weight=3.0),
        ],
        SCHEMA,
    )


def values(df, *columns):
    return [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows(df, *columns)]


def test_trend_weighs_metrics(summary):
    assert values(weighted_trend(summary), "datestamp", "score", "slo", "slo_min") == [
        (D1, 0.625, 0.8, 0.4),
        (D2, 0.5, 0.9, 0.5),
    ]
    chosen = weighted_trend(summary, {"category": "All", "metric_id": "b"})
    assert values(chosen, "datestamp", "score") == [(D1, 1.0)]


def test_categories_look_at_the_newest_date_only(summary):
    assert values(weighted_categories(summary), "category", "score") == [("C", 0.5)]
    # The newest date is that of the table, not that of the filtered rows.
    assert weighted_categories(summary, {"metric_id": "b"}).count() == 0


def test_the_two_rules_differ_when_a_weight_changes_within_a_date(spark):
    changed = spark.createDataFrame(
        [row(D1, "a", "u", 0, 1, weight=1.0), row(D1, "a", "u", 1, 1, weight=3.0), row(D1, "b", "u", 0, 1, weight=1.0)],
        SCHEMA,
    )
    # Once per weight: (0*1 + 1*3 + 0*1) / (1 + 3 + 1).
    assert values(weighted_trend(changed), "score") == [(0.6,)]
    # The last weight for the whole metric: (0.5*3 + 0*1) / (3 + 1).
    assert values(weighted_score(changed), "value") == [(0.375,)]
    # "Last" follows the order that is given: here 1 is the last weight.
    assert values(weighted_score(changed, order_by=-F.col("totalok")), "value") == [(0.25,)]


def test_blank_dimensions_share_a_label(summary):
    got = values(weighted_score(summary, {}, "business_unit"), "datestamp", "business_unit", "value")
    assert got == [(D1, "u", 0.625), (D1, "v", 0.5), (D2, "None", 0.5)]


def test_a_metric_without_total_has_no_score(spark):
    empty = spark.createDataFrame([row(D1, "a", "u", 0, 0), row(D1, "b", "u", 1, 1), row(D2, "c", "u", 1, 1, weight=0.0)], SCHEMA)
    scores = weighted_score(empty)
    assert values(scores, "datestamp", "value") == [(D1, None), (D2, 0.0)]
    assert values(chart_wide(scores, "datestamp", ["value"]), "value") == [(0.0,), (0.0,)]


def test_cards_are_newest_by_title(spark):
    data = [row(D1, "a", "u", 1, 2, title="Same"), row(D2, "b", "u", 1, 4, title="Same"), row(D1, "c", "u", 0, 0, title="Z", category="D")]
    cards = metric_cards(spark.createDataFrame(data, SCHEMA))
    assert values(cards, "metric_id", "score", "sum_total") == [("b", 0.25, 4.0), ("c", 0.0, 0.0)]
    nested = cards_by_category(spark.createDataFrame(data, SCHEMA)).orderBy("category").collect()
    assert [(r["category"], [c["title"] for c in r["cards"]]) for r in nested] == [("C", ["Same"]), ("D", ["Z"])]


def test_targets_are_weighted(summary):
    got = values(weighted_targets(summary, None, "team"), "datestamp", "score_final", "slo_final", "slo_min_final")
    assert got == [(D1, 0.625, 0.85, 0.45), (D2, 0.5, 0.9, 0.5)]


def test_exactly_one_band_is_set(summary):
    for report in (overview_rag(summary), categories_rag(summary)):
        for r in report.collect():
            assert sum(r[c] is not None for c in ("red", "amber", "green")) == 1


def test_ranks_start_with_the_worst(spark):
    data = [row(D1, m, "u", ok, 4, category=c) for m, ok, c in [("a", 3, "X"), ("b", 1, "Y"), ("c", 3, "W")]]
    ranked = categories_ranked(spark.createDataFrame(data, SCHEMA)).collect()
    assert [(r["rank"], r["category"]) for r in ranked] == [(1, "Y"), (2, "W"), (3, "X")]


def test_pivot_counts_blanks_as_zero(spark):
    df = spark.createDataFrame([("a|b", "1.5", 1), ("a|b", "", 2), ("a|b", None, 3), (None, "x", 4)], "k string, v string, i int")
    aggs = {"mean": ("avg", "v"), "total": ("sum", "v"), "n": ("count", "v"), "latest": ("last", "v")}
    assert rows(pivot_data(df, ["k"], aggs, order_by="i"), "k", *aggs) == [("a|b", 0.5, 1.5, 3, 0.0), (None, 0.0, 0.0, 1, 0.0)]
    assert rows(pivot_data(df, ["k"], {"first": ("last", "v")}, order_by=-F.col("i"))) == [("a|b", 1.5), (None, 0.0)]


def test_pivot_refuses_what_it_cannot_do(spark):
    df = spark.range(1)
    with pytest.raises(ValueError, match="median"):
        pivot_data(df, ["id"], {"m": ("median", "id")})
    with pytest.raises(ValueError, match="order_by"):
        pivot_data(df, ["id"], {"m": ("last", "id")})


def test_chart(spark):
    points = spark.createDataFrame(
        [(2, "a", 0.2), (1, "b", 0.3), (1, "a", float("nan")), (2, "c", None)], "x int, z string, y double"
    )
    # Series are those with a point at the last x; holes, NaN and NULL are 0.
    assert series_names(points, "x", "z") == ["a", "c"]
    wide = chart_wide(points, "x", ["y"], "z")
    assert wide.columns == ["x", "a", "c"]
    assert [tuple(r) for r in wide.collect()] == [(1, 0.0, 0.0), (2, 0.2, 0.0)]
    every = chart_wide(points, "x", ["y"], "z", all_series=True)
    assert [tuple(r) for r in every.collect()] == [(1, 0.0, 0.3, 0.0), (2, 0.2, 0.0, 0.0)]
    assert rows(series_latest(points.filter("z <> 'c'"), "x", "y", "z")) == [("a", 0.2), ("b", 0.3)]


def test_blank_and_odd_series_names(spark):
    points = spark.createDataFrame([(1, None, 0.1), (1, "a.b", 0.2), (1, "c`d", 0.3)], "x int, z string, y double")
    assert chart_wide(points, "x", ["y"], "z").first().asDict() == {"x": 1, "None": 0.1, "a.b": 0.2, "c`d": 0.3}


def test_last_point_wins_in_a_chart_cell(spark):
    points = spark.createDataFrame([(1, "a", 0.9, 1), (1, "a", 0.1, 2)], "x int, z string, y double, i int")
    assert chart_wide(points, "x", ["y"], "z", series=["a"], order_by="i").first()["a"] == 0.1


def test_series_are_bounded(spark):
    spark.conf.set("spark.sql.pivotMaxValues", "3")
    try:
        with pytest.raises(ValueError, match="more than 3 series"):
            series_names(spark.range(5).select(F.lit(1).alias("x"), F.col("id").alias("z")), "x", "z")
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


def detail(spark, *compliances, metric="m", unit="u"):
    base = (D1, metric, metric.upper(), "C", 0.9, 0.5, 1.0, unit, "t", "l")
    return spark.createDataFrame(
        [(*base, c) for c in compliances],
        "datestamp date, metric_id string, title string, category string, slo double, slo_min double,"
        "weight double, business_unit string, team string, location string, compliance double",
    )


def test_null_keys_and_null_compliance(spark):
    df = detail(spark, 1.0, 0.0, None).unionAll(detail(spark, 1.0, unit=None)).unionAll(detail(spark, None, unit="w"))
    assert rows(summarise(df), "business_unit", "totalok", "total") == [("u", 1.0, 2), ("w", None, 0), (None, 1.0, 1)]
    assert rows(summarise(df, drop_null_keys=True), "business_unit", "totalok", "total") == [("u", 1.0, 2), ("w", 0.0, 0)]


def test_alert_text(spark):
    df = detail(spark, 1.0, 1.0, 0.0, metric="b").unionAll(detail(spark, 1.0, metric="a")).unionAll(detail(spark, 0.25, metric="c"))
    (message,) = alert_message(alert_lines(alert_table(df))).collect()
    assert message["message"] == (
        "Automated Security Metric results:\n🟢 A - 100% (0)\n🟡 B - 67% (1)\n🔴 C - 25% (0.75)"
    )


ROWS = st.lists(
    st.tuples(
        st.sampled_from([D1, D2]),
        st.sampled_from("abc"),
        st.sampled_from(["u", "v", "", None]),
        st.integers(0, 5),
        st.integers(1, 5),
    ),
    min_size=1,
    max_size=30,
)
WEIGHTS = {"a": 0.2, "b": 0.8, "c": 0.4}


@settings(max_examples=15, deadline=None)
@given(ROWS)
def test_scores_against_brute_force(spark, entries):
    """Weights are constant per metric here, so both rules agree on the dates' scores."""
    data = [row(d, m, u, min(ok, n), n, weight=WEIGHTS[m]) for d, m, u, ok, n in entries]
    table = spark.createDataFrame(data, SCHEMA)

    def expected(key):
        sums = {}
        for d, m, u, ok, n in entries:
            s = sums.setdefault(key(d, u), {}).setdefault(m, [0, 0])
            s[0] += min(ok, n)
            s[1] += n
        return {
            k: round(
                sum(ok / n * WEIGHTS[m] for m, (ok, n) in ms.items()) / sum(WEIGHTS[m] for m in ms), 9
            )
            for k, ms in sums.items()
        }

    by_date = expected(lambda d, u: d)
    assert dict(values(weighted_score(table), "datestamp", "value")) == by_date
    assert dict(values(weighted_trend(table), "datestamp", "score")) == by_date
    assert all(0 <= v <= 1 for v in by_date.values())
    by_unit = values(weighted_score(table, {}, "business_unit"), "datestamp", "business_unit", "value")
    assert {(d, u): v for d, u, v in by_unit} == expected(lambda d, u: (d, u or "None"))
