from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from postura import schemas
from postura.operators import maintenance
from postura.operators.maintenance import redact, replace_keys, union_metrics, upsert_detail, upsert_summary
from postura.operators.rollups import summarise
from postura.operators.sizing import local_table
from tests.conftest import rows

D1, D2 = dt.date(2001, 1, 1), dt.date(2001, 1, 2)


def detail(spark, *entries):
    data = [
        (d, m, m, "C", 0.9, 0.5, 1.0, "u", "t", "l", r, "host", "", c) for d, m, r, c in entries
    ]
    return spark.createDataFrame(data, schemas.DETAIL)


def test_summary_upsert_is_idempotent(spark):
    first = detail(spark, (D1, "a", "h1", 1.0), (D1, "b", "h1", 0.0))
    second = detail(spark, (D2, "a", "h1", 0.0), (D1, "b", "h1", 1.0), (D1, "b", "h2", 1.0))
    old = summarise(first)
    once = upsert_summary(old, second)
    assert rows(once, "datestamp", "metric_id", "totalok", "total") == [
        (D1, "a", 1.0, 1),
        (D1, "b", 2.0, 2),
        (D2, "a", 0.0, 1),
    ]
    assert rows(upsert_summary(once, second)) == rows(once)


def test_detail_keeps_the_newest_run_of_a_metric(spark):
    old = detail(spark, (D1, "a", "h1", 1.0), (D1, "b", "h1", 1.0))
    run = detail(spark, (D2, "a", "h2", 0.0))
    once = upsert_detail(old, run)
    assert rows(once, "datestamp", "metric_id", "resource") == [(D1, "b", "h1"), (D2, "a", "h2")]
    assert rows(upsert_detail(once, run)) == rows(once)


def test_null_keys_are_never_replaced(spark):
    old = spark.createDataFrame([("a", 1), (None, 2)], "metric_id string, v int")
    new = spark.createDataFrame([("a",), (None,)], "metric_id string")
    assert rows(replace_keys(old, new, ["metric_id"]), "v") == [(2,)]


def test_few_keys_leave_the_old_rows_where_they_are(spark):
    """Two metrics' rows are not gathered in two tasks, though the run they come from is large."""
    run = spark.range(100_000).select((F.col("id") % 2).cast("string").alias("metric_id"))
    old = spark.range(300).select((F.col("id") % 3).cast("string").alias("metric_id"), "id")
    kept = replace_keys(old, run.repartition("metric_id"), ["metric_id"])
    plan = kept._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "LocalTableScan" in plan
    assert rows(kept, "id") == sorted(((k,) for k in range(2, 300, 3)), key=str)


def test_many_keys_are_joined(spark, monkeypatch):
    monkeypatch.setattr(maintenance, "FEW_KEYS", 1)
    run = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "metric_id string")
    old = spark.createDataFrame([("a", 1), ("c", 2), ("c", 2), (None, 3)], "metric_id string, v int")
    assert rows(replace_keys(old, run, ["metric_id"]), "v") == [(2,), (2,), (3,)]


def test_local_tables_have_a_known_size(spark):
    made = local_table(spark, [{"metric_id": "m", "slo": 0.5}], schemas.LIBRARY)
    assert "LocalRelation" in made._jdf.queryExecution().optimizedPlan().toString()
    assert rows(made, "metric_id", "slo", "title") == [("m", 0.5, None)]


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("y", 2.0)], "s string, extra double")
    assert rows(union_metrics([a, b]), "n", "s", "extra") == [(1, "x", None), (None, "y", 2.0)]


def test_redaction_leaves_the_stored_rows_alone(spark):
    stored = detail(spark, (D1, "a", "h1", 1.0))
    assert rows(redact(stored), "resource", "detail", "metric_id") == [("redacted", "redacted", "a")]
    assert rows(stored, "resource") == [("h1",)]
