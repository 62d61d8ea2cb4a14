"""A user's own left joins as counts; the map form of charts; definitions from shared storage."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from postura.operators.matching import COPIES, expand
from postura.operators.outer_counts import count_right_side
from postura.operators.pivots import chart_map, chart_wide
from postura.plans.runner import metric_sql, plan_metrics
from postura.sources.library import load_metrics
from postura.sources.raw import RawTables
from tests.conftest import rows

AS_OF = dt.date(2001, 8, 2)


@pytest.fixture
def views(spark):
    hosts = spark.createDataFrame([("1", "h1"), ("2", "h2"), ("3", "h3"), ("3", "h3b"), (None, "hn")], "device_id string, hostname string")
    found = [
        ("1", "open", "2001-01-01", 5), ("1", "open", "2001-01-01", 5), ("1", "closed", "2001-01-01", 1),
        ("3", "open", "2001-08-01", 2), ("3", "open", "2001-01-01", None), (None, "open", "2001-01-01", 2),
    ]
    vulns = spark.createDataFrame(found, "aid string, status string, created string, n int")
    hosts.createOrReplaceTempView("h")
    vulns.createOrReplaceTempView("v")
    return RawTables(spark, tables={"hosts": hosts, "vulns": vulns})


COUNTED = [
    """select hostname as resource, case when v.aid is null then 1 else 0 end as compliance from h left join v
       on device_id = aid and status = 'open' and cast(created as date) < :as_of - interval '30 day'""",
    "select h.hostname, v.n + 1 as n, v.created from h left join v on h.device_id = v.aid where v.n is null or v.n > 1",
    "select hostname, v.* from h left join v on device_id = aid and hostname > created",
    "select hostname, x.aid, n from h left join (select aid, max(n) n from v group by aid) x on device_id = aid and n > 1",
    "select hostname, upper(status) s from h left join v on device_id <=> aid",
    "select h.hostname, v.aid from h left join v on h.device_id < v.aid",
    "select a.hostname, b.hostname as other from h a left join h b on a.device_id = b.device_id",
]
PLAIN = [
    "select hostname, count(*) c from h left join v on device_id = aid group by hostname",
    "select hostname, row_number() over (order by hostname, n) r from h left join v on device_id = aid",
    "select distinct hostname from h left join v on device_id = aid",
    "select hostname, (select max(n) from v) m from h left join v on device_id = aid",
    "select hostname from h left join v on status = 'open'",
    "select hostname from h join v on device_id = aid",
    "select hostname, v.aid from h left join v on device_id = aid left join v w on device_id = w.aid",
]


@pytest.mark.parametrize("text", COUNTED + PLAIN)
def test_rows_are_those_of_the_plain_join(spark, views, text):
    plain = spark.sql(text, args={"as_of": AS_OF})
    counted = count_right_side(plain)
    assert rows(expand(counted)) == rows(plain)
    three = "left join v w" in text  # the outermost of several joins can be counted too
    assert (COPIES in counted.columns) == (text in COUNTED or three)


def test_expressions_that_differ_between_equal_rows_are_left_alone(spark, views):
    assert COPIES not in count_right_side(spark.sql("select hostname, rand() r from h left join v on device_id = aid")).columns


def test_a_hot_key_is_counted_before_it_is_sent(spark, views):
    query = """select h.hostname as resource, 'host' as resource_type, case when v.aid is null then 1 else 0 end as compliance,
                 '' as detail from {{ ref('hosts') }} h left join {{ ref('vulns') }} v on h.device_id = v.aid and v.status = 'open'"""
    found = metric_sql(query, views, AS_OF)
    text = found._jdf.queryExecution().executedPlan().toString()
    right = text[text.index("partial_count") :]
    assert re.search(r"HashAggregate\(keys=\[aid#\d+\], functions=\[partial_count\(1\)\]", text)
    assert re.search(r"Filter .*status#\d+ = open", right)
    assert found.count() == 5 and expand(found).count() == 8


def test_hot_findings_stay_in_their_tasks(spark):
    """A third of the findings on one host: no row of them is shuffled but a count from each task."""
    findings = spark.range(0, 300_000, 1, 16).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("aid"))
    findings.createOrReplaceTempView("many")
    spark.range(1_000).createOrReplaceTempView("few")
    counted = count_right_side(spark.sql("select id, aid is null as none from few left join many on id = aid"))
    counted.collect()
    plan = counted._jdf.queryExecution().executedPlan()
    assert counted.agg(F.sum(COPIES)).first()[0] == expand(counted).count() == 100_999
    assert counted.count() == 1_000 and "HashAggregate" in plan.toString()


def test_user_metrics_are_compact_until_written(spark, views):
    from postura.plans.runner import MetricDefinition

    query = """select h.hostname as resource, 'host' as resource_type, case when v.aid is null then 1 else 0 end as compliance,
                 '' as detail from {{ ref('hosts') }} h left join {{ ref('vulns') }} v on h.device_id = v.aid"""
    run = plan_metrics([MetricDefinition("m", "T", "C", 0.9, 0.8, 1.0, query=query)], views, AS_OF)
    assert run.rows.count() == 5 and run.detail.count() == 9
    assert {(r["resource"], r["compliance"]) for r in run.detail.collect()} >= {("h2", 1.0), ("h1", 0.0), ("hn", 1.0)}


def test_chart_map_needs_no_job(spark):
    points = spark.createDataFrame(
        [(1, "a", 0.5, 1), (1, "b", 0.2, 1), (2, "a", float("nan"), 1), (2, "c", 0.3, 1), (2, "", 0.4, 1), (2, "c", 0.1, 2)],
        "x int, z string, y double, i int",
    )
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    shown = chart_map(points, "x", "y", "z", order_by="i")
    every = chart_map(points, "x", "y", "z", all_series=True)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before
    assert {r["x"]: r["series"] for r in shown.collect()} == {
        1: {"None": 0.0, "a": 0.5, "c": 0.0},
        2: {"None": 0.4, "a": 0.0, "c": 0.1},
    }
    wide = {r["x"]: {k: v for k, v in r.asDict().items() if k != "x"} for r in chart_wide(points, "x", ["y"], "z", all_series=True).collect()}
    assert {r["x"]: r["series"] for r in every.collect()} == wide
    assert chart_map(points.filter("false"), "x", "y", "z").count() == 0


def test_definitions_from_any_uri(spark, tmp_path):
    for name, weight in (("metric_b", 1.0), ("metric_a", 0.5), ("other", 2.0)):
        (tmp_path / f"{name}.yml").write_text(f"metric_id: {name}\ntitle: Ü\nweight: {weight}\nquery: |\n  select 1\n  from x\n", encoding="utf-8")
    uri = f"file://{tmp_path}"
    found = load_metrics(uri, spark=spark)
    assert found == load_metrics(tmp_path) and [d.metric_id for d in found] == ["metric_a", "metric_b"]
    assert found[0].title == "Ü" and found[0].query == "select 1\nfrom x\n" and found[0].source == "metric_a"
    assert [d.weight for d in load_metrics(uri, "metric_b", spark)] == [1.0]
    assert load_metrics(f"{uri}/nowhere", spark=spark) == []
