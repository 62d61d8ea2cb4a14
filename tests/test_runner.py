from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from postura import schemas
from postura.operators.scoring import metric_cards
from postura.plans import runner
from postura.plans.catalogue import shipped_metrics
from postura.plans.publish import Store, create_views, publish
from postura.plans.runner import MetricDefinition, plan_metrics, run_metrics
from postura.session import scratch_path
from postura.sources.library import library_frame, library_listing, load_metrics
from postura.sources.raw import MissingTable, RawTables
from tests.conftest import rows

AS_OF = dt.date(2001, 8, 2)

DEFINITION = """
metric_id: hosts_named
title: Hosts with a name
category: Inventory
slo: 0.9
slo_min: 0.5
weight: 1.0
query: |
  select hostname as resource, 'host' as resource_type,
    case when hostname is not null then 1 else 0 end as compliance, device_id as detail
  from {{ ref('crowdstrike_hosts') }};
"""


def meta(metric_id, **more):
    values = {"metric_id": metric_id, "title": "T", "category": "C", "slo": 0.9, "slo_min": 0.8, "weight": 1.0}
    return MetricDefinition(**{**values, **more})


@pytest.fixture
def tables(spark):
    hosts = spark.createDataFrame([("1", "h1"), ("2", "h2"), ("3", None)], "device_id string, hostname string")
    vulns = spark.createDataFrame(
        [("1", "open", "2001-01-01", ("CVE-1", "HIGH", "2001-01-01", "O", 30))] * 3
        + [("2", "closed", "2001-01-01", ("CVE-2", "HIGH", "2001-01-01", "O", 30))],
        "aid string, status string, created_timestamp string,"
        "cve struct<id:string,severity:string,published_date:string,remediation_level:string,exploit_status:int>",
    )
    return RawTables(spark, tables={"crowdstrike_hosts": hosts, "crowdstrike_vulnerabilities": vulns})


def test_yaml_definition(spark, tables, tmp_path):
    (tmp_path / "metric_named.yml").write_text(DEFINITION)
    (tmp_path / "metric_other.yml").write_text("metric_id: other\ntitle: Other\n")
    (tmp_path / "notes.yml").write_text("metric_id: ignored\n")
    assert [d.name for d in load_metrics(tmp_path)] == ["hosts_named", "other"]
    assert [d.name for d in load_metrics(tmp_path, "metric_other")] == ["other"]
    (only,) = load_metrics(tmp_path, "hosts_named")
    run = plan_metrics([only], tables, AS_OF)
    assert run.detail.schema.fieldNames() == schemas.DETAIL.fieldNames()
    assert [f.dataType for f in run.detail.schema] == [f.dataType for f in schemas.DETAIL]
    assert rows(run.detail, "resource", "compliance", "detail", "team", "datestamp") == [
        ("h1", 1.0, "1", "undefined", AS_OF),
        ("h2", 1.0, "2", "undefined", AS_OF),
        (None, 0.0, "3", "undefined", AS_OF),
    ]
    assert not [v.name for v in spark.catalog.listTables() if v.name.startswith("raw_")]


def test_library_listing(spark):
    listing = library_listing(library_frame(spark, shipped_metrics("user_awareness")))
    assert rows(listing, "category", "slo_range", "weight") == [("User Security", "80.00% - 90.00%", 0.4)]


BROKEN = [
    meta("no_table", query="select * from {{ ref('nowhere') }} join {{ ref('nor_here') }}"),
    meta("no_column", query="select hostname as resource from {{ ref('crowdstrike_hosts') }}"),
    meta("bad_sql", query="selekt 1"),
    meta("unknown_field", query="select nope from {{ ref('crowdstrike_hosts') }}"),
    meta("no_query"),
    meta("own_code", build=lambda tables, as_of: {}["missing"]),
    meta("no_weight", weight=None, query="select 1"),
]
GOOD = meta(
    "good",
    query="select hostname as resource, 'host' as resource_type, 0.5 as compliance, '' as detail"
    " from {{ ref('crowdstrike_hosts') }}",
)


def test_unmeasurable_metrics_are_reported_and_the_rest_goes_on(tables):
    run = plan_metrics([*BROKEN, GOOD], tables, AS_OF)
    assert {o.metric_id for o in run.failures()} == {d.name for d in BROKEN}
    reasons = {o.metric_id: o.reason for o in run.report}
    assert "nowhere" in reasons["no_table"] and "nor_here" in reasons["no_table"]
    assert "resource_type, compliance, detail" in reasons["no_column"]
    assert "weight" in reasons["no_weight"]
    assert rows(run.detail, "metric_id", "compliance") == [("good", 0.5)] * 3


def test_nothing_measurable_gives_a_typed_empty_result(tables):
    run = plan_metrics(BROKEN, tables, AS_OF)
    assert run.detail.count() == 0
    assert run.detail.schema == schemas.DETAIL


def test_staged_run_isolates_runtime_failures_and_reports_empty_metrics(spark, tables):
    fails = meta(
        "fails",
        query="select hostname as resource, 'host' as resource_type, cast(hostname as int) as compliance,"
        " '' as detail from {{ ref('crowdstrike_hosts') }}",
    )
    empty = meta("empty", query=GOOD.query + " where hostname = 'none such'")
    staging = scratch_path(spark, "staging")
    run = run_metrics([fails, empty, GOOD, *shipped_metrics()], tables, AS_OF, staging)
    status = {o.metric_id: (o.status, o.rows) for o in run.report}
    assert status.pop("fails")[0] == "failed"
    # The shipped metrics whose tables are not there.
    for m in ("development_vulnerabilities", "identity_credentials", "identity_dormant", "user_awareness"):
        assert status.pop(m)[0] == "failed"
    assert status == {
        "empty": ("empty", 0),
        "good": ("measured", 3),
        "vulnerabilities_critical": ("measured", 5),
        "vulnerabilities_critical_patching": ("measured", 5),
        "vulnerabilities_explot_patchable": ("measured", 5),
    }
    assert run.rows.count() == 3 + 3 * 3
    assert run.detail.count() == 3 + 3 * 5
    assert run.detail.rdd.getNumPartitions() == 1


def test_family_falls_back_to_single_metrics(spark, tables):
    """One member needs a field that is not delivered; the others are still measured."""
    vulns = tables.ref("crowdstrike_vulnerabilities").withColumn(
        "cve", F.col("cve").dropFields("exploit_status")
    )
    poorer = RawTables(
        spark,
        tables={"crowdstrike_hosts": tables.ref("crowdstrike_hosts"), "crowdstrike_vulnerabilities": vulns},
    )
    hosts = [d for d in shipped_metrics() if d.family]
    run = plan_metrics(hosts, poorer, AS_OF)
    assert [o.metric_id for o in run.failures()] == ["vulnerabilities_explot_patchable"]
    assert run.detail.select("metric_id").distinct().count() == 2


def test_family_equals_single_metrics(tables):
    hosts = [d for d in shipped_metrics() if d.family]
    together = plan_metrics(hosts, tables, AS_OF).detail
    apart = [plan_metrics([d], tables, AS_OF).detail for d in hosts]
    assert rows(together) == sorted((r for a in apart for r in rows(a)), key=str)


def test_finding_fields_may_be_delivered_outside_the_cve(spark, tables):
    """A top-level severity or publication date goes before the one of the ``cve``."""
    vulns = tables.ref("crowdstrike_vulnerabilities").withColumns(
        {"severity": F.lit("LOW"), "published_date": F.lit("2001-08-01")}
    )
    hosts = tables.ref("crowdstrike_hosts")
    flat = RawTables(spark, tables={"crowdstrike_hosts": hosts, "crowdstrike_vulnerabilities": vulns})
    for metric_id, failing in (("vulnerabilities_critical", 0), ("vulnerabilities_explot_patchable", 3)):
        run = plan_metrics(shipped_metrics(metric_id), flat, AS_OF)
        assert run.detail.filter("compliance = 0").count() == failing


def test_missing_raw_table(spark, tmp_path):
    with pytest.raises(MissingTable):
        RawTables(spark, root=str(tmp_path)).ref("okta_users")
    with pytest.raises(MissingTable):
        RawTables(spark).ref("okta_users")


def test_publish_twice_on_one_day_and_again_the_next(spark, tables):
    store = Store(scratch_path(spark, "store"))
    create_views(spark, store, AS_OF)
    assert spark.sql("select * from v_summary").count() == 0

    def day(as_of, definitions):
        run = run_metrics(definitions, tables, as_of, scratch_path(spark, "staging"))
        return publish(run, store, as_of).collect()

    hosts = [d for d in shipped_metrics() if d.family]
    (message,) = day(AS_OF, [GOOD, *hosts])
    assert message["message"].splitlines() == [
        "Automated Security Metric results:",
        "🔴 T - 50% (1.5)",
        "🔴 Systems without Critical and High vulnerabilities - 40% (3)",
        "🔴 Critical vulnerabilities patched within SLO - 40% (3)",
        "🔴 Systems without exploitable vulnerabilities - 40% (3)",
    ]
    once = rows(store.read_summary(spark)), rows(store.read_detail(spark))
    day(AS_OF, [GOOD, *hosts])
    assert (rows(store.read_summary(spark)), rows(store.read_detail(spark))) == once

    # The next day only one metric runs: its detail is replaced, all history is kept.
    later = AS_OF + dt.timedelta(days=1)
    day(later, [GOOD])
    dates = rows(store.read_detail(spark).select("metric_id", "datestamp").distinct())
    assert dates == [("good", later), *[(d.metric_id, AS_OF) for d in hosts]]
    assert store.read_summary(spark).count() == 5
    create_views(spark, store, later)
    assert spark.sql("select distinct datestamp from v_summary").count() == 2
    assert metric_cards(spark.table("v_summary")).count() == 4

    published = spark.read.option("header", True).csv(store.detail_csv)
    assert {tuple(r) for r in published.select("resource", "detail").collect()} == {("redacted", "redacted")}
    assert published.count() == store.read_detail(spark).count()
    assert "redacted" not in {r[0] for r in rows(store.read_detail(spark), "resource")}


def test_published_detail_is_compressed(spark, tables):
    """Redacted rows are mostly alike, and there are as many as of the detail."""
    store = Store(scratch_path(spark, "store"))
    publish(run_metrics([GOOD], tables, AS_OF, scratch_path(spark, "staging")), store, AS_OF)
    published = spark.read.option("header", True).csv(store.detail_csv)
    assert published.inputFiles() and all(f.endswith(".csv.gz") for f in published.inputFiles())
    assert published.count() == store.read_detail(spark).count()
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"  # as it was


def test_contract_and_metadata_errors(spark):
    with pytest.raises(runner.ContractError, match="compliance"):
        runner.check_contract(spark.range(1).select(F.lit(1).alias("resource")))
    with pytest.raises(runner.MetadataError, match="title"):
        runner.stamp_metadata(spark.range(1), MetricDefinition(metric_id="m"), AS_OF)
