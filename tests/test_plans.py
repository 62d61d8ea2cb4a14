"""What the physical plans must and must not contain."""

from __future__ import annotations

import datetime as dt
import re

import pytest

import __spark_entry__
from postura import schemas
from postura.operators.maintenance import replace_keys
from postura.operators.rollups import summarise
from postura.operators.sampling import v_summary
from postura.operators.selection import last_year, latest_only
from postura.plans.catalogue import host_metrics, shipped_metrics, vulnerabilities_critical
from postura.plans.runner import plan_metrics
from postura.sources.lineage import with_lineage
from postura.sources.raw import RawTables, land
from postura.sources.tables import read_table, replace_partitions
from postura.workload.fixtures import AS_OF, Fixtures
from tests.test_tables import detail

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def f(spark):
    return Fixtures(spark, SF_DIR)


@pytest.mark.parametrize(
    "name", ["metric_run", "summary_rollup", "summary_upsert", "overview_rag", "categories_rag", "metrics_page", "alert_message"]
)
def test_no_cross_join_and_no_python(spark, name):
    text = plan(__spark_entry__.queries()[name](spark, SF_DIR))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert word not in text


def test_no_broadcast_hint_in_the_package():
    import pathlib

    import postura

    # The optional folder broadcasts models of a stated bound; the package itself nothing.
    files = pathlib.Path(postura.__file__).parent.rglob("*.py")
    for file in (f for f in files if "llm" not in f.parts):
        assert not re.search(r"broadcast\(|\.localCheckpoint|\.toPandas", file.read_text()), file


def test_family_scans_its_findings_once(f):
    together = plan(host_metrics(f.raw, AS_OF))
    assert len(re.findall(r"FileScan parquet \[o_orderkey[^\n]*orders", together)) == 1
    run = plan_metrics([d for d in shipped_metrics() if d.family], f.raw, AS_OF)
    assert len(re.findall(r"FileScan[^\n]*orders\.parquet", plan(run.rows))) == 1


def test_findings_are_counted_before_they_are_shuffled(f):
    text = plan(vulnerabilities_critical(f.raw, AS_OF))
    assert "partial_count" in text
    # Only the counts are exchanged: below the exchange comes the partial aggregate.
    below = text.split("Exchange hashpartitioning(_match_key", 1)[1]
    assert "HashAggregate" in below.split("FileScan", 1)[0]


def test_sums_do_not_expand_compact_rows(f):
    run = plan_metrics(shipped_metrics(), f.raw, AS_OF)
    assert "_copy" not in plan(summarise(run.rows))
    assert "_copy" in plan(run.detail)


def test_filters_and_columns_reach_the_raw_files(spark, tmp_path):
    vulns = spark.createDataFrame(
        [("1", "open", "2001-01-01", ("C", "HIGH", "2001-01-01", "O", 1))],
        "aid string, status string, created_timestamp string,"
        "cve struct<id:string,severity:string,published_date:string,remediation_level:string,exploit_status:int>",
    )
    hosts = spark.createDataFrame([("1", "h")], "device_id string, hostname string")
    for tag, df in (("crowdstrike_vulnerabilities", vulns), ("crowdstrike_hosts", hosts)):
        land(with_lineage(df, "a", "2001-01-01 00:00:00"), str(tmp_path), tag, fmt="parquet")
    text = plan(vulnerabilities_critical(RawTables(spark, str(tmp_path)), AS_OF))
    assert "And(IsNull(severity)" in text
    assert "In(status, [open,reopen])" in text
    assert "ReadSchema: struct<aid:string,status:string,severity:string,cve:struct<severity:string>>" in text


@pytest.fixture
def stored(spark, tmp_path):
    rows = detail(spark, *[(dt.date(2001, 1, d), "a", "h", 1.0) for d in range(1, 29)])
    path = str(tmp_path / "summary")
    replace_partitions(summarise(rows), path, schemas.SUMMARY_REPLACE_KEYS)
    return read_table(spark, path, schemas.SUMMARY)


def test_sampled_dates_prune_partitions(stored):
    text = plan(v_summary(stored, dt.date(2001, 2, 1)))
    assert "dynamicpruning" in text
    assert "BroadcastHashJoin" in text


def test_date_filters_prune_partitions(stored):
    newest = plan(latest_only(stored))
    assert re.search(r"PartitionFilters: \[[^]]*datestamp#\d+ = Subquery", newest)
    kept = plan(last_year(stored, dt.date(2001, 2, 1)))
    assert re.search(r"PartitionFilters: \[[^]]*datestamp#\d+ >= 2000-02-01", kept)


def test_upsert_streams_over_the_history(spark, stored, tmp_path):
    """The replaced keys are broadcast by their size; the old table is not shuffled."""
    detail(spark, (dt.date(2001, 1, 3), "a", "h", 0.0)).write.parquet(str(tmp_path / "run"))
    run = spark.read.parquet(str(tmp_path / "run"))
    text = plan(replace_keys(stored, run, schemas.SUMMARY_REPLACE_KEYS))
    assert "LeftAnti, BuildRight" in text
    assert "SortMergeJoin" not in text
