"""Versioned tables, landing in parts, and what a reader sees meanwhile."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postura.plans import publish as publishing
from postura.plans import runner
from postura.plans.catalogue import shipped_metrics
from postura.plans.publish import DETAIL, SUMMARY, Store, publish
from postura.plans.runner import run_metrics
from postura.session import scratch_path
from postura.sources import raw
from postura.sources.landing import ROWS, landed_root
from postura.sources.lineage import with_lineage
from postura.sources.paths import names
from postura.sources.raw import RawTables
from postura.sources.versions import KEPT, Conflict, UnknownVersion, VersionedRoot
from postura.streaming.differences import Maintained, changed_parts
from tests.conftest import rows

KV = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.IntegerType())])
AS_OF = dt.date(2001, 8, 2)
EARLY, LATE = "2001-01-01 00:00:00", "2001-01-02 00:00:00"


def kv(spark, *entries):
    return spark.createDataFrame(list(entries), KV)


def test_a_change_is_seen_as_a_whole_and_by_partition(spark, tmp_path):
    home = VersionedRoot(spark, str(tmp_path))
    first = home.begin()
    first.write(kv(spark, ("a", 1), ("b/%", 2), (None, 3)), "t", ["k"])
    first.write(kv(spark, ("x", 1)), "whole")
    assert rows(home.current().read(spark, "t", KV)) == []
    first.commit()
    before = home.current()
    second = home.begin()
    second.write(kv(spark, ("a", 7)), "t", ["k"])
    assert rows(home.current().read(spark, "t", KV)) == rows(before.read(spark, "t", KV))
    assert ("a", 7) in rows(second.seen.read(spark, "t", KV))
    second.drop("t", ["k=b%2F%25"])
    second.notes["run"] = 2
    second.commit()
    assert rows(home.current().read(spark, "t", KV)) == [("a", 7), (None, 3)]
    assert home.current().notes == {"run": 2}
    assert rows(before.read(spark, "t", KV)) == [("a", 1), ("b/%", 2), (None, 3)]
    assert rows(home.current().read(spark, "whole", KV)) == [("x", 1)]


def test_of_two_changes_at_once_one_is_refused(spark, tmp_path):
    home = VersionedRoot(spark, str(tmp_path))
    one, other = home.begin(), home.begin()
    one.write(kv(spark, ("a", 1)), "t")
    other.write(kv(spark, ("b", 1)), "t")
    one.commit()
    with pytest.raises(Conflict):
        other.commit()
    assert rows(home.current().read(spark, "t", KV)) == [("a", 1)]


def test_old_versions_go_and_untouched_partitions_stay(spark, tmp_path):
    home = VersionedRoot(spark, str(tmp_path))
    lost = home.begin()
    lost.write(kv(spark, ("lost", 0)), "t", ["k"])
    for n in range(KEPT + 3):
        change = home.begin()
        change.write(kv(spark, ("a", n), ("once", 0)) if n == 0 else kv(spark, ("a", n)), "t", ["k"])
        change.commit()
    assert rows(home.current().read(spark, "t", KV)) == [("a", KEPT + 2), ("once", 0)]
    assert len(names(spark, f"{tmp_path}/_versions")) == KEPT
    held = sorted(p.parent.name + "/" + p.name for p in tmp_path.glob("t/version=*/k=*"))
    assert len(held) == KEPT + 1 and not any("lost" in h for h in held)
    with pytest.raises(UnknownVersion):
        home.at(1)


@pytest.fixture
def tables(spark):
    hosts = spark.createDataFrame([("1", "h1"), ("2", "h2")], "device_id string, hostname string")
    vulns = spark.createDataFrame(
        [("1", "open", EARLY[:10], ("C", "HIGH", EARLY[:10], "O", 1))] * 5,
        "aid string, status string, created_timestamp string,"
        "cve struct<id:string,severity:string,published_date:string,remediation_level:string,exploit_status:int>",
    )
    return RawTables(spark, tables={"crowdstrike_hosts": hosts, "crowdstrike_vulnerabilities": vulns})


def measured(spark, tables, day=AS_OF):
    return run_metrics([d for d in shipped_metrics() if d.family], tables, day, scratch_path(spark, "staging"))


def test_a_reader_sees_no_half_of_a_run(spark, tables, monkeypatch):
    store = Store(scratch_path(spark, "store"))
    publish(measured(spark, tables), store, AS_OF)
    old = rows(store.read_summary(spark)), rows(store.read_detail(spark))
    seen = []

    def looking(f):
        def wrapped(*args):
            out = f(*args)
            seen.append((rows(store.read_summary(spark)), rows(store.read_detail(spark)), store.detail_csv))
            return out

        return wrapped

    for name in ("write_detail", "write_summary", "summary_sample"):
        monkeypatch.setattr(publishing, name, looking(getattr(publishing, name)))
    csv = store.detail_csv
    later = AS_OF + dt.timedelta(days=1)
    reader = store.current(spark)
    publish(measured(spark, tables, later), store, later)
    assert len(seen) == 3 and all(s == (*old, csv) for s in seen)
    assert {r[0] for r in rows(store.read_summary(spark), "datestamp")} == {AS_OF, later}
    assert store.detail_csv != csv
    # A reader that began before reads on what it has resolved.
    assert rows(reader.read(spark, SUMMARY, publishing.schemas.SUMMARY)) == old[0]
    assert rows(reader.read(spark, DETAIL, publishing.schemas.DETAIL)) == old[1]


def test_a_failed_run_changes_nothing(spark, tables, monkeypatch):
    store = Store(scratch_path(spark, "store"))
    publish(measured(spark, tables), store, AS_OF)
    old = rows(store.read_summary(spark)), rows(store.read_detail(spark))
    monkeypatch.setattr(publishing, "summary_sample", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        publish(measured(spark, tables, AS_OF + dt.timedelta(days=1)), store, AS_OF)
    assert (rows(store.read_summary(spark)), rows(store.read_detail(spark))) == old


def test_tables_from_before_versions_become_part_of_the_store(spark, tables, tmp_path):
    earlier = Store(str(tmp_path / "store"))
    run = measured(spark, tables, AS_OF - dt.timedelta(days=9))
    runner.replace_partitions(publishing.summarise(run.rows), f"{earlier.root}/summary", ["datestamp"])
    assert earlier.read_summary(spark).count() == 3
    publish(measured(spark, tables), earlier, AS_OF)
    assert earlier.read_summary(spark).count() == 6


def test_files_of_a_metric_follow_its_rows(spark, tables, monkeypatch):
    monkeypatch.setattr(runner, "ROWS_PER_TASK", 2)
    store = Store(scratch_path(spark, "store"))
    run = measured(spark, tables)
    counts = {o.metric_id: o.rows for o in run.report}
    assert counts["vulnerabilities_critical"] == 6
    publish(run, store, AS_OF)
    snapshot = store.current(spark)
    for name in snapshot.parts(DETAIL):
        files = [n for n in names(spark, snapshot.path(DETAIL, name)) if n.startswith("part-")]
        assert len(files) <= -(-counts[name.partition("=")[2]] // 2)
    assert store.read_detail(spark).count() == sum(counts.values())


def test_dealt_rows_are_spread_evenly(spark):
    from postura.operators.matching import COPIES, expand_dealt

    df = spark.createDataFrame([("a", 95_000), ("b", 10), ("c", 1)], f"m string, {COPIES} long")
    dealt = expand_dealt(df, "m", {"a": 5, "b": 1}).withColumn("p", F.spark_partition_id())
    found = {(r["m"], r["p"]): r["count"] for r in dealt.groupBy("m", "p").count().collect()}
    assert sum(n for (m, _), n in found.items() if m == "a") == 95_000
    assert len([1 for m, _ in found if m == "a"]) == 5 and max(found.values()) <= 20_000
    assert found[("b", 5)] == 10 and found[("c", 6)] == 1


# --- landing ---------------------------------------------------------------------------


def test_the_source_of_two_roots_is_computed_once(spark, tmp_path):
    """Each computation of this frame gives other values."""
    df = with_lineage(spark.range(100).select(F.uuid().alias("id")), "a", EARLY, "u")
    now, backup = str(tmp_path / "now"), str(tmp_path / "backup")
    raw.land(df, now, "snyk_projects", backup=backup)
    assert rows(raw.ref(spark, now, "snyk_projects"), "id") == rows(raw.ref(spark, backup, "snyk_projects"), "id")


def test_delivered_files_move_into_the_first_version(spark, tmp_path):
    df = with_lineage(spark.createDataFrame([("1",)], "id string"), "a", EARLY, "u")
    df.write.partitionBy("_tenancy").json(str(tmp_path / "snyk_projects"))
    raw.land(df.withColumns({"_tenancy": F.lit("b"), "id": F.lit("2")}), str(tmp_path), "snyk_projects")
    assert rows(raw.ref(spark, str(tmp_path), "snyk_projects"), "_tenancy", "id") == [("a", "1"), ("b", "2")]
    df.write.json(str(tmp_path / "snyk_projects" / "delivered"))  # and what is put beside it is no part of it
    with pytest.raises(raw.ForeignFormat):
        raw.ref(spark, str(tmp_path), "snyk_projects")


SNYK = T.StructType([T.StructField("id", T.StringType())])


def upload(spark, tenancy, at, upload_id, *ids, file="f"):
    df = spark.createDataFrame([(i,) for i in ids], SNYK)
    return with_lineage(df, tenancy, at, upload_id).withColumn("_file", F.lit(file))


def arrive(spark, root, *uploads):
    df = uploads[0]
    for u in uploads[1:]:
        df = df.unionByName(u)
    raw.land_arriving(df, root, "snyk_organizations", file="_file")
    return rows(raw.ref(spark, root, "snyk_organizations"), "_tenancy", "id")


def test_parts_of_an_upload_add_up_and_repeats_do_not(spark, tmp_path):
    root = str(tmp_path)
    one = upload(spark, "a", EARLY, "u1", "1", "2")
    assert arrive(spark, root, one) == [("a", "1"), ("a", "2")]
    assert arrive(spark, root, upload(spark, "a", EARLY, "u1", "3", file="g")) == [("a", "1"), ("a", "2"), ("a", "3")]
    # The first file again under another name, alone, twice, and beside a new one.
    again = upload(spark, "a", EARLY, "u1", "2", "1", file="h")
    number = landed_root(spark, root, "snyk_organizations").current().number
    assert len(arrive(spark, root, again)) == 3
    assert landed_root(spark, root, "snyk_organizations").current().number == number
    more = upload(spark, "a", EARLY, "u1", "4", file="i")
    assert len(arrive(spark, root, again, more, upload(spark, "a", EARLY, "u1", "4", file="j"))) == 4
    # A newer upload replaces, an older one comes too late, another tenancy is not concerned.
    newer, other = upload(spark, "a", LATE, "u0", "9"), upload(spark, "b", EARLY, "u1", "5")
    assert arrive(spark, root, newer, other) == [("a", "9"), ("b", "5")]
    assert arrive(spark, root, one, more) == [("a", "9"), ("b", "5")]
    # At the same time the id decides.
    assert arrive(spark, root, upload(spark, "a", LATE, "u1", "8")) == [("a", "8"), ("b", "5")]
    assert arrive(spark, root, upload(spark, None, EARLY, "u1", "7")) == [("a", "8"), ("b", "5"), (None, "7")]


def test_a_snapshot_landed_as_a_whole_and_later_parts(spark, tmp_path):
    root = str(tmp_path)
    raw.land(upload(spark, "a", LATE, "u2", "1").drop("_file"), root, "snyk_organizations")
    assert arrive(spark, root, upload(spark, "a", EARLY, "u1", "0")) == [("a", "1")]
    assert arrive(spark, root, upload(spark, "a", LATE, "u2", "2")) == [("a", "1"), ("a", "2")]
    raw.land(upload(spark, "a", LATE, "u3", "3").drop("_file"), root, "snyk_organizations")
    assert rows(raw.ref(spark, root, "snyk_organizations"), "id") == [("3",)]


def test_newest_uploads_move_no_rows(spark, tmp_path):
    schema = T.StructType.fromDDL("v string, tag string, tenancy string, at string")
    df = spark.createDataFrame([("x", "h", "a", "1"), ("y", "h", "a", "2"), ("w", "h", None, "1")], schema)
    df.write.partitionBy("tag", "tenancy", "at").parquet(str(tmp_path / "u"))
    newest = raw.newest_uploads(spark, str(tmp_path / "u"), schema, uploaded_at="at")
    assert rows(newest) == [("w", "h", None, "1"), ("y", "h", "a", "2")]
    assert "Exchange" not in newest._jdf.queryExecution().executedPlan().toString()
    assert len(newest.inputFiles()) == 2
    assert rows(raw.newest_uploads(spark, str(tmp_path / "none"), schema)) == []


# --- keeping the summary by differences ------------------------------------------------


def finding(spark, tenancy, at, upload_id, *aids, file="f"):
    schema = raw.schemas.RAW["crowdstrike_vulnerabilities"]
    made = [
        {"aid": a, "status": "open", "cve": {"severity": "HIGH", "remediation_level": "O", "exploit_status": 1},
         "_tenancy": tenancy, "_upload_timestamp": dt.datetime.fromisoformat(at), "_upload_id": upload_id}
        for a in aids
    ]
    return spark.createDataFrame(made, schema).withColumn("_file", F.lit(file))


@pytest.fixture
def kept(spark, tables, tmp_path):
    """Lands findings and brings the summary up to date; the summary by metric, and what is read."""
    root, store = str(tmp_path / "raw"), Store(str(tmp_path / "store"))
    metrics = [d for d in shipped_metrics() if d.family]
    tag = "crowdstrike_vulnerabilities"

    def deliver(df, as_of=AS_OF, definitions=metrics):
        if df is not None:
            raw.land_arriving(df, root, tag, file="_file")
        maintained = Maintained(spark, tag, definitions, tables, as_of, root, store)
        read = []
        landed = maintained.landed

        def watched(snapshot, parts=None):
            found = landed(snapshot, parts)
            read.extend(found.inputFiles())
            return found

        maintained.landed = watched
        maintained.update()
        by_metric = rows(store.read_summary(spark).filter(F.col("datestamp") == as_of), "metric_id", "totalok", "total")
        return [r[1:] for r in by_metric if r[0] == "vulnerabilities_critical"], read

    return deliver


def test_a_batch_reads_only_its_tenancies(spark, kept):
    found, _ = kept(finding(spark, "a", EARLY, "u1", "1", "1", "2"))
    assert found == [(0.0, 3)]
    found, read = kept(finding(spark, "b", EARLY, "u1", "2", "2"))
    assert found == [(0.0, 5)] and read and all("_tenancy=b" in f for f in read)
    # A tenancy's newer upload takes its findings back; what another one found stays.
    found, read = kept(finding(spark, "a", LATE, "u2", "1"))
    assert found == [(0.0, 3)] and read and all("_tenancy=a" in f for f in read)
    found, _ = kept(finding(spark, "b", LATE, "u2", "unknown host"))
    assert found == [(1.0, 2)]
    found, read = kept(finding(spark, "b", LATE, "u2", "2", file="g"))
    assert found == [(0.0, 2)] and len(read) > 0
    # Repeats and late uploads read nothing.
    for again in (finding(spark, "b", LATE, "u2", "2", file="h"), finding(spark, "a", EARLY, "u1", "1", "1", "2"), None):
        found, read = kept(again)
        assert found == [(0.0, 2)] and read == []


def test_another_date_or_metric_starts_anew(spark, kept):
    kept(finding(spark, "a", EARLY, "u1", "1"))
    later = AS_OF + dt.timedelta(days=1)
    found, read = kept(None, as_of=later)
    assert found == [(1.0, 2)] and read
    found, read = kept(finding(spark, "a", EARLY, "u1", "2", file="g"), as_of=later)
    assert found == [(0.0, 2)]
    found, read = kept(None, as_of=later, definitions=shipped_metrics("vulnerabilities_critical"))
    assert found == [(0.0, 2)] and read


def test_a_crash_between_landing_and_commit_loses_nothing(spark, kept, monkeypatch):
    kept(finding(spark, "a", EARLY, "u1", "1"))
    broken = finding(spark, "a", EARLY, "u1", "1", "2", file="g")
    commit = publishing.Change.commit

    def crash(change):
        if "store" in change.home.root:
            raise OSError("lost")
        return commit(change)

    with monkeypatch.context() as m:
        m.setattr(publishing.Change, "commit", crash)
        with pytest.raises(OSError):
            kept(broken)
    found, _ = kept(broken)  # the batch comes again
    assert found == [(0.0, 3)]


def test_parts_that_came_and_went(spark, tmp_path):
    root = str(tmp_path)
    arrive(spark, root, upload(spark, "a", EARLY, "u1", "1"), upload(spark, "b", EARLY, "u1", "2"))
    before = landed_root(spark, root, "snyk_organizations").current()
    arrive(spark, root, upload(spark, "a", LATE, "u2", "3"))
    after = landed_root(spark, root, "snyk_organizations").current()
    came, gone = changed_parts(before, after)
    assert {n.split("/")[0] for n in came} == {n.split("/")[0] for n in gone} == {"_tenancy=a"}
    assert gone <= set(before.parts(ROWS)) and changed_parts(after, after) == (set(), set())
