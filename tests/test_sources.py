from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from postura import schemas, session
from postura.sources import documents, pages, raw, tables
from postura.sources.lineage import expand_template, with_lineage
from postura.sources.paths import has_files
from tests.conftest import rows

AT = dt.datetime(2001, 8, 2, 3, 4, 5)


def test_template_variables():
    path = expand_template("data/%TAG/%YYYY/%MM/%DD/%hh-%mm-%ss/%TENANCY/%UUID.json", "hosts", "acme", AT, "u1")
    assert path == "data/hosts/2001/08/02/03-04-05/acme/u1.json"
    assert expand_template(None, None, "acme", AT) == ""
    assert expand_template("%TAG|%%TENANCY", None, "acme", AT) == "|%acme"
    assert expand_template("%UUID", "t", "x", AT) != expand_template("%UUID", "t", "x", AT)


def test_lineage_is_one_upload(spark):
    stamped = with_lineage(spark.range(100).repartition(4), "acme", AT)
    assert stamped.select(*schemas.LINEAGE).distinct().count() == 1
    assert stamped.schema["_upload_timestamp"].dataType.typeName() == "timestamp"


def test_delivered_arrays_of_several_tenancies(spark, tmp_path):
    """Each file is one JSON array on one line; fields may be absent."""
    folder = tmp_path / "okta_users"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps([{"id": "1", "profile": {"login": "x"}}, {"id": "2"}]))
    (folder / "b.json").write_text(json.dumps([{"id": "3", "status": "ACTIVE", "extra": {"deep": [1]}}]))
    found = raw.ref(spark, str(tmp_path), "okta_users")
    assert rows(found, "id", "profile.login", "status") == [("1", "x", None), ("2", None, None), ("3", None, "ACTIVE")]
    raw.require_tables(spark, str(tmp_path), ["okta_users"])
    with pytest.raises(raw.MissingTable, match="snyk_issues"):
        raw.require_tables(spark, str(tmp_path), ["okta_users", "snyk_issues"])


def test_unknown_tag_is_read_as_it_comes(spark, tmp_path):
    folder = tmp_path / "tenable_assets"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps([{"id": 7, "net": {"ip": "::1"}}]))
    assert rows(raw.ref(spark, str(tmp_path), "tenable_assets"), "id", "net.ip") == [(7, "::1")]


def test_empty_folder_is_a_missing_table(spark, tmp_path):
    (tmp_path / "okta_users").mkdir()
    (tmp_path / "okta_users" / "_SUCCESS").touch()
    assert not has_files(spark, str(tmp_path / "okta_users"))
    with pytest.raises(raw.MissingTable):
        raw.ref(spark, str(tmp_path), "okta_users")


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_landing_replaces_one_tenancy_and_ignores_nothing(spark, tmp_path, fmt):
    root, tag = str(tmp_path), "snyk_organizations"
    first = spark.createDataFrame([("1",), ("2",)], "id string")
    raw.land(with_lineage(first, "a", AT, "u"), root, tag, fmt)
    raw.land(with_lineage(first, "b", AT, "u"), root, tag, fmt)
    raw.land(with_lineage(first.filter("id = '1'"), "a", AT, "u"), root, tag, fmt)
    raw.land(with_lineage(first.filter("false"), "b", AT, "u"), root, tag, fmt)
    assert rows(raw.ref(spark, root, tag, fmt=fmt), "_tenancy", "id") == [("a", "1"), ("b", "1"), ("b", "2")]


def test_latest_snapshot_keeps_all_rows_of_the_newest_upload(spark):
    uploads = spark.createDataFrame(
        [("h", "a", 1, "x"), ("h", "a", 2, "y"), ("h", "a", 2, "z"), ("h", "b", 1, "w")],
        "tag string, tenancy string, at int, v string",
    )
    assert rows(raw.latest_snapshot(uploads, uploaded_at="at"), "v") == [("w",), ("y",), ("z",)]


def test_documents_keep_every_field(spark):
    schema = schemas.RAW["okta_users"]
    record = {"id": "1", "profile": {"login": "é\"\n", "zip_code": "0123"}, "last_login": None}
    df = spark.createDataFrame([record], schema)
    stamped = with_lineage(df.drop(*schemas.LINEAGE), "acme", AT, "u")
    docs = documents.to_documents(stamped)
    assert docs.schema.fieldNames() == schemas.DOCUMENTS.fieldNames()
    back = documents.from_documents(docs, schema)
    assert rows(back, "id", "profile.login", "profile.zip_code", "_tenancy") == [("1", "é\"\n", "0123", "acme")]


def test_pages(spark):
    df = spark.read.json(
        spark.sparkContext.parallelize(
            [
                '{"org": "o1", "data": [{"id": 1, "n": {"x": "a"}}, {"id": 2}], "total": 3}',
                '{"org": "o1", "data": [{"id": 3}], "total": 3}',
                '{"org": "o2", "data": [], "total": 1}',
                '{"org": "o3", "total": 0}',
            ]
        )
    )
    flat = pages.flatten_pages(df, "data", ["org"])
    assert rows(flat, "org", "id", "n.x") == [("o1", 1, "a"), ("o1", 2, None), ("o1", 3, None)]
    complete = pages.page_completeness(df, "data", "total", ["org"])
    assert rows(complete) == [("o1", 3, 3, True), ("o2", 0, 1, False), ("o3", 0, 0, True)]


def test_recent_findings_are_ordered(spark):
    data = [
        ("1", "2001-08-01", "2001-08-01", ("C1",)),
        ("2", "2001-07-19", "2001-07-20", ("C2",)),
        ("3", "2001-07-18", "2001-07-18", ("C3",)),
        ("4", "2001-08-01", "2001-08-01", ("",)),
        ("5", "2001-08-01", "2001-08-01", (None,)),
    ]
    df = spark.createDataFrame(data, "aid string, last_seen string, updated_timestamp string, cve struct<id:string>")
    found = pages.recent_findings(df, dt.date(2001, 8, 2))
    assert [r["aid"] for r in found.collect()] == ["2", "1"]
    assert rows(pages.recent_findings(df, "2001-08-02", ordered=False), "aid") == [("1",), ("2",)]


def test_csv_values_survive(spark, tmp_path):
    values = [dt.date(2001, 1, 1), "m", 'a "quoted", text', "c", 0.9, 0.8, 1.0, None, "t\nwo", "l", 1.0, 2]
    df = spark.createDataFrame([values], schemas.SUMMARY)
    path = str(tmp_path / "summary.csv")
    tables.write_csv(df.withColumn("team", F.lit("t")), path)
    assert rows(tables.read_summary_csv(spark, path)) == [tuple(values[:8] + ["t"] + values[9:])]
    text = tables.read_csv_strings(spark, path, schemas.SUMMARY.fieldNames())
    assert {t for _, t in text.dtypes} == {"string"}


def test_unreadable_csv_numbers_are_null(spark, tmp_path):
    names = ",".join(schemas.SUMMARY.fieldNames())
    (tmp_path / "s.csv").write_text(f"{names}\n2001-01-01,m,t,c,0.9,,x,u,t,l,1.0,n/a\n\n")
    found = tables.read_summary_csv(spark, str(tmp_path / "s.csv"))
    assert rows(found, "slo", "slo_min", "weight", "totalok", "total") == [(0.9, None, None, 1.0, None)]


def test_bootstrap(spark, tmp_path):
    absent = tables.read_or_empty(spark, str(tmp_path / "none"), schemas.DETAIL)
    assert absent.schema == schemas.DETAIL
    assert absent.count() == 0


def test_partitions_are_replaced_exactly(spark, tmp_path):
    path = str(tmp_path / "t")
    a = spark.createDataFrame([(1, "x", 1.0), (1, "y", 2.0), (2, "x", 3.0)], "d int, k string, v double")
    tables.replace_partitions(a, path, ["d", "k"])
    b = spark.createDataFrame([(1, "x", 9.0)], "d int, k string, v double")
    tables.replace_partitions(b, path, ["d", "k"])
    tables.replace_partitions(b.filter("false"), path, ["d", "k"])
    assert rows(spark.read.schema(a.schema).parquet(path), "d", "k", "v") == [(1, "x", 9.0), (1, "y", 2.0), (2, "x", 3.0)]


def test_jdbc_options():
    options = tables.jdbc_options("jdbc:postgresql://h/db", "detail", "u", "p")
    assert options == {
        "url": "jdbc:postgresql://h/db",
        "dbtable": "detail",
        "user": "u",
        "password": "p",
        "numPartitions": "8",
        "batchsize": "10000",
        "truncate": "true",
    }


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_root(spark) == named
    assert session.scratch_path(spark, "x").startswith(named)
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


def test_backup_is_used_only_where_current_data_is_missing(spark, tmp_path):
    one = spark.createDataFrame([("1",)], "id string")
    two = spark.createDataFrame([("2",)], "id string")
    root, backup = str(tmp_path / "now"), str(tmp_path / "backup")
    raw.land(with_lineage(one, "a", AT), root, "snyk_organizations")
    for tag in ("snyk_organizations", "snyk_projects"):
        raw.land(with_lineage(two, "a", AT), backup, tag)
    found = raw.RawTables(spark, root, backup=backup)
    assert rows(found.ref("snyk_organizations"), "id") == [("1",)]
    assert rows(found.ref("snyk_projects"), "id") == [("2",)]
    with pytest.raises(raw.MissingTable, match="snyk_issues"):
        found.ref("snyk_issues")


def test_history_keeps_every_upload(spark, tmp_path):
    df = spark.createDataFrame([("1",)], "id string")
    for at in (AT, AT, AT + dt.timedelta(days=1)):
        raw.append_history(with_lineage(df, "acme", at), str(tmp_path), "hosts")
    kept = spark.read.parquet(str(tmp_path))
    assert kept.count() == 3
    assert (tmp_path / "tag=hosts" / "tenancy=acme" / "year=2001" / "month=08" / "day=03").is_dir()


def test_json_twin_of_a_published_table(spark, tmp_path):
    df = spark.createDataFrame([("m", 0.5)], "metric_id string, slo double")
    df.write.json(str(tmp_path / "j"))
    assert rows(tables.read_json_rows(spark, str(tmp_path / "j"), df.schema)) == [("m", 0.5)]


def test_foreign_and_mixed_formats_fail(spark, tmp_path):
    df = with_lineage(spark.createDataFrame([("1",)], "id string"), "a", AT)
    raw.land(df, str(tmp_path), "snyk_projects", fmt="parquet")
    assert raw.ref(spark, str(tmp_path), "snyk_projects").count() == 1
    with pytest.raises(raw.ForeignFormat):
        raw.ref(spark, str(tmp_path), "snyk_projects", fmt="json")
    df.write.mode("append").json(str(tmp_path / "snyk_projects" / "_tenancy=b"))
    with pytest.raises(raw.ForeignFormat):
        raw.ref(spark, str(tmp_path), "snyk_projects")
    df.write.orc(str(tmp_path / "snyk_issues"))
    with pytest.raises(raw.ForeignFormat):
        raw.ref(spark, str(tmp_path), "snyk_issues")


def test_landing_writes_the_backup(spark, tmp_path):
    df = with_lineage(spark.createDataFrame([("1",)], "id string"), "a", AT)
    raw.land(df, str(tmp_path / "now"), "snyk_projects", backup=str(tmp_path / "backup"))
    lost = raw.RawTables(spark, str(tmp_path / "nowhere"), backup=str(tmp_path / "backup"))
    assert rows(lost.ref("snyk_projects"), "id") == [("1",)]


def test_history_follows_its_template(spark, tmp_path):
    df = with_lineage(spark.createDataFrame([("1",)], "id string"), "acme", AT)
    raw.append_history(df, str(tmp_path), "hosts", template="%YYYY-%MM/%TENANCY/%UUID.json")
    found = spark.read.parquet(str(tmp_path))
    assert {"year", "month", "tenancy"} <= set(found.columns) and "day" not in found.columns


def test_a_missing_key_is_a_key(spark):
    df = spark.createDataFrame([("x", None, 1, "v"), ("x", None, 2, "w"), ("x", "t", 1, "y")], "tag string, tenancy string, at int, v string")
    assert rows(raw.latest_snapshot(df, uploaded_at="at"), "v") == [("w",), ("y",)]


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from postura.session import shared_root

    conf = SimpleNamespace(get=lambda *_: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="spark://host:7077")))
