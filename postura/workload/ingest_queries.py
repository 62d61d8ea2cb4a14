"""Queries of the sources and sinks."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from postura import schemas
from postura.functions.dates import to_date_lenient
from postura.operators.maintenance import upsert_summary
from postura.operators.rollups import metric_scores, summarise
from postura.plans.catalogue import shipped_metrics
from postura.plans.runner import plan_metrics
from postura.session import scratch_path
from postura.sources import documents, pages, paths, raw, tables
from postura.sources.library import library_frame, library_listing, load_metrics
from postura.sources.lineage import with_lineage
from postura.workload.fixtures import AS_OF, Fixtures
from postura.workload.registry import query

UPLOADED = "2001-08-02 03:04:05"
# Two metrics as users write them.
SQL_TEXTS = {
    "vulnerabilities_critical": """
        select h.hostname as resource, 'host' as resource_type,
          case when v.aid is null then 1 else 0 end as compliance, '' as detail
        from {{ ref('crowdstrike_hosts') }} as h
        left join {{ ref('crowdstrike_vulnerabilities') }} as v on h.device_id = v.aid
          and v.cve.severity in ('HIGH', 'CRITICAL') and v.status in ('open', 'reopen')""",
    "identity_dormant": """
        select profile.login as resource, 'user' as resource_type,
          case when datediff(:as_of, cast(last_login as date)) < 90 then 1 else 0 end as compliance,
          last_login as detail
        from {{ ref('okta_users') }} where status = 'ACTIVE'""",
}
VULN_COLUMNS = "aid, status, severity, remediation_level, exploit_status, published_date, created_timestamp"


def _with_tenancy(f: Fixtures):
    """Vulnerabilities as delivered by three tenancies."""
    tenancy = F.concat(F.lit("t"), F.col("aid").cast("bigint") % 3)
    return with_lineage(f.vulns, tenancy, UPLOADED, "upload-1")


def _flat(df):
    return df.select(
        "aid",
        "status",
        "cve.severity",
        "cve.remediation_level",
        "cve.exploit_status",
        to_date_lenient("cve.published_date").alias("published_date"),
        to_date_lenient("created_timestamp").alias("created_timestamp"),
    )


@query("raw_scan", f"select {VULN_COLUMNS} from f_vulns")
def raw_scan(f: Fixtures):
    """Every tenancy's JSON of one tag, read with its declared schema."""
    root = scratch_path(f.spark, "raw_scan")
    raw.land(_with_tenancy(f), root, "crowdstrike_vulnerabilities", fmt="json")
    return _flat(raw.ref(f.spark, root, "crowdstrike_vulnerabilities"))


@query(
    "land_roundtrip",
    """select aid, case when cast(aid as bigint) % 3 = 1 then upper(status) else status end as status,
         concat('t', cast(cast(aid as bigint) % 3 as string)) as tenancy
       from f_vulns""",
)
def land_roundtrip(f: Fixtures):
    """A second upload replaces one tenancy; an empty one replaces nothing."""
    root, tag = scratch_path(f.spark, "land_roundtrip"), "crowdstrike_vulnerabilities"
    delivered = _with_tenancy(f)
    raw.land(delivered, root, tag)
    again = delivered.filter(F.col("_tenancy") == "t1").withColumn("status", F.upper("status"))
    raw.land(again, root, tag)
    raw.land(delivered.filter(F.col("status") == "no such status"), root, tag)
    landed = raw.ref(f.spark, root, tag)
    return landed.select("aid", "status", F.col("_tenancy").alias("tenancy"))


@query(
    "with_lineage",
    f"""select device_id, hostname, 'acme' as _tenancy, '{UPLOADED}' as uploaded_at,
          'upload-1' as _upload_id from f_hosts""",
)
def lineage(f: Fixtures):
    stamped = with_lineage(f.hosts, "acme", UPLOADED, "upload-1")
    uploaded_at = F.date_format("_upload_timestamp", "yyyy-MM-dd HH:mm:ss").alias("uploaded_at")
    return stamped.select("device_id", "hostname", "_tenancy", uploaded_at, "_upload_id")


@query(
    "history_partitions",
    """select tenancy, strftime(upload_date, '%Y') as year, strftime(upload_date, '%m') as month,
         strftime(upload_date, '%d') as day, count(*) as uploads, round(sum(value), 2) as value
       from f_uploads group by all""",
)
def history_partitions(f: Fixtures):
    """Dated copies below tag, tenancy, year, month and day; read back by partition."""
    root = scratch_path(f.spark, "history_partitions")
    delivered = with_lineage(f.uploads.drop("tag"), F.col("tenancy"), UPLOADED, "upload-1")
    dated = delivered.withColumn("_upload_timestamp", F.col("upload_date").cast("timestamp"))
    raw.append_history(dated.drop("tenancy"), root, "events")
    parts = ["tenancy", "year", "month", "day"]
    columns = "value double, tag string, " + ", ".join(f"{p} string" for p in parts)
    return (
        f.spark.read.schema(columns)
        .parquet(root)
        .groupBy(*parts)
        .agg(F.count(F.lit(1)).alias("uploads"), F.round(F.sum("value"), 2).alias("value"))
    )


@query(
    "latest_snapshot",
    """select * from f_uploads u where upload_date =
         (select max(upload_date) from f_uploads m where m.tag = u.tag and m.tenancy is not distinct from u.tenancy)""",
)
def latest_snapshot(f: Fixtures):
    newest = raw.latest_snapshot(f.uploads, ["tag", "tenancy"], "upload_date")
    return newest.select(*f.uploads.columns)


@query(
    "newest_uploads",
    """select * from f_uploads u where upload_date =
         (select max(upload_date) from f_uploads m where m.tag = u.tag and m.tenancy is not distinct from u.tenancy)""",
)
def newest_uploads(f: Fixtures):
    """The same from a history on storage, partitioned by upload: the newest folders alone are read."""
    path = scratch_path(f.spark, "uploads")
    parts = ["tag", "tenancy", "upload_date"]
    f.uploads.hint("rebalance", *parts).write.partitionBy(*parts).parquet(path)
    return raw.newest_uploads(f.spark, path, f.uploads.schema, parts[:2], parts[2])


@query(
    "land_backup",
    """select aid, case when cast(aid as bigint) % 3 = 1 then upper(status) else status end as status,
         concat('t', cast(cast(aid as bigint) % 3 as string)) as tenancy
       from f_vulns""",
)
def land_backup(f: Fixtures):
    """The second root, filled from the files landed in the first."""
    root, backup, tag = (*(scratch_path(f.spark, n) for n in ("land", "backup")), "crowdstrike_vulnerabilities")
    delivered = _with_tenancy(f)
    raw.land(delivered, root, tag, backup=backup)
    again = delivered.filter(F.col("_tenancy") == "t1").withColumn("status", F.upper("status"))
    raw.land(again, root, tag, backup=backup)
    landed = raw.ref(f.spark, backup, tag)
    return landed.select("aid", "status", F.col("_tenancy").alias("tenancy"))


@query(
    "json_documents",
    f"""select {VULN_COLUMNS}, concat('t', cast(cast(aid as bigint) % 3 as string)) as tenancy,
          '{UPLOADED}' as uploaded_at from f_vulns""",
)
def json_documents(f: Fixtures):
    """Records to JSON documents in an append-only table, and back to typed columns."""
    path = scratch_path(f.spark, "json_documents")
    documents.append_documents(_with_tenancy(f), path)
    stored = f.spark.read.schema(schemas.DOCUMENTS).parquet(path)
    typed = documents.from_documents(stored, schemas.RAW["crowdstrike_vulnerabilities"])
    lineage_columns = {
        "tenancy": F.col("_tenancy"),
        "uploaded_at": F.date_format("_upload_timestamp", "yyyy-MM-dd HH:mm:ss"),
    }
    fields = [
        F.col("aid"),
        F.col("status"),
        F.col("cve.severity"),
        F.col("cve.remediation_level"),
        F.col("cve.exploit_status"),
        to_date_lenient("cve.published_date").alias("published_date"),
        to_date_lenient("created_timestamp").alias("created_timestamp"),
    ]
    return typed.select(*fields, *[c.alias(n) for n, c in lineage_columns.items()])


@query(
    "recent_findings",
    """select aid, cve_id, severity, created_timestamp as last_seen from f_vulns
       where cve_id <> '' and created_timestamp >= date '2001-08-02' - interval 14 day""",
)
def recent_findings(f: Fixtures):
    recent = pages.recent_findings(f.vulns, AS_OF)
    last_seen = to_date_lenient("last_seen").alias("last_seen")
    return recent.select("aid", F.col("cve.id").alias("cve_id"), "cve.severity", last_seen)


@query(
    "flatten_pages",
    "select o_orderstatus as parent, o_orderkey, o_custkey, o_totalprice from orders",
)
def flatten_pages(f: Fixtures):
    return pages.flatten_pages(f.pages, "body.resources", ["parent"])


@query(
    "page_completeness",
    """select o_orderstatus as parent, count(*) as received,
         count(*) + case when o_orderstatus = 'P' then 1 else 0 end as declared,
         o_orderstatus <> 'P' as complete
       from orders group by o_orderstatus""",
)
def page_completeness(f: Fixtures):
    return pages.page_completeness(f.pages, "body.resources", "total", ["parent"])


@query("bootstrap_empty", "select * from f_summary")
def bootstrap_empty(f: Fixtures):
    """The first upsert: the table does not exist yet."""
    absent = tables.read_or_empty(f.spark, scratch_path(f.spark, "absent"), schemas.SUMMARY)
    return upsert_summary(absent, f.detail)


@query("csv_roundtrip", "select * from f_summary")
def csv_roundtrip(f: Fixtures):
    path = scratch_path(f.spark, "csv_roundtrip")
    tables.write_csv(f.summary, path)
    return tables.read_summary_csv(f.spark, path)


@query("table_roundtrip", "select * from f_detail")
def table_roundtrip(f: Fixtures):
    """The detail table written by metric partitions and read back."""
    path = scratch_path(f.spark, "table_roundtrip")
    tables.replace_partitions(f.detail, path, schemas.DETAIL_REPLACE_KEYS)
    return tables.read_table(f.spark, path, schemas.DETAIL)


@query(
    "metric_library",
    """select category, metric_id, title, weight, count(*) as resources, sum(compliance) as compliant,
         printf('%.2f%% - %.2f%%', slo_min * 100, slo * 100) as slo_range
       from m_detail group by category, metric_id, title, slo, slo_min, weight""",
)
def metric_library(f: Fixtures):
    """The library by category with each metric's target range and what it measured."""
    definitions = shipped_metrics()
    run = plan_metrics(definitions, f.raw, AS_OF)
    measured = metric_scores(run.rows).select(
        "metric_id", F.col("total").alias("resources"), F.col("totalok").alias("compliant")
    )
    return library_listing(library_frame(f.spark, definitions)).join(measured, "metric_id")


@query(
    "metric_library_from_files",
    """select category, metric_id, title, weight, count(*) as resources, sum(compliance) as compliant,
         printf('%.2f%% - %.2f%%', slo_min * 100, slo * 100) as slo_range
       from m_detail where metric_id in ('vulnerabilities_critical', 'identity_dormant')
       group by category, metric_id, title, slo, slo_min, weight""",
)
def metric_library_from_files(f: Fixtures):
    """Definitions read from files on shared storage, measured by their SQL texts."""
    folder = scratch_path(f.spark, "definitions")
    for d in shipped_metrics():
        if d.metric_id in SQL_TEXTS:
            values = {name: getattr(d, name) for name in schemas.METADATA} | {"query": SQL_TEXTS[d.metric_id]}
            paths.write_text(f.spark, f"{folder}/metric_{d.metric_id}.yml", json.dumps(values))
    definitions = load_metrics(folder, spark=f.spark)
    measured = metric_scores(plan_metrics(definitions, f.raw, AS_OF).rows).select(
        "metric_id", F.col("total").alias("resources"), F.col("totalok").alias("compliant")
    )
    return library_listing(library_frame(f.spark, definitions)).join(measured, "metric_id")


@query("summary_rollup_from_documents", "select * from f_summary")
def summary_from_documents(f: Fixtures):
    """A report straight from JSON documents: typed on read, then rolled up."""
    path = scratch_path(f.spark, "summary_documents")
    delivered = with_lineage(f.detail, "acme", UPLOADED, "upload-1")
    documents.append_documents(delivered, path)
    stored = f.spark.read.schema(schemas.DOCUMENTS).parquet(path)
    return summarise(documents.from_documents(stored, schemas.DETAIL))
