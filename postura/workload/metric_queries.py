"""Queries of projections, predicates, joins and metrics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from postura import schemas
from postura.functions.dates import age_days, date_minus, older_than, to_date_lenient
from postura.functions.numbers import lenient_number, safe_ratio
from postura.functions.predicates import compliance, holds
from postura.operators.assets import enrich_assets
from postura.operators.maintenance import union_metrics
from postura.operators.matching import entity_vs_findings, expand
from postura.operators.rollups import metric_scores
from postura.operators.sizing import local_table
from postura.plans import catalogue
from postura.plans.catalogue import shipped_metrics
from postura.plans.publish import Store, publish
from postura.plans.runner import metric_sql, plan_metrics, run_metrics, stamp_metadata
from postura.session import scratch_path
from postura.sources import raw
from postura.sources.library import MetricDefinition
from postura.sources.lineage import with_lineage
from postura.sources.tables import read_csv_strings, read_summary_csv
from postura.workload.fixtures import AS_OF, Fixtures
from postura.workload.oracle import RUN_DATE, on_days
from postura.workload.registry import query

UPLOADED = "2001-08-02 03:04:05"


@query("nested_project", "select cast(project_id as string) as project_id, status, severity from f_issues")
def nested_project(f: Fixtures):
    return f.issues.select(
        F.col("relationships.scan_item.data.id").alias("project_id"),
        "attributes.status",
        F.col("attributes.effective_severity_level").alias("severity"),
    )


@query(
    "case_compliance",
    """select login, case when last_login is null then 1.0e0 else 0.0e0 end as never,
         case when last_login is not null then 1.0e0 else 0.0e0 end as ever,
         case when last_login < date '2001-01-01' then 1.0e0 else 0.0e0 end as long_ago
       from f_users""",
)
def case_compliance(f: Fixtures):
    login = F.col("last_login")
    return f.users.select(
        "profile.login",
        compliance(login.isNull()).alias("never"),
        compliance(login.isNotNull()).alias("ever"),
        compliance(login < "2001-01-01").alias("long_ago"),
    )


@query(
    "filter_in",
    """select aid, status, severity from f_vulns
       where status in ('open','reopen') and severity in ('HIGH','CRITICAL')""",
)
def filter_in(f: Fixtures):
    wanted = F.col("status").isin("open", "reopen") & F.col("cve.severity").isin("HIGH", "CRITICAL")
    return f.vulns.filter(wanted).select("aid", "status", "cve.severity")


@query(
    "filter_coalesce",
    """select aid, cve_id, coalesce(remediation_level = 'O', false) as patchable,
         coalesce(exploit_status > 0, false) as exploitable
       from f_vulns
       where not (coalesce(remediation_level = 'O', false) and coalesce(exploit_status > 0, false))""",
)
def filter_coalesce(f: Fixtures):
    """Unknown counts as "no", also under a negation."""
    patchable = holds(F.col("cve.remediation_level") == "O")
    exploitable = holds(F.col("cve.exploit_status") > 0)
    return f.vulns.filter(~(patchable & exploitable)).select(
        "aid",
        F.col("cve.id").alias("cve_id"),
        patchable.alias("patchable"),
        exploitable.alias("exploitable"),
    )


@query(
    "filter_date_cutoff",
    """select aid, published_date from f_vulns
       where published_date < date '2001-08-02' - interval 14 day
         and created_timestamp < date '2001-08-02' - interval 30 day""",
)
def filter_date_cutoff(f: Fixtures):
    old = older_than("cve.published_date", AS_OF, 14) & older_than("created_timestamp", AS_OF, 30)
    published = to_date_lenient("cve.published_date").alias("published_date")
    return f.vulns.filter(old).select("aid", published)


@query(
    "filter_age_days",
    """select login, last_login, cast(date_diff('day', last_login, date '2001-08-02') as int) as age
       from f_users where date_diff('day', last_login, date '2001-08-02') < 90""",
)
def filter_age_days(f: Fixtures):
    age = age_days("last_login", AS_OF)
    day = to_date_lenient("last_login").alias("last_login")
    return f.users.filter(age < 90).select("profile.login", day, age.alias("age"))


@query(
    "stamp_metadata",
    """select r.*, metric_id, title, category, slo, slo_min, weight, date '2001-08-02' as datestamp
       from m_identity_dormant r, m_lib where metric_id = 'identity_dormant'""",
)
def stamp(f: Fixtures):
    (definition,) = shipped_metrics("identity_dormant")
    return stamp_metadata(definition.build(f.raw, AS_OF), definition, AS_OF)


@query(
    "join_left_residual",
    """select device_id, hostname, aid is not null as matched
       from f_hosts left join f_vulns on device_id = aid and severity = 'CRITICAL' and status = 'open'""",
)
def join_left_residual(f: Fixtures):
    urgent = (F.col("cve.severity") == "CRITICAL") & (F.col("status") == "open")
    return expand(entity_vs_findings(f.hosts, f.vulns, "device_id", "aid", urgent))


@query(
    "asset_enrich",
    """select r.resource, r.resource_type, r.compliance,
         coalesce(business_unit, 'undefined') as business_unit, coalesce(team, 'undefined') as team,
         coalesce(location, 'undefined') as location
       from m_vulnerabilities_critical r left join f_assets using (resource, resource_type)""",
)
def asset_enrich(f: Fixtures):
    """Owners are looked up for the compact rows, before they are multiplied back."""
    measured = catalogue.vulnerabilities_critical(f.raw, AS_OF).drop("detail")
    return expand(enrich_assets(measured, f.assets))


@query(
    "union_metrics",
    """select resource, resource_type, compliance, detail from m_identity_dormant
       union all select resource, resource_type, compliance, null from m_user_awareness
       union all select resource, resource_type, compliance, detail from m_vulnerabilities_critical""",
)
def union(f: Fixtures):
    """By name, in whatever column order, with a column one of them lacks."""
    return union_metrics(
        [
            catalogue.identity_dormant(f.raw, AS_OF),
            expand(catalogue.user_awareness(f.raw, AS_OF).drop("detail")),
            expand(catalogue.vulnerabilities_critical(f.raw, AS_OF)).select(
                "detail", "compliance", "resource_type", "resource"
            ),
        ]
    )


def _register_metric(metric_id: str) -> None:
    @query(f"metric_{metric_id}", f"select * from m_{metric_id}")
    def one(f: Fixtures):
        (definition,) = shipped_metrics(metric_id)
        return expand(definition.build(f.raw, AS_OF))


for _definition in shipped_metrics():
    _register_metric(_definition.metric_id)


@query(
    "metric_development_vulnerabilities_inverted",
    """select resource, resource_type, 1.0e0 - compliance as compliance, detail
       from m_development_vulnerabilities""",
)
def development_inverted(f: Fixtures):
    return expand(catalogue.development_vulnerabilities(f.raw, AS_OF, invert=True))


@query(
    "metric_vulnerabilities_critical_per_resource",
    """select resource, resource_type, min(compliance) as compliance, '' as detail
       from m_vulnerabilities_critical group by resource, resource_type""",
)
def critical_per_resource(f: Fixtures):
    """Each host once, however many findings it has."""
    return catalogue.vulnerabilities_critical(f.raw, AS_OF, per_resource=True)


@query(
    "metric_development_vulnerabilities_per_resource",
    """select resource, resource_type, max(compliance) as compliance, min(detail) as detail
       from m_development_vulnerabilities group by resource, resource_type""",
)
def development_per_resource(f: Fixtures):
    """Each project name once, however many projects share it."""
    return catalogue.development_vulnerabilities(f.raw, AS_OF, per_resource=True)


@query(
    "metric_user_awareness_per_resource",
    """select resource, resource_type, max(compliance) as compliance, detail
       from m_user_awareness group by resource, resource_type, detail""",
)
def awareness_per_resource(f: Fixtures):
    return catalogue.user_awareness(f.raw, AS_OF, per_resource=True)


SQL_METRIC = """
    select h.hostname as resource, 'host' as resource_type,
      case when v.aid is null then 1 else 0 end as compliance, '' as detail
    from {{ ref('crowdstrike_hosts') }} as h
    left join {{ ref('crowdstrike_vulnerabilities') }} as v
      on h.device_id = v.aid and v.status = 'open'
      and cast(v.created_timestamp as date) < :as_of - interval '30 day'
"""


@query(
    "metric_sql",
    """select hostname as resource, 'host' as resource_type,
         case when aid is null then 1 else 0 end as compliance, '' as detail
       from f_hosts left join f_vulns on device_id = aid and status = 'open'
         and created_timestamp < date '2001-08-02' - interval 30 day""",
)
def sql_metric(f: Fixtures):
    """A user's own metric, written as a SQL text."""
    return expand(metric_sql(SQL_METRIC, f.raw, AS_OF))


SQL_WORST = """
    select h.hostname as resource, v.cve.severity as resource_type,
      case when v.cve.severity = 'CRITICAL' then 0.0 else 1.0 end as compliance,
      concat(h.device_id, ' ', v.status) as detail
    from {{ ref('crowdstrike_hosts') }} as h
    left join {{ ref('crowdstrike_vulnerabilities') }} as v on h.device_id = v.aid and v.status <> 'closed'
    where v.aid is null or v.cve.severity is not null
"""


@query(
    "metric_sql_columns",
    """select hostname as resource, severity as resource_type,
         case when severity = 'CRITICAL' then 0.0e0 else 1.0e0 end as compliance,
         device_id || ' ' || status as detail
       from f_hosts left join f_vulns on device_id = aid and status <> 'closed'
       where aid is null or severity is not null""",
)
def sql_metric_columns(f: Fixtures):
    """One that shows columns of the findings, and filters the joined rows."""
    return expand(metric_sql(SQL_WORST, f.raw, AS_OF)).withColumn("compliance", F.col("compliance").cast("double"))


@query("metric_run", "select * from m_detail")
def metric_run(f: Fixtures):
    return plan_metrics(shipped_metrics(), f.raw, AS_OF, f.assets).detail


@query(
    "metric_run_summary",
    """select metric_id, sum(totalok) as totalok, cast(sum(total) as bigint) as total,
         round_even(sum(totalok) / sum(total) * 100, 2) as score
       from m_summary group by metric_id""",
)
def metric_run_summary(f: Fixtures):
    """Scores of a run, from its compact rows."""
    return metric_scores(plan_metrics(shipped_metrics(), f.raw, AS_OF, f.assets).rows)


@query("landed_metrics", "select * from m_detail where metric_id like 'vulnerabilities%'")
def landed_metrics(f: Fixtures):
    """Landed and read with defaults; findings name their severity beside ``cve`` or inside it."""
    root = scratch_path(f.spark, "landed")
    beside = F.crc32(F.col("aid").cast("binary")) % 2 == 0
    cve = F.col("cve")
    outside = {c: F.when(beside, cve[c]) for c in ("severity", "published_date")}
    inside = cve
    for c in outside:
        inside = inside.withField(c, F.when(~beside, cve[c]))
    raw.land(with_lineage(f.hosts, "acme", UPLOADED), root, "crowdstrike_hosts")
    findings = f.vulns.withColumns({**outside, "cve": inside})
    raw.land(with_lineage(findings, "acme", UPLOADED), root, "crowdstrike_vulnerabilities")
    metrics = [d for d in shipped_metrics() if d.family]
    return plan_metrics(metrics, raw.RawTables(f.spark, root), AS_OF, f.assets).detail


BROKEN = [
    ("missing_table", "select 1 from {{ ref('nowhere') }}"),
    ("fails", "select raise_error('broken') as resource, '' as resource_type, 1 as compliance, '' as detail "
              "from {{ ref('crowdstrike_hosts') }}"),
    ("nobody", "select hostname as resource, 'host' as resource_type, 1 as compliance, '' as detail "
               "from {{ ref('crowdstrike_hosts') }} where hostname = ''"),
    ("twice", "select hostname as resource, 'host' as resource_type, 1 as compliance, '' as detail "
              "from {{ ref('crowdstrike_hosts') }}"),
    ("twice", "select hostname as resource, 'host' as resource_type, 0 as compliance, '' as detail "
              "from {{ ref('crowdstrike_hosts') }} where device_id % 2 = 0"),
]


@query(
    "metric_run_report",
    """select 'vulnerabilities_critical' as metric_id, 'measured' as status, count(*) as rows
       from m_vulnerabilities_critical
       union all select 'missing_table', 'failed', null union all select 'fails', 'failed', null
       union all select 'nobody', 'empty', 0
       union all select 'twice', 'measured', count(*) from f_hosts
       union all select 'twice', 'measured', count(*) from f_hosts where cast(device_id as bigint) % 2 = 0""",
)
def metric_run_report(f: Fixtures):
    """A run with a missing table, a failing metric, an empty one, and an id used twice."""
    library = ("Title", "Category", 0.9, 0.8, 0.5)
    metrics = [MetricDefinition(m, *library, query=q) for m, q in BROKEN]
    run = run_metrics([*shipped_metrics("vulnerabilities_critical"), *metrics], f.raw, AS_OF, scratch_path(f.spark, "staging"))
    found = [{"metric_id": o.metric_id, "status": o.status, "rows": o.rows if o.status != "failed" else None} for o in run.report]
    return local_table(f.spark, found, T.StructType.fromDDL("metric_id string, status string, rows long"))


_PUBLISHED: dict[tuple[str, str], Store] = {}


def _published(f: Fixtures) -> Store:
    """A store after runs of two days, the second repeated; made once for a session and data set."""
    key = (f.spark.sparkContext.applicationId, f.sf_dir)
    if key not in _PUBLISHED:
        store = Store(scratch_path(f.spark, "publish"))
        for day in (AS_OF - dt.timedelta(days=1), AS_OF, AS_OF):
            staging = scratch_path(f.spark, "staging")
            publish(run_metrics(shipped_metrics(), f.raw, day, staging, f.assets), store, day)
        _PUBLISHED[key] = store
    return _PUBLISHED[key]


@query("publish_run", "select * from m_summary")
def publish_run(f: Fixtures):
    """Whole runs: measured, staged, both tables replaced, both copies published."""
    return _published(f).read_summary(f.spark).filter(F.col("datestamp") == F.lit(AS_OF))


BOTH_DAYS = on_days("select * from m_summary", "2001-08-01", RUN_DATE)


@query("publish_run_days", BOTH_DAYS)
def publish_run_days(f: Fixtures):
    """The summary holds the runs of both days, each with its own ages."""
    return _published(f).read_summary(f.spark)


@query("publish_summary_csv_days", BOTH_DAYS)
def publish_summary_csv_days(f: Fixtures):
    """Two dates are fewer than a sample holds, so both are published."""
    return read_summary_csv(f.spark, _published(f).summary_csv)


@query("publish_detail", "select * from m_detail")
def publish_detail(f: Fixtures):
    """The detail holds the newest run alone."""
    return _published(f).read_detail(f.spark)


@query(
    "publish_detail_csv",
    """select cast(datestamp as string) as datestamp, metric_id, 'redacted' as resource, 'redacted' as detail,
         count(*) as n from m_detail group by all""",
)
def publish_detail_csv(f: Fixtures):
    """The published copy is redacted."""
    rows = read_csv_strings(f.spark, _published(f).detail_csv, schemas.DETAIL.fieldNames())
    return rows.groupBy("datestamp", "metric_id", "resource", "detail").agg(F.count(F.lit(1)).alias("n"))


@query("publish_summary_csv", "select * from m_summary")
def publish_summary_csv(f: Fixtures):
    """The published summary; the sampled dates include the newest."""
    return read_summary_csv(f.spark, _published(f).summary_csv).filter(F.col("datestamp") == F.lit(AS_OF))


@query(
    "scalar_date",
    """select event_id, case when event_id % 5 <> 0 then cast(ts as date) end as day,
         cast(cast(ts as date) - interval 14 day as date) as two_weeks_before,
         cast(cast(ts as date) - interval 12 month as date) as year_before
       from events""",
)
def scalar_date(f: Fixtures):
    """ISO text to date, blanks to NULL; day and month intervals taken off."""
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    text = F.when(F.col("event_id") % 5 == 0, "").otherwise(iso)
    return f.table("events").select(
        "event_id",
        to_date_lenient(text).alias("day"),
        date_minus(F.col("ts"), days=14).alias("two_weeks_before"),
        date_minus(F.col("ts"), months=12).alias("year_before"),
    )


@query(
    "safe_ratio",
    """select event_id, case when user_id % 3 = 0 then 0.0 else value / (user_id % 3) end as or_zero,
         value / nullif(user_id % 3, 0) as or_null from events""",
)
def ratio(f: Fixtures):
    parts = F.col("user_id") % 3
    return f.table("events").select(
        "event_id",
        safe_ratio("value", parts).alias("or_zero"),
        safe_ratio("value", parts, default=None).alias("or_null"),
    )


@query(
    "lenient_number",
    """select event_id, case when event_id % 4 in (0, 1, 2) then 0.0 else value end as number
       from events""",
)
def lenient(f: Fixtures):
    """NULL, blank and non-numeric text are 0."""
    kind = F.col("event_id") % 4
    text = (
        F.when(kind == 0, F.lit(None).cast("string"))
        .when(kind == 1, "")
        .when(kind == 2, "n/a")
        .otherwise(F.col("value").cast("string"))
    )
    return f.table("events").select("event_id", lenient_number(text).alias("number"))
