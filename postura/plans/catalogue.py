"""The shipped metrics as DataFrame functions ``(tables, as_of) -> DataFrame``.

Each returns the contract columns.  Metrics that count a resource once per finding return
compact rows, which ``operators.matching.expand`` multiplies back.  Metrics that ask several
questions of the same two tables form a family, measured in one pass.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postura.functions.dates import DateLike, age_days, older_than
from postura.functions.predicates import compliance
from postura.operators.matching import COPIES, Matching, as_fan_out, entity_vs_findings, with_counts
from postura.sources.library import MetricDefinition
from postura.sources.raw import RawTables

# Status and severity words of the sources, and the metrics' day limits.
OPEN_STATES = ("open", "reopen")
URGENT = ("HIGH", "CRITICAL")
URGENT_ISSUE = ("critical", "high")
ACTIVE = "ACTIVE"
OFFICIAL_FIX = "O"
PUBLISHED_DAYS = 14
CREATED_DAYS = 30
DORMANT_DAYS = 90
TRAINING_DAYS = 365
# Our choice; the metric is described without a limit.
CREDENTIAL_DAYS = 90


def _measured(df: DataFrame, resource: str, kind: str, ok: Column, detail: Column) -> DataFrame:
    return df.select(
        F.col(resource).alias("resource"),
        F.lit(kind).alias("resource_type"),
        compliance(ok).alias("compliance"),
        detail.cast("string").alias("detail"),
        *[c for c in df.columns if c == COPIES],
    )


def one_per_resource(measured: DataFrame, worst: bool) -> DataFrame:
    """A row for each resource, however many entities share its name: its worst or best state."""
    state = (F.min if worst else F.max)("compliance").alias("compliance")
    return measured.groupBy("resource", "resource_type").agg(state, F.min("detail").alias("detail"))


# --- hosts against vulnerabilities -----------------------------------------------------


def _finding_field(findings: DataFrame, name: str) -> Column:
    """A field of the finding itself where the row has it there, else of its ``cve``."""
    inside = F.col(f"cve.{name}")
    return F.coalesce(F.col(name), inside) if name in findings.columns else inside


def _urgent(findings: DataFrame, as_of: DateLike) -> Column:
    urgent = F.col("cve.severity").isin(*URGENT)
    if "severity" in findings.columns:  # spelt out, so that the filter reaches the files
        own = F.col("severity")
        urgent = own.isin(*URGENT) | (own.isNull() & urgent)
    return F.col("status").isin(*OPEN_STATES) & urgent


def _urgent_overdue(findings: DataFrame, as_of: DateLike) -> Column:
    published = _finding_field(findings, "published_date")
    return (
        _urgent(findings, as_of)
        & older_than(published, as_of, PUBLISHED_DAYS)
        & older_than("created_timestamp", as_of, CREATED_DAYS)
    )


def _exploitable_patchable(findings: DataFrame, as_of: DateLike) -> Column:
    return (
        F.col("status").isin(*OPEN_STATES)
        & (F.col("cve.remediation_level") == OFFICIAL_FIX)
        & (F.col("cve.exploit_status") > 0)
    )


HOST_CONDITIONS: dict[str, Callable[[DataFrame, DateLike], Column]] = {
    "vulnerabilities_critical": _urgent,
    "vulnerabilities_critical_patching": _urgent_overdue,
    "vulnerabilities_explot_patchable": _exploitable_patchable,
}


def _hosts(tables: RawTables) -> DataFrame:
    return tables.ref("crowdstrike_hosts").select("device_id", "hostname")


def _host_rows(counted: DataFrame, metric_ids: Sequence[str], per_resource: bool = False) -> DataFrame:
    """A row for each host and metric, from a count for each metric."""
    answers = F.array(
        *[F.struct(F.lit(m).alias("metric_id"), F.col(m).alias("_matches")) for m in metric_ids]
    )
    rows = counted.select("hostname", F.explode(answers).alias("_a")).select("hostname", "_a.*")
    if per_resource:
        rows = rows.groupBy("metric_id", "hostname").agg(F.max("_matches").alias("_matches"))
    rows = as_fan_out(rows, "_matches")
    measured = rows.select(
        "metric_id",
        F.col("hostname").alias("resource"),
        F.lit("host").alias("resource_type"),
        compliance(~F.col("matched")).alias("compliance"),
        F.lit("").alias("detail"),
        COPIES,
    )
    return measured.drop(COPIES) if per_resource else measured


HOST_MATCHING = Matching(
    "crowdstrike_vulnerabilities", "aid", HOST_CONDITIONS, _hosts, "device_id", _host_rows
)


def host_metrics(
    tables: RawTables,
    as_of: DateLike,
    metric_ids: Sequence[str] = tuple(HOST_CONDITIONS),
    per_resource: bool = False,
) -> DataFrame:
    """Hosts free of the findings each metric looks for, with a ``metric_id`` column.

    One scan and one shuffle of the findings answer all of ``metric_ids``.
    """
    findings = tables.ref(HOST_MATCHING.tag)
    counts = HOST_MATCHING.counts(findings, as_of, metric_ids)
    counted = with_counts(_hosts(tables), counts, HOST_MATCHING.entity_key, metric_ids)
    return _host_rows(counted, metric_ids, per_resource)


def _host_metric(metric_id: str) -> Callable[..., DataFrame]:
    def build(tables: RawTables, as_of: DateLike, per_resource: bool = False) -> DataFrame:
        return host_metrics(tables, as_of, [metric_id], per_resource).drop("metric_id")

    return build


vulnerabilities_critical = _host_metric("vulnerabilities_critical")
vulnerabilities_critical_patching = _host_metric("vulnerabilities_critical_patching")
vulnerabilities_explot_patchable = _host_metric("vulnerabilities_explot_patchable")


# --- projects against issues -----------------------------------------------------------

DEVELOPMENT = "development_vulnerabilities"


def _urgent_issue(issues: DataFrame, as_of: DateLike) -> Column:
    severity = F.col("attributes.effective_severity_level")
    return (F.col("attributes.status") == "open") & severity.isin(*URGENT_ISSUE)


def _projects(tables: RawTables) -> DataFrame:
    return tables.ref("snyk_projects").select("id", "attributes.name", "attributes.target_file")


def _project_rows(rows: DataFrame, invert: bool = False) -> DataFrame:
    matched = F.col("matched")
    return _measured(rows, "name", "snyk", ~matched if invert else matched, F.col("target_file"))


def development_vulnerabilities(
    tables: RawTables, as_of: DateLike, per_resource: bool = False, invert: bool = False
) -> DataFrame:
    """Projects against open urgent issues.

    A project *with* an issue counts as compliant, as users' history has it;
    ``invert`` measures what the title says.
    """
    issues = tables.ref(PROJECT_MATCHING.tag)
    rows = entity_vs_findings(
        _projects(tables),
        issues,
        PROJECT_MATCHING.entity_key,
        PROJECT_MATCHING.finding_key,
        _urgent_issue(issues, as_of),
        per_entity=per_resource,
    )
    found = _project_rows(rows, invert)
    # One project with an issue is an issue, so it decides for all of the name.
    return one_per_resource(found, worst=invert) if per_resource else found


PROJECT_MATCHING = Matching(
    "snyk_issues",
    "relationships.scan_item.data.id",
    {DEVELOPMENT: _urgent_issue},
    _projects,
    "id",
    lambda counted, _: _project_rows(as_fan_out(counted, DEVELOPMENT)).withColumn("metric_id", F.lit(DEVELOPMENT)),
)


# --- users -----------------------------------------------------------------------------


def _active_users(tables: RawTables) -> DataFrame:
    return tables.ref("okta_users").filter(F.col("status") == ACTIVE)


def identity_dormant(tables: RawTables, as_of: DateLike) -> DataFrame:
    """Active users who logged in lately; never having logged in fails."""
    fresh = age_days("last_login", as_of) < DORMANT_DAYS
    return _measured(_active_users(tables), "profile.login", "user", fresh, F.col("last_login"))


def identity_credentials(
    tables: RawTables, as_of: DateLike, max_age_days: int = CREDENTIAL_DAYS
) -> DataFrame:
    """Active users who changed their password lately."""
    fresh = age_days("password_changed", as_of) < max_age_days
    return _measured(
        _active_users(tables), "profile.login", "user", fresh, F.col("password_changed")
    )


AWARENESS = "user_awareness"


def _logins(tables: RawTables) -> DataFrame:
    return _active_users(tables).select("profile.login")


def _trained(enrollments: DataFrame, as_of: DateLike) -> Column:
    return age_days("completion_date", as_of) <= TRAINING_DAYS


def _user_rows(rows: DataFrame) -> DataFrame:
    return _measured(rows, "login", "user", F.col("matched"), F.col("login"))


def user_awareness(tables: RawTables, as_of: DateLike, per_resource: bool = False) -> DataFrame:
    """Active users with a training completed within a year; one row per training."""
    enrollments = tables.ref(USER_MATCHING.tag)
    rows = entity_vs_findings(
        _logins(tables),
        enrollments,
        USER_MATCHING.entity_key,
        USER_MATCHING.finding_key,
        _trained(enrollments, as_of),
        per_entity=per_resource,
    )
    found = _user_rows(rows)
    return one_per_resource(found, worst=False) if per_resource else found


USER_MATCHING = Matching(
    "knowbe4_enrollments",
    "user.email",
    {AWARENESS: _trained},
    _logins,
    "login",
    lambda counted, _: _user_rows(as_fan_out(counted, AWARENESS)).withColumn("metric_id", F.lit(AWARENESS)),
)


# --- definitions -----------------------------------------------------------------------

HOSTS = "hosts"
FAMILIES: dict[str, Callable[..., DataFrame]] = {HOSTS: host_metrics}

# metric_id, title, category, slo, slo_min, weight.
_METADATA = [
    (
        "development_vulnerabilities",
        "Software repositories without critical vulnerabilities",
        "Software Development",
        0.99,
        0.98,
        0.8,
    ),
    ("identity_credentials", "Identity - Aged Credentials", "Identity Management", 0.99, 0.98, 0.8),
    ("identity_dormant", "Identity - Inactive Identities", "Identity Management", 0.99, 0.98, 0.8),
    ("user_awareness", "Users with awareness training completed", "User Security", 0.90, 0.80, 0.4),
    (
        "vulnerabilities_critical",
        "Systems without Critical and High vulnerabilities",
        "Vulnerability Management",
        0.95,
        0.80,
        0.2,
    ),
    (
        "vulnerabilities_critical_patching",
        "Critical vulnerabilities patched within SLO",
        "Vulnerability Management",
        0.95,
        0.80,
        0.2,
    ),
    (
        "vulnerabilities_explot_patchable",
        "Systems without exploitable vulnerabilities",
        "Vulnerability Management",
        0.95,
        0.80,
        0.8,
    ),
]

_BUILD = {
    "development_vulnerabilities": development_vulnerabilities,
    "identity_credentials": identity_credentials,
    "identity_dormant": identity_dormant,
    "user_awareness": user_awareness,
    "vulnerabilities_critical": vulnerabilities_critical,
    "vulnerabilities_critical_patching": vulnerabilities_critical_patching,
    "vulnerabilities_explot_patchable": vulnerabilities_explot_patchable,
}


# How each metric counts findings, and the raw table whose rows it measures one by one.
_MATCHING = {DEVELOPMENT: PROJECT_MATCHING, AWARENESS: USER_MATCHING} | dict.fromkeys(HOST_CONDITIONS, HOST_MATCHING)
_ENTITIES = {DEVELOPMENT: "snyk_projects"} | dict.fromkeys(HOST_CONDITIONS, "crowdstrike_hosts")


def shipped_metrics(only: str | None = None) -> list[MetricDefinition]:
    return [
        MetricDefinition(
            metric_id,
            title,
            category,
            slo,
            slo_min,
            weight,
            description=(_BUILD[metric_id].__doc__ or title).splitlines()[0],
            build=_BUILD[metric_id],
            family=HOSTS if metric_id in HOST_CONDITIONS else None,
            matching=_MATCHING.get(metric_id),
            entity_tag=_ENTITIES.get(metric_id, "okta_users"),
        )
        for metric_id, title, category, slo, slo_min, weight in _METADATA
        if only in (None, metric_id)
    ]
