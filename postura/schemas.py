"""Declared schemas of every table the package reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T

# Group keys of the summary table, in the order reports print them.
SUMMARY_KEYS = (
    "datestamp",
    "metric_id",
    "title",
    "category",
    "slo",
    "slo_min",
    "weight",
    "business_unit",
    "team",
    "location",
)

# What one run replaces in the summary, and what it replaces in the detail.
SUMMARY_REPLACE_KEYS = ("metric_id", "datestamp")
# How the stored summary is laid out: reports choose dates.
SUMMARY_PARTITIONS = ("datestamp",)
DETAIL_REPLACE_KEYS = ("metric_id",)

DIMENSIONS = ("business_unit", "team", "location")
CONTRACT = ("resource", "resource_type", "compliance", "detail")
METADATA = ("metric_id", "title", "category", "slo", "slo_min", "weight")
LINEAGE = ("_tenancy", "_upload_timestamp", "_upload_id")

_TYPES = {
    "datestamp": T.DateType(),
    "slo": T.DoubleType(),
    "slo_min": T.DoubleType(),
    "weight": T.DoubleType(),
    "compliance": T.DoubleType(),
    "totalok": T.DoubleType(),
    "total": T.LongType(),
    "_upload_timestamp": T.TimestampType(),
}


def _table(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES.get(n, T.StringType())) for n in names])


DETAIL = _table(
    "datestamp",
    *METADATA,
    *DIMENSIONS,
    "resource",
    "resource_type",
    "detail",
    "compliance",
)
SUMMARY = _table(*SUMMARY_KEYS, "totalok", "total")
LIBRARY = _table(*METADATA)
ASSETS = _table("resource", "resource_type", *DIMENSIONS)
DOCUMENTS = T.StructType(
    [
        T.StructField("upload_timestamp", T.TimestampType()),
        T.StructField("tenancy", T.StringType()),
        T.StructField("json_data", T.StringType()),
    ]
)


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


def _struct(name: str, *fields: T.StructField) -> T.StructField:
    return T.StructField(name, T.StructType(list(fields)))


def _raw(*fields: T.StructField) -> T.StructType:
    return T.StructType([*fields, *_table(*LINEAGE).fields])


# The field names the identity source delivers in a profile.
PROFILE_FIELDS = (
    "login",
    "first_name",
    "last_name",
    "nick_name",
    "display_name",
    "email",
    "secondEmail",
    "profile_url",
    "preferred_language",
    "user_type",
    "organization",
    "title",
    "division",
    "department",
    "cost_center",
    "employee_number",
    "mobile_phone",
    "primary_phone",
    "street_address",
    "city",
    "state",
    "zip_code",
    "country_code",
)

# Raw tags whose record shape is known.  Tags missing here are passed through
# as delivered: the reader infers their schema, or takes one from the caller.
RAW = {
    "crowdstrike_hosts": _raw(*_strings("device_id", "hostname")),
    "crowdstrike_vulnerabilities": _raw(
        *_strings("aid", "status", "created_timestamp", "updated_timestamp", "last_seen"),
        # Some deliveries name these beside ``cve`` instead of inside it.
        *_strings("severity", "published_date"),
        _struct(
            "cve",
            *_strings("id", "severity", "published_date", "remediation_level"),
            T.StructField("exploit_status", T.IntegerType()),
        ),
    ),
    "okta_users": _raw(
        *_strings(
            "id",
            "status",
            "created",
            "activated",
            "status_changed",
            "last_login",
            "last_updated",
            "password_changed",
        ),
        _struct("type", *_strings("id")),
        _struct("profile", *_strings(*PROFILE_FIELDS)),
    ),
    "knowbe4_enrollments": _raw(_struct("user", *_strings("email")), *_strings("completion_date")),
    "snyk_organizations": _raw(*_strings("id")),
    "snyk_projects": _raw(*_strings("id"), _struct("attributes", *_strings("name", "target_file"))),
    "snyk_issues": _raw(
        _struct("attributes", *_strings("status", "effective_severity_level")),
        _struct("relationships", _struct("scan_item", _struct("data", *_strings("id")))),
    ),
}

# Delivered by the sources but read by no shipped metric.
OPAQUE_TAGS = (
    "crowdstrike_zero_trust_assessment",
    "snyk_members",
    "tenable_findings",
    "tenable_assets",
    "tenable_was",
    "tenable_vulnerabilities",
)
