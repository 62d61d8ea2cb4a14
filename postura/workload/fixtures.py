"""Inputs of the registered queries, derived by Spark from the given tables.

The raw security tables are built from customers, orders, parts and line items; their
fields are nested as the sources nest them.  All of them grow with the given tables.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postura import schemas
from postura.operators.rollups import summarise
from postura.operators.sizing import local_table
from postura.session import scratch_path
from postura.sources.raw import RawTables
from postura.sources.tables import read_table

AS_OF = dt.date(2001, 8, 2)
YEAR_END = dt.date(2001, 11, 4)

# The metric library of the detail fixture, by part type.
LIBRARY_ROWS = [
    ("economy", "Economy", "Vulnerability Management", 0.68, 0.66, 0.2),
    ("large", "Large", "Vulnerability Management", 0.66, 0.60, 0.8),
    ("medium", "Medium", "Identity Management", 0.67, 0.665, 0.8),
    ("promo", "Promo", "Identity Management", 0.70, 0.65, 0.4),
    ("small", "Small", "User Security", 0.75, 0.70, 0.4),
    ("standard", "Standard", "Software Development", 0.65, 0.60, 0.8),
]


def _case(column: str, values: dict[str, str], default: str | None = None) -> Column:
    c = F.lit(default).cast("string")
    for value, result in reversed(values.items()):
        c = F.when(F.col(column) == value, F.lit(result)).otherwise(c)
    return c


# Schemas of the given tables, by path: footers are read once per process.
_SCHEMAS: dict[str, T.StructType] = {}
# Stored summaries, by application and data set.
_STORED: dict[tuple[str, str], DataFrame] = {}


class Fixtures:
    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            path = f"{self.sf_dir}/{name}.parquet"
            if path not in _SCHEMAS:
                _SCHEMAS[path] = self.spark.read.parquet(path).schema
            self._tables[name] = self.spark.read.schema(_SCHEMAS[path]).parquet(path)
        return self._tables[name]

    # --- raw tables --------------------------------------------------------------------

    @cached_property
    def hosts(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").cast("string").alias("device_id"), F.col("c_name").alias("hostname")
        )

    @cached_property
    def vulns(self) -> DataFrame:
        key = F.col("o_orderkey")
        day = F.col("o_orderdate").cast("date").cast("string")
        severity = {
            "1-URGENT": "CRITICAL",
            "2-HIGH": "HIGH",
            "3-MEDIUM": "MEDIUM",
            "5-LOW": "LOW",
        }
        return self.table("orders").select(
            F.col("o_custkey").cast("string").alias("aid"),
            _case("o_orderstatus", {"O": "open", "P": "reopen"}, "closed").alias("status"),
            day.alias("created_timestamp"),
            day.alias("updated_timestamp"),
            day.alias("last_seen"),
            F.struct(
                F.when(key % 11 == 0, "").otherwise(F.concat(F.lit("CVE-"), key)).alias("id"),
                _case("o_orderpriority", severity).alias("severity"),
                day.alias("published_date"),
                F.when(key % 3 == 0, "O").when(key % 3 == 1, "U").alias("remediation_level"),
                F.when(key % 4 < 3, (key % 4 * 30).cast("int")).alias("exploit_status"),
            ).alias("cve"),
        )

    @cached_property
    def users(self) -> DataFrame:
        day = F.col("o_orderdate").cast("date")
        logins = (
            self.table("orders")
            .groupBy("o_custkey")
            .agg(
                F.max(day).cast("string").alias("last_login"),
                F.min(day).cast("string").alias("password_changed"),
            )
        )
        return (
            self.table("customer")
            .join(logins, F.col("o_custkey") == F.col("c_custkey"), "left")
            .select(
                F.struct(F.col("c_name").alias("login")).alias("profile"),
                F.when(F.col("c_nationkey") % 5 == 0, "SUSPENDED").otherwise("ACTIVE").alias("status"),
                "last_login",
                "password_changed",
            )
        )

    @cached_property
    def enrollments(self) -> DataFrame:
        customer = self.table("customer").select("c_custkey", "c_name")
        return (
            self.table("orders")
            .filter(F.col("o_orderpriority") == "5-LOW")
            .join(customer, F.col("c_custkey") == F.col("o_custkey"))
            .select(
                F.struct(F.col("c_name").alias("email")).alias("user"),
                F.col("o_orderdate").cast("date").cast("string").alias("completion_date"),
            )
        )

    @cached_property
    def projects(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").cast("string").alias("id"),
            F.struct(
                F.col("p_name").alias("name"), F.col("p_type").alias("target_file")
            ).alias("attributes"),
        )

    @cached_property
    def issues(self) -> DataFrame:
        q = F.col("l_quantity")
        level = (
            F.when(q >= 49, "critical").when(q >= 47, "high").when(q >= 25, "medium").otherwise("low")
        )
        data = F.struct(F.col("l_partkey").cast("string").alias("id"))
        return self.table("lineitem").select(
            F.struct(F.struct(data.alias("data")).alias("scan_item")).alias("relationships"),
            F.struct(
                _case("l_linestatus", {"O": "open"}, "resolved").alias("status"),
                level.alias("effective_severity_level"),
            ).alias("attributes"),
        )

    @cached_property
    def raw(self) -> RawTables:
        return FixtureTables(self)

    # --- dimensions, detail, summary ---------------------------------------------------

    def _owners(self) -> DataFrame:
        """Customers with their region, nation and market segment."""
        places = self.table("nation").join(
            self.table("region"), F.col("r_regionkey") == F.col("n_regionkey")
        )
        return (
            self.table("customer")
            .join(places, F.col("n_nationkey") == F.col("c_nationkey"))
            .select(
                "c_custkey",
                "c_name",
                F.col("r_name").alias("business_unit"),
                F.col("n_name").alias("team"),
                F.col("c_mktsegment").alias("location"),
            )
        )

    @cached_property
    def assets(self) -> DataFrame:
        return (
            self._owners()
            .filter(F.col("c_custkey") % 10 != 0)
            .select(
                F.col("c_name").alias("resource"),
                F.lit("host").alias("resource_type"),
                *schemas.DIMENSIONS,
            )
        )

    @cached_property
    def library(self) -> DataFrame:
        rows = [dict(zip(schemas.METADATA, r, strict=True)) for r in LIBRARY_ROWS]
        return local_table(self.spark, rows, schemas.LIBRARY)

    @cached_property
    def detail(self) -> DataFrame:
        owned = (
            self.table("orders")
            .select("o_orderkey", "o_custkey")
            .join(self._owners(), F.col("c_custkey") == F.col("o_custkey"))
            .select("o_orderkey", *schemas.DIMENSIONS)
        )
        parts = self.table("part").select(
            "p_partkey", F.col("p_name").alias("detail"), F.lower("p_type").alias("metric_id")
        )
        line = F.concat(F.lit("line-"), F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber"))
        return (
            self.table("lineitem")
            .join(owned, F.col("o_orderkey") == F.col("l_orderkey"))
            .join(parts, F.col("p_partkey") == F.col("l_partkey"))
            .join(self.library, "metric_id")
            .withColumns(
                {
                    "datestamp": F.col("l_shipdate").cast("date"),
                    "resource": line,
                    "resource_type": F.lit("line"),
                    "compliance": F.when(F.col("l_returnflag") == "R", 0.0).otherwise(1.0),
                }
            )
            .select(*schemas.DETAIL.fieldNames())
        )

    @cached_property
    def summary(self) -> DataFrame:
        return summarise(self.detail)

    @cached_property
    def stored_summary(self) -> DataFrame:
        """The whole summary as reports find it: a table on storage, partitioned by date.

        It is written, and its files listed, once for a session and data set.
        """
        key = (self.spark.sparkContext.applicationId, self.sf_dir)
        if key not in _STORED:
            path = scratch_path(self.spark, "summary")
            rows = self.summary.hint("rebalance", *schemas.SUMMARY_PARTITIONS)
            rows.write.partitionBy(*schemas.SUMMARY_PARTITIONS).parquet(path)
            _STORED[key] = read_table(self.spark, path, schemas.SUMMARY)
        return _STORED[key]

    # --- table maintenance -------------------------------------------------------------

    @cached_property
    def run_detail(self) -> DataFrame:
        return self.detail.filter(
            F.col("datestamp").between(F.lit(dt.date(2001, 7, 1)), F.lit(dt.date(2001, 7, 31)))
            & F.col("metric_id").isin("economy", "large", "small")
        )

    @cached_property
    def old_summary(self) -> DataFrame:
        return self.summary.withColumn("total", F.col("total") + 1)

    @cached_property
    def old_detail(self) -> DataFrame:
        return self.detail

    # --- nulls, blanks, snapshots, pages -----------------------------------------------

    @cached_property
    def nulls(self) -> DataFrame:
        group = F.col("user_id") % 7
        return self.table("events").select(
            "event_id",
            "event_type",
            F.when(group == 0, F.lit(None).cast("string"))
            .when(group == 1, "")
            .otherwise(F.concat(F.lit("u"), group))
            .alias("dim"),
            F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("measure"),
        )

    @cached_property
    def uploads(self) -> DataFrame:
        return self.table("events").select(
            F.col("event_type").alias("tag"),
            F.when(F.col("user_id") % 4 != 3, F.concat(F.lit("t"), F.col("user_id") % 4)).alias("tenancy"),
            F.col("ts").cast("date").alias("upload_date"),
            "event_id",
            "value",
        )

    @cached_property
    def pages(self) -> DataFrame:
        """Orders in pages of at most 400 keys per parent, as a paged API delivers them.

        One parent declares a row more than it delivers.
        """
        orders = self.table("orders")
        declared = orders.groupBy("o_orderstatus").agg(
            (F.count(F.lit(1)) + F.max((F.col("o_orderstatus") == "P").cast("int"))).alias("total")
        )
        record = F.struct("o_orderkey", "o_custkey", "o_totalprice")
        return (
            orders.groupBy("o_orderstatus", F.floor(F.col("o_orderkey") / 400).alias("page"))
            .agg(F.collect_list(record).alias("resources"))
            .join(declared, "o_orderstatus")
            .select(
                F.col("o_orderstatus").alias("parent"), F.struct("resources").alias("body"), "total"
            )
        )


class FixtureTables(RawTables):
    """The raw tables by the names metrics know, built when a metric asks for them."""

    PROPERTIES = {
        "crowdstrike_hosts": "hosts",
        "crowdstrike_vulnerabilities": "vulns",
        "okta_users": "users",
        "knowbe4_enrollments": "enrollments",
        "snyk_projects": "projects",
        "snyk_issues": "issues",
    }

    def __init__(self, fixtures: Fixtures) -> None:
        super().__init__(fixtures.spark)
        self.fixtures = fixtures

    def _find(self, tag: str) -> DataFrame:
        if tag in self.PROPERTIES:
            return getattr(self.fixtures, self.PROPERTIES[tag])
        return super()._find(tag)
