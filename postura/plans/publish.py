"""One publishing run: both maintained tables, both published copies, the alert.

All four are tables of one versioned root, so a run becomes visible as a whole or not at all.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from postura import schemas
from postura.functions.dates import DateLike
from postura.operators.maintenance import redact, replace_keys
from postura.operators.rollups import alert_table, summarise
from postura.operators.sampling import summary_sample, v_summary
from postura.operators.sizing import local_table
from postura.plans.alerts import alert_lines, alert_message
from postura.plans.runner import MetricRun
from postura.session import conf, scratch_path
from postura.sources.paths import delete, has_files
from postura.sources.tables import CSV_OPTIONS, read_or_empty, read_table
from postura.sources.versions import Change, Snapshot, VersionedRoot


DETAIL, SUMMARY = "detail", "summary"
DETAIL_CSV, SUMMARY_CSV = "published/detail.csv", "published/summary.csv"


@dataclass(frozen=True)
class Store:
    """Where the tables live: any URI Spark can write to."""

    root: str

    def versions(self, spark: SparkSession) -> VersionedRoot:
        return VersionedRoot(spark, self.root)

    def current(self, spark: SparkSession) -> Snapshot:
        """The state to read several tables from, so that they belong together."""
        return self.versions(spark).current()

    def begin(self, spark: SparkSession) -> Change:
        """A change of the store; tables written before there were versions become part of it."""
        change = self.versions(spark).begin()
        if not change.base.number:
            for table, schema, by in _MAINTAINED:
                path = f"{self.root}/{table}"
                if has_files(spark, path):
                    change.write(read_table(spark, path, schema).hint("rebalance", *by), table, by)
        return change

    def _published(self, table: str) -> str:
        snapshot = self.current(SparkSession.active())
        return snapshot.path(table, "") if snapshot.parts(table) else f"{self.root}/{table}"

    @property
    def detail_csv(self) -> str:
        """The published detail, as it stands now."""
        return self._published(DETAIL_CSV)

    @property
    def summary_csv(self) -> str:
        return self._published(SUMMARY_CSV)

    def _read(self, spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
        snapshot = self.current(spark)
        if not snapshot.number:
            return read_or_empty(spark, f"{self.root}/{table}", schema)
        return snapshot.read(spark, table, schema)

    def read_detail(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, DETAIL, schemas.DETAIL)

    def read_summary(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, SUMMARY, schemas.SUMMARY)


_MAINTAINED = (
    (DETAIL, schemas.DETAIL, schemas.DETAIL_REPLACE_KEYS),
    (SUMMARY, schemas.SUMMARY, schemas.SUMMARY_PARTITIONS),
)


def create_views(spark: SparkSession, store: Store, as_of: DateLike) -> None:
    """``detail``, ``summary`` and ``v_summary`` for SQL users; empty before the first run."""
    summary = store.read_summary(spark)
    store.read_detail(spark).createOrReplaceTempView("detail")
    summary.createOrReplaceTempView("summary")
    v_summary(summary, as_of).createOrReplaceTempView("v_summary")


def write_detail(run: MetricRun, change: Change) -> None:
    """Each metric of the run replaces its rows; other metrics' files are not touched.

    The rows come dealt by metric, as many files to a metric as its rows need.
    """
    rows = run.dealt_detail.select(*schemas.DETAIL.fieldNames())
    # A task holds a metric or few: it writes them side by side and need not sort its rows.
    with conf(change.spark, "spark.sql.maxConcurrentOutputFileWriters", "16"):
        change.write(rows, DETAIL, schemas.DETAIL_REPLACE_KEYS)


def write_summary(run: MetricRun, change: Change) -> None:
    """Each (metric, date) of the run replaces its rows; a rerun changes nothing.

    The table is partitioned by date, as reports read it.  Of the dates of the run, the rows
    of other metrics are read and set beside the new ones; other dates are neither read nor written.
    """
    spark = change.spark
    rolled = scratch_path(spark, "summary")
    summarise(run.rows).write.parquet(rolled)
    new = read_table(spark, rolled, schemas.SUMMARY)
    dates = {f"datestamp={r[0]}" for r in new.select("datestamp").distinct().collect()}  # one, as a rule
    old = change.seen.read(spark, SUMMARY, schemas.SUMMARY, lambda name, _: name in dates)
    whole = replace_keys(old, new, schemas.SUMMARY_REPLACE_KEYS).unionByName(new)
    change.write(whole.hint("rebalance", *schemas.SUMMARY_PARTITIONS), SUMMARY, schemas.SUMMARY_PARTITIONS)
    delete(spark, rolled)


def publish(run: MetricRun, store: Store, as_of: DateLike) -> DataFrame:
    """Publish a run and return its alert message.

    Readers see the state before until the last table is written, then all of the run.  The run is
    read several times: pass one that is on storage, from ``run_metrics``.  Its staging folder, with
    the resources as they were, is removed at the end.
    """
    spark = run.rows.sparkSession
    change = store.begin(spark)
    write_detail(run, change)
    write_summary(run, change)
    detail = change.seen.read(spark, DETAIL, schemas.DETAIL)
    summary = change.seen.read(spark, SUMMARY, schemas.SUMMARY)
    # Most redacted rows are alike: compressed, they take a hundredth of the room.
    change.write(redact(detail), DETAIL_CSV, fmt="csv", compression="gzip", **CSV_OPTIONS)
    change.write(summary_sample(summary, as_of), SUMMARY_CSV, fmt="csv", **CSV_OPTIONS)
    message = alert_message(alert_lines(alert_table(run.rows)))
    found = local_table(spark, [r.asDict() for r in message.collect()], message.schema)  # a row a date
    change.commit()
    if run.staging is not None:
        delete(spark, run.staging)
    return found
