"""Running metrics: definitions in, rows and a report out.

A metric that cannot be measured (a table, column or metadata key is missing, its query
fails, it yields no row) is left out and reported; the others go on.
"""

from __future__ import annotations

import datetime as dt
import math
import re
import uuid
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postura import schemas
from postura.functions.dates import as_date
from postura.operators.assets import enrich_assets
from postura.operators.maintenance import union_metrics
from postura.operators.matching import COPIES, copies, expand, expand_dealt
from postura.operators.outer_counts import count_right_side
from postura.plans.catalogue import FAMILIES
from postura.sources.library import MetricDefinition, library_frame
from postura.sources.raw import MissingTable, RawTables
from postura.sources.tables import empty_table, read_or_empty, replace_partitions

_REF = re.compile(r"""\{\{\s*ref\(\s*['"]([^'"]+)['"]\s*\)\s*\}\}""")

# Metrics written at the same time; each is a distributed job of its own.
CONCURRENT_METRICS = 4
# The partition of a measuring job in the staging folder.
JOB = "job"
# Detail rows a task writes.
ROWS_PER_TASK = 5_000_000
# The detail schema, and how many rows a row stands for.
COMPACT = T.StructType([*schemas.DETAIL.fields, T.StructField(COPIES, T.LongType())])


class ContractError(ValueError):
    """A metric's result lacks a required column."""


class MetadataError(ValueError):
    """A metric's definition lacks a required key."""


@dataclass(frozen=True)
class Outcome:
    metric_id: str
    status: str  # planned, measured, empty or failed
    reason: str = ""
    rows: int | None = None


@dataclass
class MetricRun:
    """``rows`` are compact: attribution, sums and alerts can use them as they are."""

    rows: DataFrame
    report: list[Outcome] = field(default_factory=list)
    staging: str | None = None

    @property
    def detail(self) -> DataFrame:
        """The detail rows themselves, over a number of tasks that fits their number."""
        known = [o.rows for o in self.report if o.rows is not None]
        partitions = math.ceil(sum(known) / ROWS_PER_TASK) or 1 if known else None
        return expand(self.rows, partitions)

    @property
    def dealt_detail(self) -> DataFrame:
        """The same, dealt by metric: a task and a file for every ``ROWS_PER_TASK`` rows of each."""
        counted: dict[str, int] = {}
        for o in self.report:
            if o.rows:
                counted[o.metric_id] = counted.get(o.metric_id, 0) + o.rows
        if not counted:
            return self.detail
        return expand_dealt(self.rows, "metric_id", {m: math.ceil(n / ROWS_PER_TASK) for m, n in counted.items()})

    def failures(self) -> list[Outcome]:
        return [o for o in self.report if o.status in ("failed", "empty")]


def metric_sql(query: str, tables: RawTables, as_of: dt.date) -> DataFrame:
    """Run a Spark SQL text in which ``{{ ref('tag') }}`` names a raw table and ``:as_of`` today.

    A left join of entities and findings comes back as compact rows; ``expand`` multiplies them.
    """
    tags = list(dict.fromkeys(_REF.findall(query)))
    frames, missing = {}, []
    for tag in tags:
        try:
            frames[tag] = tables.ref(tag)
        except MissingTable:
            missing.append(tag)
    if missing:
        raise MissingTable(f"no data for table(s) {', '.join(missing)}")
    spark = tables.spark
    views = {tag: f"raw_{uuid.uuid4().hex}" for tag in tags}
    try:
        for tag, view in views.items():
            frames[tag].createOrReplaceTempView(view)
        text = _REF.sub(lambda m: views[m.group(1)], query)
        return count_right_side(spark.sql(text, args={"as_of": as_of}))
    finally:
        for view in views.values():
            spark.catalog.dropTempView(view)


def check_contract(df: DataFrame) -> DataFrame:
    missing = [c for c in schemas.CONTRACT if c not in df.columns]
    if missing:
        raise ContractError(f"result lacks column(s) {', '.join(missing)}")
    return df


def check_metadata(definition: MetricDefinition) -> None:
    missing = definition.missing_metadata()
    if missing:
        raise MetadataError(f"definition lacks {', '.join(missing)}")


def stamp_metadata(df: DataFrame, definition: MetricDefinition, as_of) -> DataFrame:
    """Add the definition's metadata and the run date to one metric's rows."""
    check_metadata(definition)
    values = {
        name: F.lit(getattr(definition, name)).cast(schemas.LIBRARY[name].dataType)
        for name in schemas.METADATA
    }
    return df.withColumns({**values, "datestamp": as_date(as_of)})


def stamp_family(df: DataFrame, definitions: Sequence[MetricDefinition], as_of) -> DataFrame:
    """The same for rows of several metrics in one frame, told apart by ``metric_id``."""
    library = library_frame(df.sparkSession, definitions)
    return df.join(library, "metric_id").withColumn("datestamp", as_date(as_of))


def contract_rows(df: DataFrame, *extra: str) -> DataFrame:
    """A metric's result in the contract's types, with how many rows each row stands for."""
    check_contract(df)
    types = {c: schemas.DETAIL[c].dataType for c in schemas.CONTRACT}
    columns = [F.col(c).cast(t).alias(c) for c, t in types.items()]
    return df.select(*extra, *columns, copies(df).alias(COPIES))


def measure(definition: MetricDefinition, tables: RawTables, as_of: dt.date) -> DataFrame:
    """The stamped rows of one metric."""
    check_metadata(definition)
    if definition.build is not None:
        result = definition.build(tables, as_of)
    elif definition.query:
        result = metric_sql(definition.query, tables, as_of)
    else:
        raise MetadataError("definition lacks query")
    return stamp_metadata(contract_rows(result), definition, as_of)


def measure_family(
    definitions: Sequence[MetricDefinition], tables: RawTables, as_of: dt.date
) -> DataFrame:
    """The stamped rows of metrics sharing their tables, measured together."""
    build = FAMILIES[definitions[0].family]
    result = build(tables, as_of, [d.metric_id for d in definitions])
    return stamp_family(contract_rows(result, "metric_id"), definitions, as_of)


def _failed(definition: MetricDefinition, error: Exception) -> Outcome:
    """A metric's own code or data may raise anything; it only costs that metric."""
    reason = (str(error).splitlines() or [""])[0]
    return Outcome(definition.name, "failed", f"{type(error).__name__}: {reason}")


def _groups(definitions: Iterable[MetricDefinition]) -> list[list[MetricDefinition]]:
    """Definitions to measure together: by family where complete, else one by one.

    A family tells its metrics apart by id, so a second one with an id is measured alone.
    """
    groups: dict[str, list[MetricDefinition]] = {}
    for i, d in enumerate(definitions):
        together = d.family in FAMILIES and not d.missing_metadata()
        taken = {x.metric_id for x in groups.get(d.family, ())} if together else ()
        groups.setdefault(d.family if together and d.metric_id not in taken else f"#{i}", []).append(d)
    return list(groups.values())


def _plan(group, tables, as_of, report) -> list[tuple[list[MetricDefinition], DataFrame]]:
    if len(group) > 1:
        try:
            return [(group, measure_family(group, tables, as_of))]
        except Exception:  # noqa: BLE001
            # Find out which of them can be measured after all.
            return [p for d in group for p in _plan([d], tables, as_of, report)]
    (definition,) = group
    try:
        return [(group, measure(definition, tables, as_of))]
    except Exception as e:  # noqa: BLE001
        report.append(_failed(definition, e))
        return []


def plan_metrics(
    definitions: Iterable[MetricDefinition],
    tables: RawTables,
    as_of: dt.date,
    assets: DataFrame | None = None,
) -> MetricRun:
    """The rows of all metrics as one lazy frame; no job runs.

    Finds what can be found while planning.  Metrics without rows add none.
    """
    report: list[Outcome] = []
    planned = [p for g in _groups(definitions) for p in _plan(g, tables, as_of, report)]
    report += [Outcome(d.name, "planned") for group, _ in planned for d in group]
    if not planned:
        return MetricRun(empty_table(tables.spark, COMPACT), report)
    rows = enrich_assets(union_metrics([df for _, df in planned]), assets)
    return MetricRun(rows.select(*COMPACT.fieldNames()), report)


def run_metrics(
    definitions: Iterable[MetricDefinition],
    tables: RawTables,
    as_of: dt.date,
    staging: str,
    assets: DataFrame | None = None,
) -> MetricRun:
    """Measure and write the rows to ``staging``, each metric in a job of its own.

    So a metric failing at run time takes no other with it, and the run is computed once
    however often it is read afterwards.  Each job has a partition of its own, so definitions
    that share an id add up, as they do in a report.  Owners are looked up once, for the rows
    of all metrics together.  ``staging`` is a path of this run alone.
    """
    report: list[Outcome] = []
    planned = [p for g in _groups(definitions) for p in _plan(g, tables, as_of, report)]
    bare = [c for c in COMPACT.fieldNames() if c not in schemas.DIMENSIONS]
    measured = f"{staging}/measured"

    def write(item) -> list[tuple[str, Outcome]]:
        key, (group, df) = item
        try:
            replace_partitions(df.select(*bare).withColumn(JOB, F.lit(key)), measured, [JOB])
        except Exception as e:  # noqa: BLE001
            if len(group) == 1:
                return [(key, _failed(group[0], e))]
            found: list[tuple[str, Outcome]] = []
            for k, d in enumerate(group):
                singles: list[Outcome] = []
                for single in _plan([d], tables, as_of, singles):
                    found += write((f"{key}-{k}", single))
                found += [(key, o) for o in singles]
            return found
        return [(key, Outcome(d.name, "measured")) for d in group]

    with ThreadPoolExecutor(CONCURRENT_METRICS) as pool:
        jobs = [(f"job-{k}", p) for k, p in enumerate(planned)]
        written = [o for outcomes in pool.map(write, jobs) for o in outcomes]
    staged = T.StructType([*(COMPACT[c] for c in bare), T.StructField(JOB, T.StringType())])
    rows = read_or_empty(tables.spark, measured, staged)
    counts = {(j, m): n for j, m, n in rows.groupBy(JOB, "metric_id").agg(F.sum(COPIES)).collect()}
    for job, o in written:
        n = counts.get((job, o.metric_id), 0)
        found = replace(o, status=o.status if n else "empty", rows=n)
        report.append(o if o.status == "failed" else found)
    enrich_assets(rows, assets).select(*COMPACT.fieldNames()).write.parquet(f"{staging}/rows")
    return MetricRun(read_or_empty(tables.spark, f"{staging}/rows", COMPACT), report, staging)
