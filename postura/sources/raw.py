"""Raw tables: one folder per tag, holding what the tenancies delivered."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from copy import copy
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postura import schemas
from postura.sources.landing import (
    ROWS,
    ForeignFiles,
    check_nothing_beside,
    copy_parts,
    land_parts,
    land_snapshots,
    landed_root,
    read_landed,
    table_path,
)
from postura.sources.lineage import template_columns
from postura.sources.paths import data_suffixes, has_files, partition_names
from postura.sources.versions import Snapshot

# What deliveries and ``land`` write unless told otherwise.
DEFAULT_FORMAT = "json"
FORMATS = ("json", "parquet")


class MissingTable(LookupError):
    """A referenced raw table has no data file."""


class ForeignFormat(ValueError):
    """A raw table's files are of several formats, or of one that cannot be read."""


def table_format(spark: SparkSession, path: str) -> str:
    """The format of a raw table, as its files' names say."""
    found = data_suffixes(spark, path)
    if len(found) != 1 or not found <= set(FORMATS):
        raise ForeignFormat(f"expected {' or '.join(FORMATS)} at {path}, found {sorted(found)}")
    return found.pop()


def ref(
    spark: SparkSession,
    root: str,
    tag: str,
    schema: T.StructType | None = None,
    fmt: str | None = None,
) -> DataFrame:
    """All tenancies of one raw table.

    The folder may hold delivered files (``{tag}/{tenancy}.json``, each one JSON
    array) or landed ones, of which the newest version is read, as it stands now.  A known
    tag is read with its declared schema, which saves the inference pass and lets nested
    fields be pruned; an unknown tag is read as it comes.  The format is that of the files
    found; a record that is not of it fails the read.
    """
    path = table_path(root, tag)
    if not has_files(spark, path):
        raise MissingTable(f"no data for table {tag!r} at {path}")
    schema = schema or schemas.RAW.get(tag)
    landed = landed_root(spark, root, tag).current()
    if landed.number:
        return _ref_landed(spark, path, landed, schema, fmt)
    found = table_format(spark, path)
    if fmt not in (None, found):
        raise ForeignFormat(f"expected {fmt} at {path}, found {found}")
    reader = spark.read.format(found)
    if found == "json":
        reader = reader.option("mode", "FAILFAST")
    return (reader.schema(schema) if schema else reader).load(path)


def _ref_landed(
    spark: SparkSession, path: str, landed: Snapshot, schema: T.StructType | None, fmt: str | None
) -> DataFrame:
    try:
        check_nothing_beside(spark, path)
    except ForeignFiles as e:
        raise ForeignFormat(str(e)) from e
    found = {p.fmt for p in landed.parts(ROWS).values()}
    if fmt is not None and found - {fmt}:
        raise ForeignFormat(f"expected {fmt} at {path}, found {sorted(found)}")
    return read_landed(spark, landed, schema)


def require_tables(spark: SparkSession, root: str, tags: Sequence[str]) -> None:
    missing = [t for t in tags if not has_files(spark, table_path(root, t))]
    if missing:
        raise MissingTable(f"no data for table(s) {', '.join(missing)} under {root}")


class RawTables:
    """What a metric may ``ref``: tables under a root, or ready DataFrames by tag.

    A table that is missing under ``root`` is looked for under ``backup``, where the last
    good delivery is kept.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str | None = None,
        tables: Mapping[str, DataFrame] | None = None,
        table_schemas: Mapping[str, T.StructType] | None = None,
        fmt: str | None = None,
        backup: str | None = None,
    ) -> None:
        self.spark = spark
        self.roots = [r for r in (root, backup) if r]
        self.fmt = fmt
        self._schemas = dict(table_schemas or {})
        self._tables = dict(tables or {})

    def ref(self, tag: str) -> DataFrame:
        if tag not in self._tables:
            self._tables[tag] = self._find(tag)
        return self._tables[tag]

    def with_table(self, tag: str, df: DataFrame) -> RawTables:
        """The same tables with ``df`` in the place of one of them."""
        changed = copy(self)
        changed._tables = {**self._tables, tag: df}
        return changed

    def _find(self, tag: str) -> DataFrame:
        for root in self.roots:
            if has_files(self.spark, table_path(root, tag)):
                return ref(self.spark, root, tag, self._schemas.get(tag), self.fmt)
        raise MissingTable(f"no data for table {tag!r} under {' or '.join(self.roots) or 'any root'}")


def land(
    df: DataFrame, root: str, tag: str, fmt: str = DEFAULT_FORMAT, backup: str | None = None
) -> None:
    """Replace the snapshot of each tenancy in ``df``; leave the other tenancies alone.

    Needs the lineage columns.  Readers see the tenancies of ``df`` change together.  A tenancy
    without rows is not touched, so an empty delivery keeps the earlier snapshot without a count
    first.  The rebalance evens out file sizes when one tenancy holds most of the rows.

    ``backup`` is a second root that gets the same, for when the first is lost.  It is filled from
    the files landed in the first, so ``df`` is computed once and both roots are equal even where
    its source changes meanwhile.
    """
    spark = df.sparkSession
    parts = land_snapshots(df, root, tag, fmt, lambda: ref(spark, root, tag))
    if backup is not None:
        copy_parts(spark, root, backup, tag, fmt, df.schema, parts, lambda: ref(spark, backup, tag))


def land_arriving(
    df: DataFrame,
    root: str,
    tag: str,
    fmt: str = "parquet",
    file: str | None = None,
    backup: str | None = None,
) -> Snapshot:
    """Add uploads that may come in several parts, late or repeatedly; the landed table after that."""
    spark = df.sparkSession
    before = set(landed_root(spark, root, tag).current().parts(ROWS))
    landed = land_parts(df, root, tag, fmt, lambda: ref(spark, root, tag), file)
    if backup is not None:
        schema = T.StructType([f for f in df.schema if f.name != file])
        new = [n for n in landed.parts(ROWS) if n not in before]
        copy_parts(spark, root, backup, tag, fmt, schema, new, lambda: ref(spark, backup, tag))
    return landed


HISTORY_TEMPLATE = "%TAG/%TENANCY/%YYYY/%MM/%DD/%UUID"


def append_history(
    df: DataFrame, root: str, tag: str, fmt: str = "parquet", template: str = HISTORY_TEMPLATE
) -> None:
    """Keep a dated copy, a partition for each variable of ``template`` in its order.

    Part names are unique, so ``%UUID`` needs no folder of its own.
    """
    layout = template_columns(template, tag)
    (
        df.withColumns(layout)
        .hint("rebalance", *layout)
        .write.mode("append")
        .format(fmt)
        .partitionBy(*layout)
        .save(root)
    )


def latest_snapshot(
    df: DataFrame,
    keys: Sequence[str] = ("tag", "tenancy"),
    uploaded_at: str = "_upload_timestamp",
) -> DataFrame:
    """All rows of the newest upload of each key.

    The newest time per key is a map-side combined aggregate; only that small
    result meets the rows again.  A window over the key would sort every row and
    put a whole hot key into one task.  A missing key is a key like any other.
    """
    newest = df.groupBy(*keys).agg(F.max(uploaded_at).alias(uploaded_at)).alias("newest")
    same = [F.col(f"rows.{c}").eqNullSafe(F.col(f"newest.{c}")) for c in (*keys, uploaded_at)]
    return df.alias("rows").join(newest, reduce(and_, same), "left_semi")


def newest_uploads(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    keys: Sequence[str] = ("tag", "tenancy"),
    uploaded_at: str = "_upload_timestamp",
) -> DataFrame:
    """The same for a history that is partitioned by ``keys`` and then by upload time.

    The newest partition of each key is known from the folders' names, and no other is read:
    no row is compared, and none is moved.  Times must sort as text, as ISO dates do.
    """
    newest: dict[str, str] = {}
    for name in partition_names(spark, path, len(keys) + 1):
        key, _, upload = name.rpartition("/")
        newest[key] = max(newest.get(key, ""), upload)
    places = [f"{path}/{key}/{upload}" for key, upload in sorted(newest.items())]
    if not places:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", path).parquet(*places)
    return rows.select(*schema.fieldNames())
