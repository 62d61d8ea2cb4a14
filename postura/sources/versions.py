"""Tables that change as a whole: a reader sees the state before a run or the one after it.

Below a root, a table is folders ``version=<label>/<partitions>/`` of finished files, which are never
changed.  What is current is said by one small pointer file, ``_versions/_<number>``: for each table
and partition, the version that holds it.  A change writes new folders, and commits by giving its
pointer the next number; that is one rename, which fails if another change took the number first.
Notes, small values by name, are committed with the tables they speak of.
Partitions that a change does not touch stay where they are, so history is neither read nor written.

A reader resolves the pointer once and then reads files that no later change touches.  The newest
``KEPT`` pointers stay; on commit, what only older ones name is removed, so a reader has as many
runs' time to finish.  What an unfinished change wrote is never named by a pointer, and goes later.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from postura.sources import paths

POINTERS = "_versions"
KEPT = 3
VERSION = "version"


class Conflict(RuntimeError):
    """Another change was committed since this one began."""


class UnknownVersion(LookupError):
    """A pointer that is asked for is gone, or never was."""


@dataclass(frozen=True)
class Part:
    """A partition of a table: the version that holds it, its format, and what its writer says of it."""

    version: str
    fmt: str = "parquet"
    facts: Mapping[str, Any] = field(default_factory=dict)


Tables = dict[str, dict[str, Part]]


@dataclass(frozen=True)
class Snapshot:
    """The state of all tables at one commit."""

    root: str
    number: int
    tables: Tables
    notes: Mapping[str, Any] = field(default_factory=dict)

    def parts(self, table: str) -> dict[str, Part]:
        return self.tables.get(table, {})

    def path(self, table: str, name: str) -> str:
        folder = f"{self.root}/{table}/{VERSION}={self.parts(table)[name].version}"
        return f"{folder}/{name}" if name else folder

    def read(
        self,
        spark: SparkSession,
        table: str,
        schema: T.StructType | None,
        keep: Callable[[str, Part], bool] | None = None,
        **options: str,
    ) -> DataFrame:
        """The table's rows, or those of the partitions that ``keep`` says true of; only these are listed."""
        by_format: dict[str, list[str]] = {}
        for name, part in self.parts(table).items():
            if keep is None or keep(name, part):
                by_format.setdefault(part.fmt, []).append(self.path(table, name))
        frames = []
        for fmt, places in by_format.items():
            reader = spark.read.format(fmt).options(basePath=f"{self.root}/{table}", **options)
            if fmt == "json":
                reader = reader.option("mode", "FAILFAST")
            rows = (reader.schema(schema) if schema else reader).load(sorted(places))
            frames.append(rows.select(*schema.fieldNames()) if schema else rows.drop(VERSION))
        if not frames:
            return spark.createDataFrame([], schema or T.StructType([]))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


class VersionedRoot:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def _numbers(self) -> list[int]:
        names = paths.names(self.spark, f"{self.root}/{POINTERS}")
        return sorted(int(n[1:]) for n in names if n[1:].isdigit())

    def _pointer(self, number: int) -> str:
        return f"{self.root}/{POINTERS}/_{number:010d}"

    def at(self, number: int) -> Snapshot:
        try:
            text = paths.read_text(self.spark, self._pointer(number))
        except FileNotFoundError as gone:
            raise UnknownVersion(f"version {number} of {self.root}") from gone
        said = json.loads(text)
        tables = {t: {n: Part(**p) for n, p in parts.items()} for t, parts in said["tables"].items()}
        return Snapshot(self.root, number, tables, said["notes"])

    def exists(self) -> bool:
        return bool(self._numbers())

    def current(self) -> Snapshot:
        """The newest state; no tables before the first commit."""
        numbers = self._numbers()
        return self.at(numbers[-1]) if numbers else Snapshot(self.root, 0, {})

    def begin(self) -> Change:
        return Change(self, self.current())

    def _commit(self, snapshot: Snapshot) -> None:
        tables = {t: {n: vars(p) for n, p in parts.items()} for t, parts in snapshot.tables.items()}
        text = json.dumps({"tables": tables, "notes": snapshot.notes})
        draft = f"{self.root}/{POINTERS}/.{uuid.uuid4().hex}"
        paths.write_text(self.spark, draft, text)
        if not paths.rename_new(self.spark, draft, self._pointer(snapshot.number)):
            paths.delete(self.spark, draft)
            raise Conflict(f"version {snapshot.number} of {self.root} was committed by another change")
        self._clean()

    def _clean(self) -> None:
        """Remove what no kept pointer names; what is not yet named may belong to a change under way."""
        numbers = self._numbers()
        kept = [self.at(n) for n in numbers[-KEPT:]]
        named = {(t, n, p.version) for s in kept for t, parts in s.tables.items() for n, p in parts.items()}
        for number in numbers[:-KEPT]:
            old = self.at(number)
            for table, parts in old.tables.items():
                for name, part in parts.items():
                    if (table, name, part.version) not in named:
                        paths.delete(self.spark, old.path(table, name))
            paths.delete(self.spark, self._pointer(number))
        in_use = {(t, v) for t, _, v in named}
        for table in {t for t, _, _ in named}:
            for folder in paths.names(self.spark, f"{self.root}/{table}"):
                version = folder.removeprefix(f"{VERSION}=")
                if version != folder and (table, version) not in in_use and int(version.split("-")[0]) < kept[0].number:
                    paths.delete(self.spark, f"{self.root}/{table}/{folder}")


class Change:
    """New folders, invisible until ``commit``."""

    def __init__(self, home: VersionedRoot, base: Snapshot) -> None:
        self.home, self.spark = home, home.spark
        self.base = base
        self.tables: Tables = {t: dict(parts) for t, parts in base.tables.items()}
        self.notes: dict[str, Any] = dict(base.notes)
        self.number = base.number + 1
        self._written = 0

    @property
    def seen(self) -> Snapshot:
        """The state as it will be after the commit."""
        return Snapshot(self.home.root, self.number, self.tables, self.notes)

    def write(
        self,
        df: DataFrame,
        table: str,
        partition_by: Sequence[str] = (),
        fmt: str = "parquet",
        whole: bool = False,
        facts: Callable[[str], Mapping[str, Any]] | None = None,
        **options: Any,
    ) -> list[str]:
        """Put ``df`` in the place of the partitions it has rows for, or of the ``whole`` table.

        Names the partitions written.  Task output is moved on job commit only, so lost
        executors and reruns leave no partial or doubled rows.
        """
        # A table may be written more than once in a change.
        self._written += 1
        version = f"{self.number:010d}-{self._written}-{uuid.uuid4().hex[:8]}"
        folder = f"{self.home.root}/{table}/{VERSION}={version}"
        writer = df.write.format(fmt).options(**options)
        (writer.partitionBy(*partition_by) if partition_by else writer).save(folder)
        found = paths.partition_names(self.spark, folder, len(partition_by)) if partition_by else [""]
        parts = {} if whole or not partition_by else dict(self.tables.get(table, {}))
        for name in found:
            parts[name] = Part(version, fmt, dict(facts(name)) if facts else {})
        self.tables[table] = parts
        return found

    def drop(self, table: str, names: Iterable[str]) -> None:
        gone = set(names)
        self.tables[table] = {n: p for n, p in self.tables.get(table, {}).items() if n not in gone}

    def commit(self) -> Snapshot:
        self.home._commit(self.seen)
        return self.seen
