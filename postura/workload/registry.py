"""The registered queries: a name, a Spark query, and the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from postura.workload.fixtures import Fixtures
from postura.workload.oracle import statement

Build = Callable[[Fixtures], DataFrame]


@dataclass(frozen=True)
class Entry:
    build: Build
    sql: str | None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Fixtures(spark, sf_dir))


ENTRIES: dict[str, Entry] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register a query under ``name``; ``sql`` may use the oracle's blocks."""

    def register(build: Build) -> Build:
        if name in ENTRIES:
            raise ValueError(f"query {name!r} is registered twice")
        ENTRIES[name] = Entry(build, statement(sql) if sql else None)
        return build

    return register
