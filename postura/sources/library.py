"""Metric definitions: loading, selecting and listing them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postura import schemas
from postura.functions.dates import as_column
from postura.operators.matching import Matching
from postura.operators.sizing import local_table
from postura.sources.paths import has_files

# How definition files are named.
DEFINITION_GLOB = "metric_*.yml"


@dataclass(frozen=True)
class MetricDefinition:
    """One metric: its metadata and either a SQL text or a DataFrame function.

    ``family`` names metrics that can be measured together in one pass over
    their tables; see ``postura.plans.runner``.  ``matching`` and ``entity_tag`` say
    how a change of a raw table changes the result; see ``postura.streaming.differences``.
    """

    metric_id: str | None = None
    title: str | None = None
    category: str | None = None
    slo: float | None = None
    slo_min: float | None = None
    weight: float | None = None
    description: str = ""
    query: str | None = None
    build: Callable[..., DataFrame] | None = None
    family: str | None = None
    matching: Matching | None = None
    entity_tag: str | None = None
    source: str | None = None

    def missing_metadata(self) -> list[str]:
        return [name for name in schemas.METADATA if getattr(self, name) is None]

    @property
    def name(self) -> str:
        return self.metric_id or self.source or "unnamed"

    @classmethod
    def from_mapping(cls, values: Mapping[str, Any], source: str | None = None):
        known = {k: values[k] for k in (*schemas.METADATA, "description", "query") if k in values}
        return cls(**known, source=source)


def _definition_texts(folder: str | Path, spark: SparkSession | None) -> list[tuple[str, str]]:
    """Name and text of each definition file, in name order."""
    if spark is None:
        return [(f.name, f.read_text(encoding="utf-8")) for f in sorted(Path(folder).glob(DEFINITION_GLOB))]
    place = str(folder).rstrip("/")
    if not has_files(spark, f"{place}/{DEFINITION_GLOB}"):
        return []
    files = spark.read.text(f"{place}/{DEFINITION_GLOB}", wholetext=True)
    return sorted(tuple(r) for r in files.select("_metadata.file_name", "value").collect())  # a row a metric


def load_metrics(
    folder: str | Path, only: str | None = None, spark: SparkSession | None = None
) -> list[MetricDefinition]:
    """Definitions of a folder in name order: all, or the one with that file name or id.

    With ``spark`` the folder is any URI the cluster reads; without it is one of the driver's own.
    """
    import yaml

    found = []
    for name, text in _definition_texts(folder, spark):
        stem = name.rpartition(".")[0]
        definition = MetricDefinition.from_mapping(yaml.safe_load(text), source=stem)
        if only in (None, stem, definition.metric_id):
            found.append(definition)
    return found


def library_frame(spark: SparkSession, definitions: Iterable[MetricDefinition]) -> DataFrame:
    """The definitions' metadata as a table of known size."""
    rows = [{name: getattr(d, name) for name in schemas.METADATA} for d in definitions]
    return local_table(spark, rows, schemas.LIBRARY)


def slo_range(slo: str = "slo", slo_min: str = "slo_min") -> Column:
    low, high = as_column(slo_min) * 100, as_column(slo) * 100
    return F.format_string("%.2f%% - %.2f%%", low, high)


def library_listing(library: DataFrame) -> DataFrame:
    """Metrics by category with their target range."""
    return library.select("category", "metric_id", "title", slo_range().alias("slo_range"), "weight")
