"""Keeping the summary up to date by what has changed, instead of measuring all that has landed.

The manifest of a landed table names its parts, so two versions of it differ by the parts that came
and those that went; only these are read.  A metric takes the difference in one of three ways:

* its findings changed (``matching``): findings that came are counted per key, those that went are
  counted off, and the counts of all keys are a maintained table, dealt into buckets of keys.  Only
  keys whose count changed matter: their entities' rows with the old counts are taken out of the
  summary, those with the new ones put in;
* its entities changed (``entity_tag``): each entity's rows depend on that entity alone, so the rows
  of entities that went are taken out, of those that came put in;
* neither is known: the metric is measured anew.

The summary, the counts and the version of the landed table that they speak of are committed by one
pointer.  A batch that is replayed after a failure, or a delivery that changed nothing, finds that
version and does nothing; a crash between landing and commit loses nothing.

Counts belong to a run date, as conditions look at ages.  Another date, other metrics, or a change of
another landed table starts anew from all that has landed.  Sums of compliance are taken out as
they were put in, which is exact for whole numbers; a group without a counted row left is gone.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postura import schemas
from postura.operators.assets import enrich_assets
from postura.operators.matching import COPIES, MATCH_KEY, Matching
from postura.operators.rollups import summarise
from postura.plans.publish import SUMMARY, Store, write_summary
from postura.plans.runner import contract_rows, plan_metrics, stamp_family
from postura.session import scratch_path
from postura.sources.landing import ROWS, landed_root, read_landed
from postura.sources.library import MetricDefinition
from postura.sources.paths import delete, names
from postura.sources.raw import RawTables
from postura.sources.versions import Change, Part, Snapshot, UnknownVersion

# Parts that the counts of all keys are dealt into.
BUCKETS, BUCKET = 64, "_bucket"


def _counts_schema(metric_ids: Sequence[str]) -> T.StructType:
    counts = [T.StructField(m, T.LongType()) for m in metric_ids]
    return T.StructType([T.StructField(MATCH_KEY, T.StringType()), *counts, T.StructField(BUCKET, T.IntegerType())])


def _bucket(key: str = MATCH_KEY):
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int").alias(BUCKET)


def changed_parts(before: Snapshot, after: Snapshot) -> tuple[set[str], set[str]]:
    """Names of the parts that came, in ``after``, and of those that went, in ``before``."""

    def version(s: Snapshot, name: str) -> str | None:
        part = s.parts(ROWS).get(name)
        return part.version if part else None

    came = {n for n in after.parts(ROWS) if version(before, n) != version(after, n)}
    gone = {n for n in before.parts(ROWS) if version(before, n) != version(after, n)}
    return came, gone


def _only(names_: set[str]) -> Callable[[str, Part], bool]:
    return lambda name, _: name in names_


class Maintained:
    """The summary of metrics over one landed table, and what it takes to keep it."""

    def __init__(
        self,
        spark: SparkSession,
        tag: str,
        definitions: Sequence[MetricDefinition],
        tables: RawTables,
        as_of: dt.date,
        root: str,
        store: Store,
        assets: DataFrame | None = None,
    ) -> None:
        self.spark, self.tag, self.tables, self.as_of = spark, tag, tables, as_of
        self.root, self.store, self.assets = root, store, assets
        self.definitions = list(definitions)
        whole = [d for d in self.definitions if not d.missing_metadata()]
        self.counted = [d for d in whole if d.matching is not None and d.matching.tag == tag]
        self.by_entity = [d for d in whole if d not in self.counted and d.entity_tag == tag]
        self.anew = [d for d in self.definitions if d not in self.counted and d not in self.by_entity]
        self.note = f"stream of {tag}"

    # --- what is known -----------------------------------------------------------------

    def _groups(self) -> list[tuple[Matching, list[MetricDefinition]]]:
        """Metrics that share their findings and entities, counted together."""
        groups: list[tuple[Matching, list[MetricDefinition]]] = []
        for d in self.counted:
            for matching, members in groups:
                if matching is d.matching and d.metric_id not in {m.metric_id for m in members}:
                    members.append(d)
                    break
            else:
                groups.append((d.matching, [d]))
        return groups

    def _basis(self) -> dict[str, Any]:
        """What the maintained state depends on, besides the landed table itself."""
        others = {}
        for place in self.tables.roots:
            for name in names(self.spark, place):
                if name != self.tag and (number := landed_root(self.spark, place, name).current().number):
                    others[f"{place}/{name}"] = number
        return {"as_of": str(self.as_of), "metrics": [d.name for d in self.definitions], "others": others}

    def _table(self, k: int) -> str:
        return f"counts/{self.tag}-{k}"

    def landed(self, snapshot: Snapshot, parts: set[str] | None = None) -> DataFrame:
        keep = None if parts is None else _only(parts)
        return read_landed(self.spark, snapshot, schemas.RAW.get(self.tag), keep)

    # --- the update --------------------------------------------------------------------

    def update(self) -> None:
        """Bring the summary to the state of the landed table."""
        home = landed_root(self.spark, self.root, self.tag)
        landed = home.current()
        if not landed.number:
            return
        change = self.store.begin(self.spark)
        basis = self._basis()
        known = change.notes.get(self.note)
        scratch = scratch_path(self.spark, "differences")
        try:
            before = home.at(known["landed"]) if known and known["basis"] == basis else None
        except UnknownVersion:
            before = None
        if before is None:
            self._anew(change, landed, self.definitions)
            for k, (matching, members) in enumerate(self._groups()):
                ids = [d.metric_id for d in members]
                counts = matching.counts(self.landed(landed), self.as_of, ids).select("*", _bucket())
                change.write(counts.hint("rebalance", BUCKET), self._table(k), [BUCKET], whole=True)
        elif before.number == landed.number:
            return
        else:
            self._apply(change, before, landed, scratch)
            if self.anew:
                self._anew(change, landed, self.anew)
        change.notes[self.note] = {"basis": basis, "landed": landed.number}
        change.commit()
        delete(self.spark, scratch)

    def _anew(self, change: Change, landed: Snapshot, definitions: Sequence[MetricDefinition]) -> None:
        current = self.tables.with_table(self.tag, self.landed(landed))
        write_summary(plan_metrics(definitions, current, self.as_of, self.assets), change)

    def _apply(self, change: Change, before: Snapshot, landed: Snapshot, scratch: str) -> None:
        came, gone = changed_parts(before, landed)
        changes = []
        for k, (matching, members) in enumerate(self._groups()):
            changes += self._by_counts(change, before, landed, came, gone, k, matching, members, f"{scratch}/{k}")
        if self.by_entity:
            for sign, parts, snapshot in ((-1, gone, before), (1, came, landed)):
                if parts:
                    now = self.tables.with_table(self.tag, self.landed(snapshot, parts))
                    rows = plan_metrics(self.by_entity, now, self.as_of, self.assets).rows
                    changes.append(_signed(summarise(rows), sign))
        if changes:
            self._add(change, reduce(DataFrame.unionByName, changes))

    def _by_counts(
        self, change: Change, before: Snapshot, landed: Snapshot, came: set[str], gone: set[str],
        k: int, matching: Matching, members: list[MetricDefinition], scratch: str,
    ) -> list[DataFrame]:
        ids = [d.metric_id for d in members]
        parts = [
            _signed_counts(matching.counts(self.landed(s, p), self.as_of, ids), ids, sign)
            for s, p, sign in ((landed, came, 1), (before, gone, -1))
            if p
        ]
        some = reduce(lambda a, b: a | b, [F.col(m) != 0 for m in ids])
        difference = reduce(DataFrame.unionByName, parts).groupBy(MATCH_KEY).agg(*[F.sum(m).alias(m) for m in ids])
        difference.filter(some).select("*", _bucket()).write.parquet(scratch)
        difference = self.spark.read.schema(_counts_schema(ids)).parquet(scratch)
        touched = {f"{BUCKET}={r[0]}" for r in difference.select(BUCKET).distinct().collect()}
        if not touched:
            return []
        schema, table = _counts_schema(ids), self._table(k)
        old = change.base.read(self.spark, table, schema, _only(touched))
        both = old.unionByName(difference).groupBy(MATCH_KEY, BUCKET).agg(*[F.sum(m).alias(m) for m in ids])
        written = change.write(both.filter(some).hint("rebalance", BUCKET), table, [BUCKET])
        change.drop(table, touched - set(written))
        new = change.seen.read(self.spark, table, schema, _only(touched))
        # Entities of the keys whose counts changed, with what they had and what they have.
        keys = difference.select(F.col(MATCH_KEY).alias("_changed"))
        entities = matching.entities(self.tables)
        entities = entities.join(keys, F.col(matching.entity_key) == F.col("_changed"), "left_semi")
        return [
            _signed(self._summary(matching.measured(entities, counts.drop(BUCKET), ids), members), sign)
            for counts, sign in ((old, -1), (new, 1))
        ]

    def _summary(self, rows: DataFrame, members: list[MetricDefinition]) -> DataFrame:
        stamped = stamp_family(contract_rows(rows, "metric_id"), members, self.as_of)
        owned = enrich_assets(stamped, self.assets)
        return summarise(owned.select(*schemas.DETAIL.fieldNames(), COPIES))

    def _add(self, change: Change, differences: DataFrame) -> None:
        """The summary of the run date with the differences added."""
        date = f"datestamp={self.as_of.isoformat()}"
        old = change.seen.read(self.spark, SUMMARY, schemas.SUMMARY, _only({date}))
        added = old.unionByName(differences).groupBy(*schemas.SUMMARY_KEYS).agg(
            F.sum("totalok").alias("totalok"), F.sum("total").alias("total")
        )
        ours = F.col("metric_id").isin([d.metric_id for d in (*self.counted, *self.by_entity)])
        left = added.filter(~ours | (F.col("total") != 0))
        if not change.write(left.select(*schemas.SUMMARY.fieldNames()).hint("rebalance", *schemas.SUMMARY_PARTITIONS), SUMMARY, schemas.SUMMARY_PARTITIONS):
            change.drop(SUMMARY, [date])


def _signed(summary: DataFrame, sign: int) -> DataFrame:
    return summary.withColumns({c: F.col(c) * F.lit(sign) for c in ("totalok", "total")}).select(*schemas.SUMMARY.fieldNames())


def _signed_counts(counts: DataFrame, ids: Sequence[str], sign: int) -> DataFrame:
    return counts.select(MATCH_KEY, *[(F.col(m) * F.lit(sign)).alias(m) for m in ids])
