"""Entities against their findings: the left join every fan-out metric is made of.

The answer to "LEFT JOIN findings ON key AND condition", projected to entity columns
and a matched flag, has one identical row per matching finding.  So findings need not
travel at all: they are counted per key where they lie (map-side combine), the counts
are joined to the entities, and a row carries the number of rows it stands for.

* A key with a third of all findings costs one counter per map task.  A plain left
  join could not be rescued here: skew splitting never splits the right side of a
  left outer join.
* Several metrics over one pair of tables share a single scan, shuffle and join.
* Attribution, roll-up, scores and alerts work on the compact rows.  Only the detail
  table needs the rows multiplied back, and that is the last thing done to it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postura.functions.predicates import any_of, holds

# Column of a finding's key among its counts.
MATCH_KEY = "_match_key"
# Column of a compact row: how many identical rows it stands for.
COPIES = "_copies"
# Copies one task emits from one compact row before the row is split for others.
COPIES_PER_PIECE = 10_000


def finding_counts(
    findings: DataFrame, finding_key: str, conditions: Mapping[str, Column]
) -> DataFrame:
    """How many findings of each key meet each named condition.

    Findings failing every condition are dropped at the scan, NULL keys match nothing.
    """
    relevant = findings.filter(
        F.col(finding_key).isNotNull() & any_of(list(conditions.values()))
    )
    return (
        relevant.select(
            F.col(finding_key).alias(MATCH_KEY),
            *[holds(condition).alias(name) for name, condition in conditions.items()],
        )
        .groupBy(MATCH_KEY)
        .agg(*[F.count_if(name).alias(name) for name in conditions])
    )


def with_counts(
    entities: DataFrame, counts: DataFrame, entity_key: str, names: Sequence[str]
) -> DataFrame:
    """``entities`` with the counts of their key; 0 where it has none."""
    joined = entities.join(counts, F.col(entity_key) == F.col(MATCH_KEY), "left")
    return joined.drop(MATCH_KEY).withColumns(
        {name: F.coalesce(F.col(name), F.lit(0).cast("bigint")) for name in names}
    )


def match_counts(
    entities: DataFrame,
    findings: DataFrame,
    entity_key: str,
    finding_key: str,
    conditions: Mapping[str, Column],
) -> DataFrame:
    """``entities`` plus, per named condition, how many findings match (0 if none).

    Row count is that of ``entities``.
    """
    counts = finding_counts(findings, finding_key, conditions)
    return with_counts(entities, counts, entity_key, list(conditions))


@dataclass(frozen=True)
class Matching:
    """How metrics ask how many findings of a kind each entity has.

    The parts of ``match_counts``, for those who keep the counts of each key instead of counting
    all findings anew.  ``rows`` turns entities with a count per metric into contract rows, told
    apart by ``metric_id``; each entity's rows depend on that entity and its counts alone.
    """

    tag: str
    finding_key: str
    conditions: Mapping[str, Callable[[DataFrame, Any], Column]]
    entities: Callable[[Any], DataFrame]
    entity_key: str
    rows: Callable[[DataFrame, Sequence[str]], DataFrame]

    def counts(self, findings: DataFrame, as_of: Any, metric_ids: Sequence[str]) -> DataFrame:
        return finding_counts(findings, self.finding_key, {m: self.conditions[m](findings, as_of) for m in metric_ids})

    def measured(self, entities: DataFrame, counts: DataFrame, metric_ids: Sequence[str]) -> DataFrame:
        return self.rows(with_counts(entities, counts, self.entity_key, metric_ids), metric_ids)


def as_fan_out(df: DataFrame, count_col: str) -> DataFrame:
    """Counts to compact rows: ``matched``, and as many copies as there are matches, or one."""
    return df.withColumns(
        {
            "matched": F.col(count_col) > 0,
            COPIES: F.greatest(F.col(count_col), F.lit(1).cast("bigint")),
        }
    ).drop(count_col)


def copies(df: DataFrame) -> Column:
    """How many rows each row of ``df`` stands for; 1 where it does not say."""
    one = F.lit(1).cast("bigint")
    return F.coalesce(F.col(COPIES), one) if COPIES in df.columns else one


def expand(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Multiply compact rows back; plain rows are returned as they are.

    A row with very many copies is first cut into pieces, and the still compact pieces
    are dealt out evenly over ``partitions`` tasks (the session's shuffle partitions if
    not given), so no hot key leaves one task to emit a large share of the output.  The
    number is fixed here because AQE would size partitions by the compact rows and merge
    what is about to grow.
    """
    if COPIES not in df.columns:
        return df
    if partitions is None:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _copied(_pieces(df).repartition(partitions))


def _pieces(df: DataFrame) -> DataFrame:
    """Compact rows of ``COPIES_PER_PIECE`` copies at most."""
    size, one = F.lit(COPIES_PER_PIECE).cast("bigint"), F.lit(1).cast("bigint")
    n = copies(df)
    pieces = df.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((n - one) / size))))
    return pieces.withColumn(COPIES, F.least(size, n - F.col("_piece") * size)).drop("_piece")


def _copied(pieces: DataFrame) -> DataFrame:
    one = F.lit(1).cast("bigint")
    return pieces.withColumn("_copy", F.explode(F.sequence(one, F.col(COPIES)))).drop("_copy", COPIES)


def expand_dealt(df: DataFrame, key: str, shares: Mapping[str, int]) -> DataFrame:
    """Multiply compact rows back, each key's rows spread evenly over tasks of its own.

    ``shares`` says over how many, as known counts suggest.  Pieces are dealt to a key's tasks in
    turn and sent by number, so no sample is taken and no hash puts two shares into one task.  Rows
    of keys that are not named go together into one task more.
    """
    first, tasks = [], 0
    for value, n in sorted(shares.items()):
        first += [F.lit(value), F.struct(F.lit(tasks).alias("at"), F.lit(n).alias("n"))]
        tasks += n
    df = df if COPIES in df.columns else df.withColumn(COPIES, F.lit(1).cast("bigint"))
    if not first:
        return _copied(_pieces(df).coalesce(1))
    own = F.create_map(*first)[F.col(key)]
    task = F.coalesce(own["at"] + F.pmod(F.monotonically_increasing_id(), own["n"]), F.lit(tasks))
    pieces = _pieces(df).withColumn("_task", task.cast("int"))
    return _copied(pieces.repartitionById(tasks + 1, F.col("_task")).drop("_task"))


def entity_vs_findings(
    entities: DataFrame,
    findings: DataFrame,
    entity_key: str,
    finding_key: str,
    condition: Column,
    per_entity: bool = False,
) -> DataFrame:
    """Compact entity rows with ``matched``: a copy per matching finding, one if none matches.

    ``expand`` gives the rows of the join.  ``per_entity`` gives every entity once.
    """
    counted = match_counts(entities, findings, entity_key, finding_key, {"_matches": condition})
    rows = as_fan_out(counted, "_matches")
    return rows.drop(COPIES) if per_entity else rows
