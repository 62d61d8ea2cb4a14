"""Delete-and-insert of the two maintained tables, and union of metric results.

The functions here state the new content of a table as a DataFrame.  On storage the
same change is ``sources.tables.replace_partitions``, which leaves history unread.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postura import schemas
from postura.operators.matching import expand
from postura.operators.rollups import summarise
from postura.operators.sizing import local_table

# Keys of a run that are looked up before its rows are replaced.
FEW_KEYS = 10_000


def replace_keys(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``old`` whose keys do not occur in ``new``.

    Few keys, as of metrics, would gather all of ``old`` in as many tasks if it were dealt by
    them: ``FEW_KEYS`` at most are looked up at once and become a table of known size, so ``old``
    stays where it is.  Of more keys Spark decides by their size how the anti join runs.  Give
    ``new`` as small and as finished as it is at hand (a roll-up, a stored run), since it is
    computed for its keys and again for its rows.
    """
    found = new.select(*keys).distinct()
    few = found.limit(FEW_KEYS + 1).collect()
    if len(few) <= FEW_KEYS:
        found = local_table(old.sparkSession, [r.asDict() for r in few], found.schema)
    return old.join(found, list(keys), "left_anti")


def upsert_summary(old: DataFrame, run_detail: DataFrame) -> DataFrame:
    """The summary after a run: its (metric, date) pairs replaced, all others kept."""
    rolled = summarise(run_detail)
    return replace_keys(old, rolled, schemas.SUMMARY_REPLACE_KEYS).unionByName(rolled)


def upsert_detail(old: DataFrame, run_detail: DataFrame) -> DataFrame:
    """The detail after a run: only the newest run of each metric."""
    kept = replace_keys(old, run_detail, schemas.DETAIL_REPLACE_KEYS)
    return kept.unionByName(expand(run_detail), allowMissingColumns=True)


def union_metrics(results: Sequence[DataFrame]) -> DataFrame:
    """All rows of all results, matched by column name; absent columns become NULL."""
    if not results:
        raise ValueError("no metric result to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), results)


def redact(df: DataFrame, columns: Sequence[str] = ("detail", "resource")) -> DataFrame:
    """The rows as they may be published."""
    return df.withColumns({c: F.lit("redacted") for c in columns})
