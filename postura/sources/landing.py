"""Landed raw records: what each tenancy delivered last, under a manifest.

The records of a tag lie below ``{root}/{tag}/rows`` by tenancy and part, as a versioned table whose
pointer is a manifest too: it says of each part which upload it belongs to.  So the newest upload, or
what changed since a version, is known without reading a row, and a reader never sees half a landing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postura.operators.sizing import local_table
from postura.sources.paths import delete, has_files, names
from postura.sources.versions import POINTERS, Change, Part, Snapshot, VersionedRoot

ROWS, PART = "rows", "_part"
LAYOUT = ("_tenancy", PART)
# The part of a snapshot that is landed as a whole.
WHOLE = "0"
# How Spark names the folder of a missing value.
MISSING = "__HIVE_DEFAULT_PARTITION__"

Upload = tuple[str, str]
NO_UPLOAD: Upload = ("", "")


class ForeignFiles(ValueError):
    """Files lie beside a landed table that it does not know of."""


def table_path(root: str, tag: str) -> str:
    return f"{root.rstrip('/')}/{tag}"


def landed_root(spark: SparkSession, root: str, tag: str) -> VersionedRoot:
    return VersionedRoot(spark, table_path(root, tag))


def tenancy_of(name: str) -> str | None:
    value = name.split("/")[0].partition("=")[2]
    return None if value == MISSING else unquote(value)


def upload_of(part: Part) -> Upload:
    return part.facts.get("at", ""), part.facts.get("upload", "")


def read_landed(
    spark: SparkSession,
    snapshot: Snapshot,
    schema: T.StructType | None,
    keep: Callable[[str, Part], bool] | None = None,
) -> DataFrame:
    return snapshot.read(spark, ROWS, schema, keep).drop(PART)


def check_nothing_beside(spark: SparkSession, path: str) -> None:
    """Files that were put next to a landed table would be lost on its readers."""
    for name in names(spark, path):
        if name not in (ROWS, POINTERS) and has_files(spark, f"{path}/{name}"):
            raise ForeignFiles(f"{path}/{name} is not part of the landed table")


def _text(at: dt.datetime | None) -> str:
    return at.strftime("%Y-%m-%d %H:%M:%S.%f") if at else ""


def _adopt(spark: SparkSession, root: str, tag: str, fmt: str, plain: Callable[[], DataFrame]) -> Snapshot:
    """The landed table; files delivered before there was one move into its first version."""
    home = landed_root(spark, root, tag)
    path = table_path(root, tag)
    if home.exists() or not has_files(spark, path):
        return home.current()
    change, delivered = home.begin(), plain()
    read = delivered.inputFiles()
    _write(change, delivered.withColumn(PART, F.lit(WHOLE)), fmt)
    snapshot = change.commit()
    for file in read:
        delete(spark, file)
    return snapshot


def _write(change: Change, df: DataFrame, fmt: str) -> list[str]:
    """New parts, and the facts of each from its finished files."""
    found = change.write(df.hint("rebalance", *LAYOUT), ROWS, LAYOUT, fmt)
    if not found:
        return found
    new = change.seen.read(change.spark, ROWS, df.schema, lambda n, _: n in set(found))
    upload = F.max(F.struct(F.col("_upload_timestamp").alias("at"), F.col("_upload_id").alias("id")))
    facts = {
        (r["_tenancy"] or None, str(r[PART])): {"at": _text(r["u"]["at"]), "upload": r["u"]["id"] or ""}
        for r in new.groupBy(*LAYOUT).agg(upload.alias("u")).collect()  # a row a part
    }
    parts = change.tables[ROWS]
    for name in found:
        key = tenancy_of(name), unquote(name.partition(f"{PART}=")[2])
        parts[name] = Part(parts[name].version, fmt, facts.get(key, {}))
    return found


def land_snapshots(df: DataFrame, root: str, tag: str, fmt: str, plain: Callable[[], DataFrame]) -> list[str]:
    """Replace the snapshot of each tenancy in ``df`` in one step; names the parts that changed."""
    spark = df.sparkSession
    base = _adopt(spark, root, tag, fmt, plain)
    change = Change(landed_root(spark, root, tag), base)
    found = _write(change, df.withColumn(PART, F.lit(WHOLE)), fmt)
    if found:
        replaced = {tenancy_of(n) for n in found}
        change.drop(ROWS, [n for n in change.tables[ROWS] if tenancy_of(n) in replaced and n not in found])
        change.commit()
    return found


def copy_parts(
    spark: SparkSession, root: str, backup: str, tag: str, fmt: str, schema: T.StructType, parts: list[str],
    plain: Callable[[], DataFrame],
) -> None:
    """Fill a second root with what was just landed in the first one, from its finished files."""
    source = landed_root(spark, root, tag).current()
    wanted = set(parts) & set(source.parts(ROWS))
    if not wanted:
        return
    rows = source.read(spark, ROWS, T.StructType([*schema.fields, T.StructField(PART, T.StringType())]), lambda n, _: n in wanted)
    change = Change(landed_root(spark, backup, tag), _adopt(spark, backup, tag, fmt, plain))
    found = _write(change, rows, fmt)
    replaced = {tenancy_of(n) for n in found}
    known = source.parts(ROWS)
    change.drop(ROWS, [n for n in change.tables[ROWS] if tenancy_of(n) in replaced and n not in found and n not in known])
    change.commit()


def land_parts(
    df: DataFrame,
    root: str,
    tag: str,
    fmt: str,
    plain: Callable[[], DataFrame],
    file: str | None = None,
) -> Snapshot:
    """Add what has arrived to the landed table, which is returned.

    An upload is known by its time and id.  Of a tenancy the newest upload stands: a newer one takes
    the place of all that is there, an older one is passed over, and further files of the same one
    are added.  ``file`` names the column that tells files apart; a file with the rows of one that
    has landed before, as after a repeated delivery or a replayed batch, changes nothing.
    """
    spark = df.sparkSession
    base = _adopt(spark, root, tag, fmt, plain)
    own = [c for c in df.columns if c != file]
    which = F.col(file) if file else F.lit("")
    digest = F.sum(F.xxhash64(*own).cast("decimal(38,0)"))
    files = (
        df.groupBy("_tenancy", "_upload_timestamp", "_upload_id", which.alias("_file"))
        .agg(F.count(F.lit(1)).alias("n"), digest.alias("digest"))
        .collect()  # a row for each file that has arrived
    )
    newest: dict[str | None, Upload] = {}
    for name, part in base.parts(ROWS).items():
        newest[tenancy_of(name)] = max(newest.get(tenancy_of(name), NO_UPLOAD), upload_of(part))
    landed = dict(newest)
    for r in files:
        upload = _text(r["_upload_timestamp"]), r["_upload_id"] or ""
        newest[r["_tenancy"] or None] = max(newest.get(r["_tenancy"] or None, NO_UPLOAD), upload)
    fresh: dict[tuple[str | None, str], dict] = {}
    for r in sorted(files, key=lambda r: r["_file"] or ""):
        tenancy, upload = r["_tenancy"] or None, (_text(r["_upload_timestamp"]), r["_upload_id"] or "")
        part = f"{int(r['digest']) & (1 << 64) - 1:016x}-{r['n']}"
        if upload == newest[tenancy] and (upload != landed.get(tenancy) or not _holds(base, tenancy, part)):
            fresh.setdefault((tenancy, part), {c: r[c] for c in ("_tenancy", "_upload_timestamp", "_upload_id", "_file")} | {PART: part})
    if not fresh:
        return base
    lineage = T.StructType([df.schema[c] for c in ("_tenancy", "_upload_timestamp", "_upload_id")])
    chosen = local_table(spark, fresh.values(), T.StructType([*lineage.fields, *(T.StructField(c, T.StringType()) for c in ("_file", PART))]))
    chosen = chosen.select(*[F.col(c).alias(f"chosen{c}") for c in chosen.columns])
    same = which.eqNullSafe(F.col("chosen_file"))
    for c in lineage.fieldNames():
        same &= F.col(c).eqNullSafe(F.col(f"chosen{c}"))
    rows = df.join(chosen, same).select(*own, F.col(f"chosen{PART}").alias(PART))
    change = Change(landed_root(spark, root, tag), base)
    found = set(_write(change, rows, fmt))
    changed = {t for t, _ in fresh}
    change.drop(
        ROWS,
        [n for n, p in change.tables[ROWS].items() if n not in found and tenancy_of(n) in changed and upload_of(p) < newest[tenancy_of(n)]],
    )
    return change.commit()


def _holds(snapshot: Snapshot, tenancy: str | None, part: str) -> bool:
    return any(tenancy_of(n) == tenancy and n.endswith(f"{PART}={part}") for n in snapshot.parts(ROWS))
