"""Publishing as files arrive.

Raw records are landed by tenancy, as they arrive: an upload may come in several files, late, or again.
Then the maintained summary takes the difference that the new files make (``differences``).  A replayed
or repeated delivery lands as it did before and changes nothing.

A stream of detail rows has as its sink a log of summary rows: each batch writes its sums under its
batch id.  That is one partition per batch however many metric-days it touches, nothing written
before is read or rewritten, no state store is kept, and a batch replayed after a failure overwrites
itself.  What a metric-day's newest state is, is decided on reading; the summary is small beside the
rows it sums up.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from postura import schemas
from postura.operators.rollups import summarise
from postura.plans.publish import Store
from postura.session import scratch_path
from postura.sources.library import MetricDefinition
from postura.sources.paths import delete
from postura.sources.raw import RawTables, land_arriving, latest_snapshot
from postura.sources.tables import replace_partitions
from postura.streaming.differences import Maintained

BATCH = "batch_id"
_FILE = "_file"
_LOG = T.StructType([*schemas.SUMMARY.fields, T.StructField(BATCH, T.LongType())])


def stream_rows(
    spark: SparkSession,
    path: str,
    schema: T.StructType = schemas.DETAIL,
    fmt: str = "json",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Rows of the files landing in ``path``.

    A batch takes all that has landed since the last one.  ``files_per_batch`` bounds it,
    which may cut a metric-day in two: for ``accumulated_summary`` only.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def _into_log(arriving: DataFrame, log_path: str, checkpoint: str) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        rolled = summarise(batch).withColumn(BATCH, F.lit(batch_id).cast("bigint"))
        replace_partitions(rolled, log_path, [BATCH])

    return (
        arriving.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def stream_publish(rows: DataFrame, log_path: str, checkpoint: str) -> StreamingQuery:
    """Summarise arriving detail rows into the log, until all that has landed is read.

    The batch ids come from ``checkpoint``; it has to be kept as long as the log.
    """
    return _into_log(rows, log_path, checkpoint)


def stream_metrics(
    arriving: DataFrame,
    tag: str,
    definitions: Sequence[MetricDefinition],
    tables: RawTables,
    as_of: dt.date,
    root: str,
    store: Store,
    checkpoint: str,
    assets: DataFrame | None = None,
) -> StreamingQuery:
    """Land arriving raw records of ``tag`` below ``root`` and bring the summary up to date.

    Records need their lineage.  Of several uploads of a tenancy the newest stands, in a batch
    and between batches, and all files of that upload count, whichever batch they come in.
    ``tables`` holds the other raw tables the metrics refer to; given as frames, they must stay
    as they are as long as ``checkpoint`` is used.
    """
    spark = arriving.sparkSession
    try:  # a file source says which file a row is from
        arriving = arriving.withColumn(_FILE, F.col("_metadata.file_path"))
    except AnalysisException:
        arriving = arriving.withColumn(_FILE, F.lit(None).cast("string"))

    def update(batch: DataFrame, batch_id: int) -> None:
        # Landing reads its rows more than once: they are parsed once.
        parsed = scratch_path(spark, "arriving")
        batch.write.parquet(parsed)
        land_arriving(batch.sparkSession.read.schema(batch.schema).parquet(parsed), root, tag, file=_FILE)
        Maintained(spark, tag, definitions, tables, as_of, root, store, assets).update()
        delete(spark, parsed)

    return (
        arriving.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(update)
        .start()
    )


def replaced_summary(spark: SparkSession, log_path: str) -> DataFrame:
    """The summary where the newest batch of a (metric, date) replaces the earlier ones.

    For deliveries that hold their metric-days completely and land as a whole: a late or
    repeated one replaces what came before.
    """
    log = spark.read.schema(_LOG).parquet(log_path)
    newest = latest_snapshot(log, schemas.SUMMARY_REPLACE_KEYS, BATCH)
    return newest.select(*schemas.SUMMARY.fieldNames())


def accumulated_summary(spark: SparkSession, log_path: str) -> DataFrame:
    """The summary where batches add up: for sources spreading a metric-day over batches."""
    return (
        spark.read.schema(_LOG)
        .parquet(log_path)
        .groupBy(*schemas.SUMMARY_KEYS)
        .agg(F.sum("totalok").alias("totalok"), F.sum("total").alias("total"))
    )
