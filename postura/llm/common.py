"""Shared by the operators: reading documents, Arrow batches, checkpoints.

Every operator takes a frame with an id and a text column, whatever else the frame holds, and
selects just these under its own names; columns of the same names as its results are harmless.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from postura.session import scratch_path, shared_root

#: Rows and text bytes that a Python worker takes at once.
ROWS_AT_ONCE = 1024
BYTES_AT_ONCE = 4 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/conversations.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` cut from its lineage, in the folder that all executors share."""
    spark = df.sparkSession
    root = shared_root(spark)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(root)
    return df.checkpoint()


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """``df`` as a table in the shared folder: cut from its lineage, and of known size when joined."""
    path = scratch_path(df.sparkSession, f"llm-{label}")
    df.write.parquet(path, **options)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def struct_type(schema: str) -> StructType:
    return _parse_datatype_string(schema)


def pieces(batch: pa.RecordBatch, text: str = "text") -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows that hold about ``BYTES_AT_ONCE`` of text; a row is never cut."""
    if text not in batch.schema.names:
        yield batch
        return
    start, held = 0, 0
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
    for i, n in enumerate(lengths):
        held += n
        if held >= BYTES_AT_ONCE or i + 1 - start >= ROWS_AT_ONCE:
            yield batch.slice(start, i + 1 - start)
            start, held = i + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def _give_back() -> None:
    """Return what a task has used to the system: workers are reused, and share an executor's memory."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL(None).malloc_trim(0)


def map_columns(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], dict]], schema: str, text: str = "text"
) -> DataFrame:
    """Rows from batches of rows.

    ``make`` builds the worker's function once per task; the function turns a batch into columns.
    """
    fields = to_arrow_schema(struct_type(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        try:
            for batch in batches:
                for part in pieces(batch, text):
                    columns = work(part)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(columns[f.name], type=f.type) for f in fields], schema=fields
                    )
        finally:
            del work
            _give_back()

    return df.mapInArrow(run, schema)


def keep_rows(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], list]], text: str = "text") -> DataFrame:
    """The rows of ``df``, all columns untouched, for which the worker's function says true."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        try:
            for batch in batches:
                for part in pieces(batch, text):
                    yield part.filter(pa.array(work(part), type=pa.bool_()))
        finally:
            del work
            _give_back()

    return df.mapInArrow(run, df.schema)


def held_out(doc_id, modulus: int = 5):
    """crc32 of the id as text, modulo five."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def crc32(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF
