"""The maintained tables and their published copies on storage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postura import schemas
from postura.sources.paths import has_files


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    names = schema.fieldNames()
    return spark.read.schema(schema).parquet(path).select(*names)


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table, or a typed empty one on the first run."""
    if has_files(spark, path):
        return read_table(spark, path, schema)
    return empty_table(spark, schema)


def replace_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], rebalance: bool = True
) -> None:
    """Replace exactly the partitions that ``df`` has rows for.

    When the partition columns are the keys of a delete-and-insert, this is that
    operation without reading, shuffling or rewriting any of the history.  Task
    output is staged and moved on job commit, so lost executors and reruns leave
    no partial or doubled rows.

    ``rebalance`` evens out file sizes, splitting partitions that hold most of the rows;
    without it every task writes a file to every partition it has rows for.
    """
    rows = df.hint("rebalance", *partition_by) if rebalance else df
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


# A header, and quotes doubled as spreadsheets and browsers expect.
CSV_OPTIONS = {"header": True, "escape": '"'}


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def read_csv_strings(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """CSV as text columns; blank lines are skipped, numbers are parsed later."""
    text = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(text).options(**CSV_OPTIONS).csv(path)


def read_summary_csv(spark: SparkSession, path: str) -> DataFrame:
    """A published summary with its types restored; unreadable numbers become NULL."""
    text = read_csv_strings(spark, path, schemas.SUMMARY.fieldNames())
    return text.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schemas.SUMMARY]
    )


def read_json_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The JSON twin of the published table."""
    return spark.read.schema(schema).json(path)


def jdbc_options(
    url: str, table: str, user: str, password: str, partitions: int = 8, batch: int = 10_000
) -> dict[str, str]:
    """Options of a parallel, batched database write that keeps the table definition."""
    return {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "numPartitions": str(partitions),
        "batchsize": str(batch),
        "truncate": "true",
    }


def write_jdbc(df: DataFrame, options: Mapping[str, str], mode: str = "overwrite") -> None:
    df.write.format("jdbc").options(**options).mode(mode).save()
