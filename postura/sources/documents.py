"""Raw records as JSON documents: the append-only database layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_documents(df: DataFrame) -> DataFrame:
    """``(upload_timestamp, tenancy, json_data)``; the document keeps every column."""
    return df.select(
        F.col("_upload_timestamp").alias("upload_timestamp"),
        F.col("_tenancy").alias("tenancy"),
        F.to_json(F.struct("*")).alias("json_data"),
    )


def from_documents(documents: DataFrame, schema: T.StructType) -> DataFrame:
    return documents.select(F.from_json("json_data", schema).alias("r")).select("r.*")


def append_documents(df: DataFrame, path: str) -> None:
    to_documents(df).write.mode("append").parquet(path)
