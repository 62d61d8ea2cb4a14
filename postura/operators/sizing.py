"""Small tables whose size is known before a join is planned.

There is no broadcast hint in this package.  A side is made small *and measurable*
(a local relation, or a literal LIMIT that is known not to cut anything) and Spark's
own size check decides; past the check the ordinary shuffled join runs.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

def local_table(
    spark: SparkSession, rows: Iterable[Mapping[str, Any]], schema: T.StructType
) -> DataFrame:
    """Driver rows as a local relation with exact statistics."""
    table = pa.Table.from_pylist(list(rows), schema=to_arrow_schema(schema))
    return spark.createDataFrame(table, schema)
