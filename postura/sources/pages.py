"""API deliveries: pages to rows, and whether all pages arrived."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postura.functions.dates import DateLike, date_minus, to_date_lenient


def flatten_pages(pages: DataFrame, array_col: str, parents: Sequence[str] = ()) -> DataFrame:
    """One row per record of every page, beside the columns naming the page's parent.

    ``array_col`` may be nested (``body.resources``).  Empty pages vanish.  A page
    that is a bare array needs no call: the JSON reader already expands it.
    """
    records = pages.select(*parents, F.explode(array_col).alias("_record"))
    return records.select(*parents, "_record.*")


def page_completeness(
    pages: DataFrame, array_col: str, total_col: str = "total", parents: Sequence[str] = ()
) -> DataFrame:
    """Rows received against the total the source declared, per parent."""
    received = F.sum(F.coalesce(F.size(array_col), F.lit(0)).cast("bigint"))
    return (
        pages.groupBy(*parents)
        .agg(received.alias("received"), F.max(total_col).cast("bigint").alias("declared"))
        .withColumn("complete", F.col("received") >= F.col("declared"))
    )


def recent_findings(
    findings: DataFrame, as_of: DateLike, days: int = 14, ordered: bool = True
) -> DataFrame:
    """Findings with an identifier, seen in the last ``days`` days, oldest update first.

    The keys after the update time spread a range-partitioned sort when a bulk
    update gave one time to a large share of the rows.
    """
    wanted = findings.filter(
        (F.col("cve.id") != "")
        & (to_date_lenient("last_seen") >= date_minus(as_of, days=days))
    )
    return wanted.orderBy("updated_timestamp", "aid", "cve.id") if ordered else wanted
