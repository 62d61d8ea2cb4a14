"""The text of the run alert.  Sending it is the caller's business."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postura.functions.numbers import percent, plain_number

# Fixed value: first line of the alert.
HEADER = "Automated Security Metric results:"


def alert_lines(alerts: DataFrame) -> DataFrame:
    """``{icon} {title} - {percent}% ({failed})`` per metric and date."""
    line = F.format_string(
        "%s %s - %d%% (%s)",
        "icon",
        "title",
        percent("score", 0).cast("bigint"),
        plain_number("failed"),
    )
    return alerts.withColumn("line", line)


def alert_message(lines: DataFrame) -> DataFrame:
    """One message per run date: the header, then its lines in group order.

    A date has as many lines as there are metric definitions.
    """
    order = ("metric_id", "title", "category", "slo", "slo_min")
    sorted_lines = F.sort_array(F.collect_list(F.struct(*order, "line")))
    body = F.array_join(F.transform(sorted_lines, lambda r: r["line"]), "\n")
    return lines.groupBy("datestamp").agg(F.concat_ws("\n", F.lit(HEADER), body).alias("message"))
