"""Lineage columns and dated path templates."""

from __future__ import annotations

import datetime as dt
import re
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Template variable -> strftime pattern.
TIME_TOKENS = {"YYYY": "%Y", "MM": "%m", "DD": "%d", "hh": "%H", "mm": "%M", "ss": "%S"}
# Fixed value: how an upload time is written out.
UPLOAD_TIME_FORMAT = "%Y-%m-%d %H:%M:%S"

_VARIABLE = re.compile("%(" + "|".join(["UUID", "TAG", "TENANCY", *TIME_TOKENS]) + ")")


def with_lineage(
    df: DataFrame,
    tenancy: str | Column,
    uploaded_at: dt.datetime | str,
    upload_id: str | None = None,
) -> DataFrame:
    """Stamp who delivered the rows, when, and in which upload.

    The id is drawn once on the driver, so a retried task writes the same id.
    """
    if isinstance(uploaded_at, dt.datetime):
        uploaded_at = uploaded_at.strftime(UPLOAD_TIME_FORMAT)
    return df.withColumns(
        {
            "_tenancy": tenancy if isinstance(tenancy, Column) else F.lit(tenancy).cast("string"),
            "_upload_timestamp": F.lit(uploaded_at).cast("timestamp"),
            "_upload_id": F.lit(upload_id or str(uuid.uuid4())),
        }
    )


def expand_template(
    template: str | None, tag: str | None, tenancy: str, at: dt.datetime, unique: str | None = None
) -> str:
    """Fill the ``%`` variables of a target path."""

    def value(match: re.Match[str]) -> str:
        name = match.group(1)
        if name in TIME_TOKENS:
            return at.strftime(TIME_TOKENS[name])
        return {"UUID": unique or str(uuid.uuid4()), "TAG": tag or "", "TENANCY": tenancy}[name]

    return _VARIABLE.sub(value, template or "")


# The partition column that stands for each path variable.
_PARTS = {"YYYY": "year", "MM": "month", "DD": "day", "hh": "hour", "mm": "minute", "ss": "second"}


def template_columns(template: str, tag: str, ts: str = "_upload_timestamp") -> dict[str, Column]:
    """The variables of a path template as partition columns, in its order."""
    patterns = {"YYYY": "yyyy", "MM": "MM", "DD": "dd", "hh": "HH", "mm": "mm", "ss": "ss"}
    columns: dict[str, Column] = {}
    for name in _VARIABLE.findall(template):
        if name == "TAG":
            columns["tag"] = F.lit(tag)
        elif name == "TENANCY":
            columns["tenancy"] = F.col("_tenancy")
        elif name != "UUID":
            columns[_PARTS[name]] = F.date_format(ts, patterns[name])
    return columns
