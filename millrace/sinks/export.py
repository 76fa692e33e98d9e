"""Dated JSON exports of the result tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions.text import json_object
from ..functions.times import clock, on_day, on_run_days, time_text

# fixed values: exported keys, in order
AUDIT_KEYS = [
    "log_id",
    "run_timestamp",
    "table_name",
    "check_name",
    "status",
    "row_count",
    "issue_count",
    "details",
]
METRIC_KEYS = [
    "metric_id",
    "run_timestamp",
    "table_name",
    "metric_name",
    "metric_value",
    "threshold",
    "passed",
]


@dataclass(frozen=True)
class ExportStatus:
    ok: bool
    message: str


def _export_field(df: DataFrame, name: str) -> Column:
    if name not in df.columns:
        return F.lit(None).cast("string").alias(name)
    if name == "run_timestamp":
        return time_text(F.col(name)).alias(name)
    if name == "details":
        return F.try_parse_json(F.col(name)).alias(name)
    return F.col(name).alias(name)


def export_rows(results: DataFrame, keys: list[str], day: dt.date | str) -> DataFrame:
    """The result rows of ``day`` with the exported keys; details become an object."""
    today = on_run_days(results, F.to_date(clock(day))).where(
        on_day(F.col("run_timestamp"), clock(day))
    )
    return today.select(*[_export_field(results, k) for k in keys])


def export_json(
    results: DataFrame,
    keys: list[str],
    day: dt.date | str,
    root: str,
    name: str,
    file_bytes: int = fv.EXPORT_FILE_BYTES,
) -> str:
    """Write the day's rows to ``<root>/<name>/<day>/`` as gzipped JSON lines without the
    NULL keys, replacing an earlier export of that day. Tasks write in parallel; a file is
    cut when it holds about ``file_bytes`` of text, judged by the day's mean row length.
    Rows of many small runs are gathered first."""
    path = f"{root}/{name}/{day}"
    rows = export_rows(results, keys, day)
    length = F.octet_length(json_object(*[F.col(k) for k in keys]))
    mean_bytes = rows.agg(F.avg(length)).collect()[0][0] or 1
    (
        rows.hint("rebalance")  # the day's rows may lie in many small result files
        .write.mode("overwrite")
        .option("compression", "gzip")
        .option("ignoreNullFields", True)
        .option("maxRecordsPerFile", max(1, int(file_bytes / mean_bytes)))
        .json(path)
    )
    return path


def export_all(
    audit: DataFrame,
    metrics: DataFrame,
    day: dt.date | str,
    root: str,
    on_error: Callable[[Exception], None] | None = None,
) -> ExportStatus:
    """Export both tables. An error is returned as a message, not raised; ``ok`` is
    false then, so that a caller can still stop."""
    try:
        export_json(audit, AUDIT_KEYS, day, root, "dq_audit_log")
        export_json(metrics, METRIC_KEYS, day, root, "dq_metrics")
    except Exception as error:  # noqa: BLE001
        if on_error:
            on_error(error)
        return ExportStatus(False, f"Export failed: {error}")
    return ExportStatus(True, f"DQ results exported for {day}")
