"""Table schemas and column contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import fixed_values as fv

TRIP_CONTRACT: dict[str, str] = dict(fv.TRIP_COLUMNS)
TRIP_NAMES: list[str] = list(TRIP_CONTRACT)

READINGS = (
    "ingest_ts timestamp_ntz, source_file string, location_id bigint, sensor_id bigint, "
    "parameter string, unit string, pm25_value double, reading_time timestamp_ntz, "
    "coverage_pct double, who_category string"
)
BRONZE = (
    "raw_data variant, file_name string, file_row_number bigint, "
    "load_timestamp timestamp_ntz, source_format string"
)
AUDIT = (
    "log_id bigint, run_id string, run_timestamp timestamp_ntz, table_name string, "
    "check_name string, status string, row_count bigint, issue_count bigint, "
    "severity string, summary string, details string"
)
METRICS = (
    "metric_id bigint, run_id string, run_timestamp timestamp_ntz, table_name string, "
    "metric_name string, metric_value double, threshold double, passed boolean, "
    "fail_count bigint, total_count bigint"
)
VIOLATIONS = (
    "run_id string, detected_at timestamp_ntz, table_name string, rule_name string, "
    "violation_details string"
)


def column_names(schema: str) -> list[str]:
    return [part.strip().split(" ")[0] for part in schema.split(", ")]


def conform(df: DataFrame, schema: str) -> DataFrame:
    """Select and cast to ``schema``; a column the frame lacks becomes NULL."""
    have = set(df.columns)
    out = []
    for part in schema.split(", "):
        name, kind = part.strip().split(" ", 1)
        source = F.col(name) if name in have else F.lit(None)
        out.append(source.cast(kind).alias(name))
    return df.select(*out)
