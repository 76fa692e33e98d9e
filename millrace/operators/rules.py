"""The shipped rules: four over trips, three over readings, plus uniqueness."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions.bands import air_category
from ..functions.numbers import fail_percent, half_up, number_text
from ..functions.predicates import any_null, bad_coordinates, outside_open_range
from ..functions.text import counted
from ..functions.times import clock, days_between, shifted, time_text
from .checks import Check, FromCounter, Metric
from .exact import ExactMean

LATITUDES = ["pickup_latitude", "dropoff_latitude"]
LONGITUDES = ["pickup_longitude", "dropoff_longitude"]
CRITICAL = ["pickup_datetime", "dropoff_datetime", "passenger_count"]


def row_rule(
    name: str,
    rule: str,
    violation: Column,
    *,
    table: str,
    fields: Callable[[], Sequence[Column | FromCounter]],
    summary: str,
    message: str,
    counter: str,
    severity: str = "MEDIUM",
) -> Check:
    """A rule that fails as soon as one row breaks it. The extension point for own
    rules: a predicate, what to record, and two texts with ``{n}`` for the count."""
    issues, total = F.col(counter), F.col("rows")
    return Check(
        name=name,
        rule=rule,
        table=table,
        counters={"rows": F.count(F.lit(1)), counter: F.count_if(violation)},
        total="rows",
        issues=counter,
        failed=issues > 0,
        severity=severity,
        summary=lambda: counted(summary, issues),
        message=lambda: counted(message, issues),
        metrics=lambda: [Metric(rule, fail_percent(issues, total), 0, issues == 0, issues, total)],
        violation=violation,
        fields=fields,
    )


def null_rule(columns: Sequence[str] = CRITICAL, table: str = fv.TRIPS_TABLE) -> Check:
    def fields() -> list[Column | FromCounter]:
        texts = [time_text(F.col(n)) if n.endswith("_datetime") else F.col(n) for n in columns]
        return [
            FromCounter("null_count", "null_rows"),
            *[text.alias(n) for text, n in zip(texts, columns)],
        ]

    return row_rule(
        "NON_NULL",
        "RULE_NON_NULL",
        any_null(columns),
        table=table,
        fields=fields,
        summary=fv.NULLS_SUMMARY,
        message=fv.NULLS_MESSAGE,
        counter="null_rows",
    )


def range_rule(
    column: str = "fare_amount",
    low=fv.FARE_LOW,
    high=fv.FARE_HIGH,
    table: str = fv.TRIPS_TABLE,
) -> Check:
    return row_rule(
        "NUM_RANGE",
        "RULE_FARE_RANGE",
        outside_open_range(F.col(column), low, high),
        table=table,
        fields=lambda: [F.col(column)],
        summary=fv.RANGE_SUMMARY,
        message=fv.RANGE_MESSAGE,
        counter="out_of_range_rows",
    )


def geo_rule(
    lat_bounds=fv.LATITUDE_BOUNDS, lon_bounds=fv.LONGITUDE_BOUNDS, table: str = fv.TRIPS_TABLE
) -> Check:
    return row_rule(
        "GEO_BOUNDS",
        "RULE_GEO_VERIFY",
        bad_coordinates(LATITUDES, LONGITUDES, lat_bounds, lon_bounds),
        table=table,
        fields=lambda: [
            F.col("pickup_latitude"),
            F.col("pickup_longitude"),
            F.col("dropoff_latitude"),
            F.col("dropoff_longitude"),
        ],
        summary=fv.GEO_SUMMARY,
        message=fv.GEO_MESSAGE,
        counter="bad_geo_rows",
    )


def key_counts(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows per key, counted inside the map tasks first."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("key_rows"))


def unique_rule(key: Sequence[str], table: str = fv.TRIPS_TABLE) -> Check:
    """Uniqueness, to be run over :func:`key_counts`. An incomplete key is the
    business of the null rule and is not judged here."""
    surplus = F.when(any_null(key), 0).otherwise(F.col("key_rows") - 1)
    issues, total = F.col("surplus_rows"), F.col("rows")
    return Check(
        name="UNIQUE",
        rule="RULE_UNIQUE",
        table=table,
        counters={
            "rows": F.coalesce(F.sum("key_rows"), F.lit(0)),
            "surplus_rows": F.coalesce(F.sum(surplus), F.lit(0)),
            "repeated_keys": F.count_if(surplus > 0),
        },
        total="rows",
        issues="surplus_rows",
        failed=issues > 0,
        summary=lambda: counted("Uniqueness check: {n} surplus records found", issues),
        message=lambda: counted("Rule 1 check complete: {n} surplus records found", issues),
        details=lambda: [F.col("repeated_keys")],
        metrics=lambda: [
            Metric("RULE_UNIQUE", fail_percent(issues, total), 0, issues == 0, issues, total)
        ],
    )


def _status_text(
    name: str,
    failed: Column,
    label: str,
    issues: Column,
    total: Column,
    pct: Column,
    *extras: tuple[str, Column],
) -> Column:
    """``name: STATUS | label=issues/total (pct%) | extra=…``"""
    parts = [
        F.concat(F.lit(f"{name}: "), F.when(failed, "FAIL").otherwise("PASS")),
        F.concat(
            F.lit(f"{label}="),
            issues.cast("string"),
            F.lit("/"),
            total.cast("string"),
            F.lit(" ("),
            number_text(pct, 1),
            F.lit("%)"),
        ),
    ]
    parts += [F.concat(F.lit(f"{key}="), text) for key, text in extras]
    return F.concat_ws(" | ", *parts)


def reading_null_rule(
    limit_pct: float = fv.NULL_VALUE_LIMIT_PCT, table: str = fv.READINGS_TABLE
) -> Check:
    rows, values = F.col("rows"), F.col("null_values")
    pct = fail_percent(values, rows)
    failed = pct > limit_pct

    def key_metric(name: str, count: Column) -> Metric:
        return Metric(
            name,
            half_up(fail_percent(count, rows), 2),
            fv.NULL_KEY_LIMIT_PCT,
            count == 0,
            count,
            rows,
        )

    def text() -> Column:
        return _status_text("check_openaq_nulls", failed, "null_pm25", values, rows, pct)

    return Check(
        name="check_openaq_nulls",
        rule="null_pm25_check",
        table=table,
        counters={
            "rows": F.count(F.lit(1)),
            "null_values": F.count_if(F.col("pm25_value").isNull()),
            "null_locations": F.count_if(F.col("location_id").isNull()),
            "null_sensors": F.count_if(F.col("sensor_id").isNull()),
        },
        total="rows",
        issues="null_values",
        failed=failed,
        summary=text,
        message=text,
        details=lambda: [
            values.alias("null_pm25_count"),
            F.col("null_locations").alias("null_location_count"),
            F.col("null_sensors").alias("null_sensor_count"),
            half_up(pct, 2).alias("null_pm25_pct"),
            F.lit(limit_pct).alias("threshold_pct"),
        ],
        metrics=lambda: [
            Metric("null_pm25_pct", half_up(pct, 2), limit_pct, pct <= limit_pct, values, rows),
            key_metric("null_location_pct", F.col("null_locations")),
            key_metric("null_sensor_pct", F.col("null_sensors")),
        ],
        violation=F.col("pm25_value").isNull(),
        fields=lambda: [F.col("location_id"), F.col("sensor_id"), F.lit(fv.NULL_VALUE_ISSUE).alias("issue")],
    )


def freshness_rule(
    as_of: dt.datetime | str,
    days: int = fv.STALE_AFTER_DAYS,
    limit_pct: float = fv.STALE_LIMIT_PCT,
    table: str = fv.READINGS_TABLE,
) -> Check:
    """Stale means older than ``days`` before the clock, or without a time."""
    now, moment = clock(as_of), F.col("reading_time")
    edge = shifted(now, days=-days)
    stale = (moment < edge) | moment.isNull()
    rows, old, fresh, unknown = (
        F.col(n) for n in ("rows", "stale_rows", "fresh_rows", "null_times")
    )
    pct = fail_percent(old, rows)
    failed = pct > limit_pct

    def text() -> Column:
        return _status_text("check_openaq_freshness", failed, "stale", old, rows, pct)

    return Check(
        name="check_openaq_freshness",
        rule="freshness_check",
        table=table,
        counters={
            "rows": F.count(F.lit(1)),
            "stale_rows": F.count_if(stale),
            "fresh_rows": F.count_if(moment >= edge),
            "null_times": F.count_if(moment.isNull()),
        },
        total="rows",
        issues="stale_rows",
        failed=failed,
        summary=text,
        message=text,
        details=lambda: [
            old.alias("stale_count"),
            fresh.alias("fresh_count"),
            unknown.alias("null_time"),
            half_up(pct, 2).alias("stale_pct"),
            F.lit(limit_pct).alias("threshold_pct"),
            F.lit(days).alias("stale_after_days"),
        ],
        metrics=lambda: [
            Metric("stale_reading_pct", half_up(pct, 2), limit_pct, pct <= limit_pct, old, rows),
            Metric(
                "fresh_sensor_count", fresh, fv.MIN_FRESH_READINGS, fresh >= fv.MIN_FRESH_READINGS
            ),
            Metric("null_reading_time", unknown, 0, unknown == 0),
        ],
        violation=stale,
        fields=lambda: [
            F.col("location_id"),
            F.col("sensor_id"),
            time_text(moment).alias("reading_time"),
            days_between(moment, now).alias("days_stale"),
            F.lit(fv.STALE_ISSUE).alias("issue"),
        ],
    )


def threshold_rule(
    limit: float = fv.WHO_LIMIT,
    hazardous: float = fv.HAZARDOUS_LIMIT,
    audit_limit_pct: float = fv.WHO_AUDIT_LIMIT_PCT,
    metric_limit_pct: float = fv.WHO_METRIC_LIMIT_PCT,
    table: str = fv.READINGS_TABLE,
) -> Check:
    """Readings above the limit, judged over the non-null readings. The audit row and
    the metric have different tolerances, on purpose."""
    value = F.col("pm25_value")
    total, above, severe, mean = (
        F.col(n) for n in ("readings_with_value", "above_limit", "hazardous_rows", "mean_value")
    )
    pct = fail_percent(above, total)
    failed = pct > audit_limit_pct

    def text() -> Column:
        return _status_text(
            "check_openaq_who_threshold",
            failed,
            "above_who",
            above,
            total,
            pct,
            ("hazardous", severe.cast("string")),
            ("avg_pm25", F.format_string("%.2f", mean)),
        )

    return Check(
        name="check_openaq_who_threshold",
        rule="who_threshold_check",
        table=table,
        counters={
            "readings_with_value": F.count(value),
            "above_limit": F.count_if(value > limit),
            "hazardous_rows": F.count_if(value > hazardous),
            "mean_value": ExactMean(value, lambda mean: half_up(mean, 2)),
        },
        total="readings_with_value",
        issues="above_limit",
        failed=failed,
        summary=text,
        message=text,
        details=lambda: [
            above.alias("above_who_threshold"),
            severe.alias("hazardous_count"),
            half_up(pct, 2).alias("breach_pct"),
            mean.alias("avg_pm25"),
            F.lit(limit).alias("who_threshold"),
            F.lit(hazardous).alias("hazardous_threshold"),
        ],
        metrics=lambda: [
            Metric(
                "who_breach_pct",
                half_up(pct, 2),
                metric_limit_pct,
                pct <= metric_limit_pct,
                above,
                total,
            ),
            Metric("hazardous_count", severe, 0, severe == 0),
            Metric("avg_pm25_ug_m3", mean, limit, mean <= limit),
        ],
        violation=value > limit,
        fields=lambda: [
            F.col("location_id"),
            F.col("sensor_id"),
            value,
            air_category(value).alias("who_category"),
            time_text(F.col("reading_time")).alias("reading_time"),
            F.lit(fv.WHO_ISSUE).alias("issue"),
        ],
    )
