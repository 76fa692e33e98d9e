"""Marts over flattened air-quality readings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions.bands import freshness_label
from ..functions.numbers import half_up, share_pct
from ..functions.times import clock, days_between
from ..operators import exact

VALUE = "pm25_value"


def _above(limit: float) -> Column:
    return F.count_if(F.col(VALUE) > limit)


def _mean(value: Column) -> exact.ExactMean:
    return exact.ExactMean(value, lambda mean: half_up(mean, 1))


def location_kpi(readings: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    """Per location, parameter and unit. ``worst_category`` is the alphabetical
    maximum of the labels; ``worst_category_by_value`` is the category of the highest
    value."""
    value = F.col(VALUE)
    per_location = exact.aggregate(
        readings.where(value.isNotNull()),
        ["location_id", "parameter", "unit"],
        {
            "sensor_count": F.count(F.lit(1)),
            "avg_pm25": _mean(value),
            "max_pm25": exact.largest(value),
            "min_pm25": exact.smallest(value),
            "latest_reading": exact.largest(F.col("reading_time")),
            "null_count": F.count_if(value.isNull()),
            "above_who_threshold": _above(fv.WHO_LIMIT),
            "hazardous_count": _above(fv.HAZARDOUS_LIMIT),
            "worst_category": exact.largest(F.col("who_category")),
            "worst_category_by_value": exact.largest_of(F.col("who_category"), value),
        },
    )
    days = days_between(F.col("latest_reading"), clock(as_of))
    return per_location.withColumns(
        {
            "max_pm25": half_up(F.col("max_pm25"), 1),
            "min_pm25": half_up(F.col("min_pm25"), 1),
            "days_since_last_reading": days,
        }
    )


def category_distribution(readings: DataFrame) -> DataFrame:
    """Readings per category. The share runs over the handful of category rows."""
    per_category = exact.aggregate(
        readings,
        ["who_category"],
        {"sensor_count": F.count(F.lit(1)), "avg_pm25_in_category": _mean(F.col(VALUE))},
    )
    everything = F.sum("sensor_count").over(Window.partitionBy())
    return per_category.withColumn(
        "pct_of_total", half_up(share_pct(F.col("sensor_count"), everything), 1)
    )


def freshness(readings: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    now, moment = clock(as_of), F.col("reading_time")
    return readings.select(
        "location_id",
        "sensor_id",
        VALUE,
        "reading_time",
        "who_category",
        days_between(moment, now).alias("days_stale"),
        freshness_label(moment, now).alias("freshness_label"),
    )


def who_breaches(readings: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    """One row over all readings."""
    value = F.col(VALUE)
    counted = exact.aggregate(
        readings,
        [],
        {
            "total_sensors": F.count(F.lit(1)),
            "sensors_with_data": F.count(value),
            "above_who_threshold": _above(fv.WHO_LIMIT),
            "hazardous_readings": _above(fv.HAZARDOUS_LIMIT),
            "overall_avg_pm25": _mean(value),
        },
    )
    share = share_pct(F.col("above_who_threshold"), F.col("sensors_with_data"))
    return counted.withColumns({"pct_above_who": half_up(share, 1), "summary_ts": clock(as_of)})
