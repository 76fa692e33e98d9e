"""Marts over silver trips.

Money is summed as DECIMAL. Means are an exact sum divided by a count, so they do
not depend on the order in which partitions arrive. Marts are not sorted: a consumer
that wants an order sorts (see :func:`newest_days`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions.bands import fare_bucket
from ..functions.numbers import half_up, share_pct
from ..functions.times import day_text, month_text
from ..schemas import TRIP_NAMES


def _total(name: str) -> Column:
    return F.sum(F.col(name))


def _mean(name: str) -> Column:
    """Mean of a money or whole-number column from its exact sum."""
    filled = F.nullif(F.count(F.col(name)), F.lit(0))
    return F.sum(F.col(name)).cast("double") / filled.cast("double")


def _rows() -> Column:
    return F.count(F.lit(1))


def paid(silver: DataFrame) -> DataFrame:
    return silver.where(F.col("fare_amount") > 0)


def summary_columns(silver: DataFrame) -> DataFrame:
    """The plain projection for reporting tools: all but the store-and-forward flag."""
    return silver.select(*[n for n in TRIP_NAMES if n != "store_and_fwd_flag"])


def billing_summary(silver: DataFrame) -> DataFrame:
    return silver.groupBy(month_text(F.col("pickup_datetime")).alias("billing_month")).agg(
        _rows().alias("total_trips"),
        _total("fare_amount").alias("total_fare"),
        _total("extra").alias("total_extras"),
        _total("mta_tax").alias("total_mta_tax"),
        _total("tip_amount").alias("total_tips"),
        _total("tolls_amount").alias("total_tolls"),
        _total("improvement_surcharge").alias("total_improvements"),
        _total("total_amount").alias("grand_total"),
        _mean("fare_amount").alias("avg_fare"),
        _mean("total_amount").alias("avg_total"),
    )


def operational_reporting(silver: DataFrame) -> DataFrame:
    kind = F.col("payment_type")
    return silver.groupBy(day_text(F.col("pickup_datetime")).alias("reporting_date")).agg(
        _rows().alias("daily_trips"),
        _total("fare_amount").alias("daily_fare"),
        _mean("passenger_count").alias("avg_passengers"),
        _mean("trip_distance").alias("avg_trip_distance"),
        F.max("total_amount").alias("max_fare"),
        F.min("total_amount").alias("min_fare"),
        F.count_if(kind == fv.CARD).alias("card_payments"),
        F.count_if(kind == fv.CASH).alias("cash_payments"),
    )


def daily_kpi(silver: DataFrame) -> DataFrame:
    """Volume and revenue per day. The number of distinct days inside a day is 1 by
    construction, so it is written as such instead of a distinct aggregate."""
    day = F.to_date("pickup_datetime").alias("trip_date")
    tips_of_fare = F.sum("tip_amount").cast("double") / F.nullif(
        F.sum("fare_amount").cast("double"), F.lit(0.0)
    )
    return (
        paid(silver)
        .groupBy(day)
        .agg(
            _rows().alias("total_trips"),
            half_up(_mean("fare_amount"), 2).alias("avg_fare"),
            F.round(_total("fare_amount"), 2).alias("total_revenue"),
            half_up(_mean("trip_distance"), 2).alias("avg_distance_miles"),
            half_up(_mean("passenger_count"), 1).alias("avg_passengers"),
            half_up(_mean("tip_amount"), 2).alias("avg_tip"),
            half_up(tips_of_fare * F.lit(100.0), 1).alias("tip_pct_of_fare"),
            F.max("__silver_loaded_ts").alias("last_loaded_ts"),
        )
        .withColumn("active_days", F.col("trip_date").isNotNull().cast("bigint"))
    )


def payment_kpi(silver: DataFrame) -> DataFrame:
    """Per day and payment type, with its share of the day. The window runs over the
    aggregated rows, and reuses their partitioning only by day."""
    per_type = (
        paid(silver)
        .groupBy(F.to_date("pickup_datetime").alias("trip_date"), "payment_type")
        .agg(
            _rows().alias("trip_count"),
            F.round(_total("fare_amount"), 2).alias("total_fare"),
            half_up(_mean("fare_amount"), 2).alias("avg_fare"),
        )
    )
    of_day = F.sum("trip_count").over(Window.partitionBy("trip_date"))
    return per_type.withColumn(
        "pct_of_daily_trips", half_up(share_pct(F.col("trip_count"), of_day), 1)
    )


def fare_distribution(silver: DataFrame) -> DataFrame:
    """Trips per fare band with their share of all paid trips. The bands are few and
    fixed, so the total is a window over at most six rows, not a second scan."""
    bands = (
        paid(silver)
        .groupBy(fare_bucket(F.col("fare_amount")).alias("fare_bucket"))
        .agg(
            _rows().alias("trip_count"),
            half_up(_mean("fare_amount"), 2).alias("avg_fare_in_bucket"),
            F.min("fare_amount").alias("lowest_fare"),
        )
    )
    everything = F.sum("trip_count").over(Window.partitionBy())
    return bands.withColumn("pct_of_total", half_up(share_pct(F.col("trip_count"), everything), 1))


def newest_days(kpi: DataFrame, days: int = 30) -> DataFrame:
    """The newest ``days`` of the daily KPI, as published."""
    return (
        kpi.select(
            "trip_date",
            "total_trips",
            "avg_fare",
            "total_revenue",
            "avg_distance_miles",
            "avg_passengers",
            "avg_tip",
        )
        .orderBy(F.col("trip_date").desc())
        .limit(days)
    )
