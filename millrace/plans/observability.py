"""Views over the audit log and the metrics table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions.bands import health_label
from ..functions.numbers import half_up, share_pct
from ..functions.predicates import like_any
from ..functions.times import (
    clock,
    day_text,
    hour_text,
    midnight,
    minutes_between,
    on_run_days,
    within_days,
)
from .air_marts import who_breaches

RUN = "run_timestamp"


def _checks() -> Column:
    return F.count(F.lit(1))


def _passed() -> Column:
    """Unknown outcomes are neither passed nor failed."""
    return F.count_if(F.col("passed"))


def _failed() -> Column:
    return F.count_if(~F.col("passed"))


def _score() -> Column:
    """Mean of 100 per passed check; an unknown outcome scores 0."""
    return share_pct(_passed(), _checks())


def health_score(metrics: DataFrame) -> DataFrame:
    """Per day, exact run time, table and metric."""
    return metrics.groupBy(
        day_text(F.col(RUN)).alias("metric_date"), RUN, "table_name", "metric_name"
    ).agg(
        _checks().alias("total_checks"),
        _passed().alias("passed_checks"),
        _failed().alias("failed_checks"),
        _score().alias("aggregate_dq_score"),
        half_up(share_pct(_failed(), _checks()), 2).alias("fail_percent"),
    )


def violations_by_type(audit: DataFrame) -> DataFrame:
    return (
        audit.where(F.col("status") == "FAIL")
        .groupBy("check_name", F.col("status").alias("severity"))
        .agg(
            _checks().alias("violation_count"),
            F.sum("issue_count").alias("total_failed_records"),
            F.max(RUN).alias("last_violation"),
        )
    )


def _recent(metrics: DataFrame, as_of: dt.datetime | str, days: int) -> DataFrame:
    moment, now = F.col(RUN), clock(as_of)
    listed = on_run_days(metrics, F.date_sub(F.to_date(now), days), F.to_date(now))
    return listed.where(within_days(moment, now, days) & (moment <= now))


def gold_matrix(
    metrics: DataFrame, as_of: dt.datetime | str, days: int = fv.TREND_DAYS
) -> DataFrame:
    """One row over the recent days; rates between 0 and 1, NULL on an empty window."""
    total = F.nullif(_checks(), F.lit(0)).cast("double")
    rate = _passed().cast("double") / total
    return _recent(metrics, as_of, days).agg(
        F.lit(fv.SCORE_LABEL).alias("metric_category"),
        rate.alias("pass_rate"),
        (F.lit(1.0) - rate).alias("fail_rate"),
        _checks().alias("total_rules"),
    )


def trend(metrics: DataFrame, as_of: dt.datetime | str, days: int = fv.TREND_DAYS) -> DataFrame:
    """Hourly counts over the recent days."""
    return trend_rows(_recent(metrics, as_of, days))


def trend_rows(metrics: DataFrame) -> DataFrame:
    bucket = hour_text(F.col(RUN)).alias("time_bucket")
    return metrics.groupBy(bucket, "table_name", "metric_name").agg(
        _checks().alias("total_checks"),
        _passed().alias("pass_count"),
        _failed().alias("fail_count"),
        half_up(share_pct(_failed(), _checks()), 2).alias("avg_fail_percent"),
    )


def scorecard_today(metrics: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    """One row for the clock's day so far."""
    moment, now = F.col(RUN), clock(as_of)
    today = on_run_days(metrics, F.to_date(now))
    return today.where((moment >= midnight(now)) & (moment <= now)).agg(
        _checks().alias("total_checks"),
        _passed().alias("passed_checks"),
        _failed().alias("failed_checks"),
        _score().alias("health_score"),
    )


def daily_pass_fail(
    metrics: DataFrame, as_of: dt.datetime | str, days: int = fv.TREND_DAYS
) -> DataFrame:
    return (
        _recent(metrics, as_of, days)
        .groupBy(F.to_date(RUN).alias("run_date"))
        .agg(_passed().alias("pass_count"), _failed().alias("failed_count"))
    )


def recent_metrics(
    metrics: DataFrame, as_of: dt.datetime | str, days: int = fv.TREND_DAYS
) -> DataFrame:
    """The recent metric rows, newest first."""
    return _recent(metrics, as_of, days).orderBy(F.col(RUN).desc(), F.col("metric_id").desc())


def recent_audit(audit: DataFrame, rows: int = 100) -> DataFrame:
    """The latest audit rows; the log id breaks ties."""
    return audit.orderBy(F.col(RUN).desc(), F.col("log_id").desc()).limit(rows)


def health_rows(audit: DataFrame) -> DataFrame:
    """Audit rows of the trip tables with issue share and label."""
    issues, rows = F.col("issue_count"), F.col("row_count")
    return audit.where(like_any(F.col("table_name"), fv.HEALTH_TABLE_PATTERNS)).select(
        F.to_date(RUN).alias("check_date"),
        "check_name",
        "status",
        "row_count",
        "issue_count",
        half_up(share_pct(issues, rows), 2).alias("issue_pct"),
        health_label(F.col("status"), issues).alias("health_label"),
        RUN,
    )


def _audit_health(audit: DataFrame, now: Column, dataset: Column) -> DataFrame:
    passed = F.count_if(F.col("status") == "PASS")
    return (
        audit.groupBy(dataset.alias("dataset"))
        .agg(
            _checks().alias("total_checks"),
            passed.alias("passed"),
            F.count_if(F.col("status") == "FAIL").alias("failed"),
            half_up(share_pct(passed, _checks()), 1).alias("pass_rate_pct"),
            F.max(RUN).alias("last_run_ts"),
        )
        .withColumn("minutes_since_last_run", minutes_between(F.col("last_run_ts"), now))
    )


def health_summary(
    audit: DataFrame, readings: DataFrame, as_of: dt.datetime | str, per_dataset: bool = False
) -> DataFrame:
    """Pass rates of the two datasets: one row from the audit log, one from the share
    of readings above the limit. ``per_dataset`` splits the audit row by table."""
    now = clock(as_of)
    if per_dataset:
        dataset = F.when(
            F.col("table_name") == fv.READINGS_TABLE, fv.READINGS_DATASET
        ).otherwise(fv.TRIPS_DATASET)
    else:
        dataset = F.lit(fv.TRIPS_DATASET)
    above = F.col("pct_above_who")
    half = 50
    by_share = who_breaches(readings, as_of).select(
        F.lit(fv.READINGS_DATASET).alias("dataset"),
        F.lit(1).cast("bigint").alias("total_checks"),
        F.when(above < half, 1).otherwise(0).cast("bigint").alias("passed"),
        F.when(above >= half, 1).otherwise(0).cast("bigint").alias("failed"),
        half_up(F.lit(100.0) - above, 1).alias("pass_rate_pct"),
        F.col("summary_ts").alias("last_run_ts"),
        minutes_between(F.col("summary_ts"), now).alias("minutes_since_last_run"),
    )
    return _audit_health(audit, now, dataset).unionByName(by_share)
