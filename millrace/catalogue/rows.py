"""Row predicates and scalar expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions.numbers import fail_percent, half_up, number_text
from ..functions.predicates import (
    any_null,
    like_any,
    not_listed,
    outside_bounds,
    outside_open_range,
)
from ..functions.text import counted, json_object, strip_markdown
from ..functions.times import (
    clock,
    day_text,
    days_between,
    hour_text,
    midnight,
    minutes_between,
    month_text,
    on_day,
    parsed_time,
    shifted,
    stamp_text,
    time_text,
    within_days,
    within_minutes,
)
from ..operators.rules import CRITICAL
from ..sinks.layout import landing_path
from . import inputs as i
from .registry import query

NOW = f"TIMESTAMP '{i.RESULTS_CLOCK}'"
TODAY = f"DATE '{i.RESULTS_DAY}'"


def now():
    return clock(i.RESULTS_CLOCK)


# --- predicates ------------------------------------------------------------------


@query(
    "null_any_predicate",
    i.over(
        "trips",
        """SELECT pickup_datetime, dropoff_datetime, passenger_count FROM trips
WHERE pickup_datetime IS NULL OR dropoff_datetime IS NULL OR passenger_count IS NULL""",
    ),
)
def null_any_predicate(spark, sf_dir):
    return i.trips(spark, sf_dir).where(any_null(CRITICAL)).select(*CRITICAL)


@query(
    "open_range_predicate",
    i.over(
        "trips",
        """SELECT fare_amount <= 0 OR fare_amount >= 500 AS outside, count(*) AS n
FROM trips GROUP BY outside""",
    ),
)
def open_range_predicate(spark, sf_dir):
    outside = outside_open_range(F.col("fare_amount"), fv.FARE_LOW, fv.FARE_HIGH)
    return (
        i.trips(spark, sf_dir)
        .groupBy(outside.alias("outside"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "between_predicate",
    i.over(
        "trips",
        """SELECT pickup_latitude NOT BETWEEN -90 AND 90 AS bad_latitude,
 pickup_longitude NOT BETWEEN -180 AND 180 AS bad_longitude, count(*) AS n
FROM trips GROUP BY ALL""",
    ),
)
def between_predicate(spark, sf_dir):
    return (
        i.trips(spark, sf_dir)
        .groupBy(
            outside_bounds(F.col("pickup_latitude"), fv.LATITUDE_BOUNDS).alias("bad_latitude"),
            outside_bounds(F.col("pickup_longitude"), fv.LONGITUDE_BOUNDS).alias("bad_longitude"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "not_in_list",
    i.over(
        "audit",
        """SELECT log_id, check_name FROM audit
WHERE check_name NOT IN ('click', 'view', 'purchase')""",
    ),
)
def not_in_list(spark, sf_dir):
    return (
        i.audit(spark, sf_dir)
        .where(not_listed(F.col("check_name"), ["click", "view", "purchase"]))
        .select("log_id", "check_name")
    )


@query(
    "ilike_any",
    i.over(
        "audit",
        """SELECT log_id, table_name FROM audit
WHERE regexp_matches(lower(table_name), 'silver|bronze|taxi')""",
    ),
)
def ilike_any(spark, sf_dir):
    return (
        i.audit(spark, sf_dir)
        .where(like_any(F.col("table_name"), fv.HEALTH_TABLE_PATTERNS))
        .select("log_id", "table_name")
    )


@query(
    "ilike_scalar",
    i.over(
        "trips",
        """SELECT payment_type, payment_type ILIKE '%ca%' AS has_ca, count(*) AS n
FROM trips GROUP BY ALL""",
    ),
)
def ilike_scalar(spark, sf_dir):
    return (
        i.trips(spark, sf_dir)
        .groupBy("payment_type", F.col("payment_type").ilike("%ca%").alias("has_ca"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "lookback_days",
    i.over(
        "metrics",
        f"""SELECT metric_id, run_timestamp FROM metrics
WHERE run_timestamp >= {TODAY} - INTERVAL 7 DAY""",
    ),
)
def lookback_days(spark, sf_dir):
    rows = i.metrics(spark, sf_dir)
    return rows.where(within_days(F.col("run_timestamp"), now(), 7)).select(
        "metric_id", "run_timestamp"
    )


@query(
    "lookback_minutes",
    i.over(
        "audit",
        f"""SELECT log_id, run_timestamp FROM audit
WHERE run_timestamp BETWEEN {NOW} - INTERVAL 60 MINUTE AND {NOW}""",
    ),
)
def lookback_minutes(spark, sf_dir):
    moment = F.col("run_timestamp")
    return (
        i.audit(spark, sf_dir)
        .where(within_minutes(moment, now(), fv.ALERT_MINUTES) & (moment <= now()))
        .select("log_id", "run_timestamp")
    )


@query(
    "same_day",
    i.over(
        "audit",
        f"SELECT log_id, run_timestamp FROM audit WHERE CAST(run_timestamp AS DATE) = {TODAY}",
    ),
)
def same_day(spark, sf_dir):
    return (
        i.audit(spark, sf_dir)
        .where(on_day(F.col("run_timestamp"), now()))
        .select("log_id", "run_timestamp")
    )


# --- scalar expressions ------------------------------------------------------------


@query(
    "variant_path",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
 json_extract_string(props, '$.absent.deeper') AS absent FROM events""",
)
def variant_path(spark, sf_dir):
    events = i.table(spark, sf_dir, "events").withColumn("doc", F.parse_json("props"))
    return events.select(
        "event_id",
        F.variant_get("doc", "$.k", "bigint").alias("k"),
        F.variant_get("doc", "$.absent.deeper", "string").alias("absent"),
    )


@query(
    "ansi_cast",
    """SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2))::DOUBLE AS price,
 CAST(o_orderkey AS VARCHAR) AS key_text, CAST(o_orderdate AS DATE) AS order_day FROM orders""",
)
def ansi_cast(spark, sf_dir):
    return i.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        F.col("o_orderkey").cast("string").alias("key_text"),
        F.col("o_orderdate").cast("date").alias("order_day"),
    )


@query(
    "try_to_timestamp",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS parsed
FROM events""",
)
def try_to_timestamp(spark, sf_dir):
    """The time of error events is replaced by text that is no time."""
    text = F.when(F.col("event_type") == "error", "nope").otherwise(F.col("ts").cast("string"))
    return i.table(spark, sf_dir, "events").select("event_id", parsed_time(text).alias("parsed"))


@query(
    "format_timestamp",
    """SELECT event_id, strftime(ts, '%Y-%m') AS month, strftime(ts, '%Y-%m-%d') AS day,
 strftime(ts, '%Y-%m-%d %H:00') AS hour, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS plain FROM events""",
)
def format_timestamp(spark, sf_dir):
    moment = F.col("ts")
    return i.table(spark, sf_dir, "events").select(
        "event_id",
        month_text(moment).alias("month"),
        day_text(moment).alias("day"),
        hour_text(moment).alias("hour"),
        time_text(moment).alias("plain"),
    )


@query("to_date", "SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def to_date(spark, sf_dir):
    return i.table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("day"))


@query(
    "datediff_boundary",
    f"""SELECT event_id, date_diff('day', ts, {NOW}) AS days, date_diff('minute', ts, {NOW}) AS minutes
FROM events""",
)
def datediff_boundary(spark, sf_dir):
    return i.table(spark, sf_dir, "events").select(
        "event_id",
        days_between(F.col("ts"), now()).alias("days"),
        minutes_between(F.col("ts"), now()).alias("minutes"),
    )


@query(
    "dateadd",
    """SELECT event_id, ts - INTERVAL 30 DAY AS month_before, ts + INTERVAL 60 MINUTE AS hour_after
FROM events""",
)
def dateadd(spark, sf_dir):
    return i.table(spark, sf_dir, "events").select(
        "event_id",
        shifted(F.col("ts"), days=-30).alias("month_before"),
        shifted(F.col("ts"), minutes=60).alias("hour_after"),
    )


@query(
    "fixed_clock",
    f"""SELECT event_id, {NOW} AS clock_time, {TODAY} AS clock_day, ts <= {NOW} AS is_past
FROM events""",
)
def fixed_clock(spark, sf_dir):
    return i.table(spark, sf_dir, "events").select(
        "event_id",
        now().alias("clock_time"),
        F.to_date(now()).alias("clock_day"),
        (F.col("ts") <= now()).alias("is_past"),
    )


@query(
    "date_minus_interval",
    f"""SELECT event_id, CAST(ts AS DATE) - INTERVAL 7 DAY AS week_before,
 ts >= {TODAY} - INTERVAL 7 DAY AS is_recent FROM events""",
)
def date_minus_interval(spark, sf_dir):
    moment = F.col("ts")
    return i.table(spark, sf_dir, "events").select(
        "event_id",
        shifted(midnight(moment), days=-7).alias("week_before"),
        (moment >= shifted(midnight(now()), days=-7)).alias("is_recent"),
    )


@query(
    "round_half_up",
    f"""SELECT c_custkey, CASE WHEN c_acctbal < 0
  THEN -{i.hu('abs(c_acctbal)', 1)} ELSE {i.hu('abs(c_acctbal)', 1)} END AS tenths,
 CASE WHEN c_acctbal < 0
  THEN -{i.hu('abs(c_acctbal)', 0)} ELSE {i.hu('abs(c_acctbal)', 0)} END AS whole
FROM customer""",
)
def round_half_up(spark, sf_dir):
    balance = F.col("c_acctbal")
    return i.table(spark, sf_dir, "customer").select(
        "c_custkey", half_up(balance, 1).alias("tenths"), half_up(balance, 0).alias("whole")
    )


@query(
    "coalesce_nullif",
    i.over(
        "audit",
        """SELECT log_id, nullif(row_count, 0) AS filled_rows,
 coalesce(nullif(row_count, 0), -1) AS rows_or_minus_one FROM audit""",
    ),
)
def coalesce_nullif(spark, sf_dir):
    filled = F.nullif(F.col("row_count"), F.lit(0))
    return i.audit(spark, sf_dir).select(
        "log_id",
        filled.alias("filled_rows"),
        F.coalesce(filled, F.lit(-1)).cast("bigint").alias("rows_or_minus_one"),
    )


@query(
    "fail_percent",
    i.over(
        "audit",
        f"SELECT log_id, {i.failpct('issue_count', 'row_count')} AS fail_percent FROM audit",
    ),
)
def fail_percent_query(spark, sf_dir):
    pct = fail_percent(F.col("issue_count"), F.col("row_count"))
    return i.audit(spark, sf_dir).select("log_id", pct.alias("fail_percent"))


@query(
    "case_when",
    i.over(
        "audit",
        """SELECT log_id, CASE WHEN status = 'PASS' THEN 0 WHEN issue_count > 100 THEN 2 ELSE 1 END
  AS grade FROM audit""",
    ),
)
def case_when(spark, sf_dir):
    grade = (
        F.when(F.col("status") == "PASS", 0).when(F.col("issue_count") > fv.ALERT_ISSUES, 2)
    ).otherwise(1)
    return i.audit(spark, sf_dir).select("log_id", grade.alias("grade"))


@query(
    "concat_text",
    i.over(
        "audit",
        f"""SELECT log_id, 'NULL check on critical fields: ' || issue_count || ' null records found'
  AS summary, printf('%.1f', {i.hu(i.failpct('issue_count', 'row_count'), 1)}) || '%' AS share
FROM audit""",
    ),
)
def concat_text(spark, sf_dir):
    issues = F.col("issue_count")
    pct = fail_percent(issues, F.col("row_count"))
    return i.audit(spark, sf_dir).select(
        "log_id",
        counted(fv.NULLS_SUMMARY, issues).alias("summary"),
        F.concat(number_text(pct, 1), F.lit("%")).alias("share"),
    )


@query(
    "json_object",
    i.over(
        "readings",
        """SELECT event_id, sensor_id, location_id, location_id IS NOT NULL AS has_location
FROM readings""",
    ),
)
def json_object_query(spark, sf_dir):
    """Objects made and taken apart again; a NULL key is not in the text at all."""
    made = i.readings(spark, sf_dir).select(
        "event_id", json_object(F.col("sensor_id"), F.col("location_id")).alias("text")
    )
    parsed = F.from_json("text", "sensor_id bigint, location_id bigint")
    return made.select(
        "event_id",
        parsed["sensor_id"].alias("sensor_id"),
        parsed["location_id"].alias("location_id"),
        F.array_contains(F.json_object_keys("text"), "location_id").alias("has_location"),
    )


@query(
    "strip_markdown",
    """SELECT doc_id, replace(replace(regexp_replace(text, '#{1,3} ', '', 'g'), '**', ''), '*', '')
  AS text FROM documents""",
)
def strip_markdown_query(spark, sf_dir):
    return i.table(spark, sf_dir, "documents").select(
        "doc_id", strip_markdown(F.col("text")).alias("text")
    )


@query(
    "landing_timestamp_key",
    "SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS stamp FROM events",
)
def landing_timestamp_key(spark, sf_dir):
    return i.table(spark, sf_dir, "events").select("event_id", stamp_text(F.col("ts")).alias("stamp"))


@query(
    "landing_layout",
    """SELECT event_id,
 'landing/nyc_taxi/nyc_taxi_' || strftime(ts, '%Y%m%d_%H%M%S') || '.csv' AS trip_file,
 'landing/openaq/openaq_' || strftime(ts, '%Y%m%d_%H%M%S') || '.json' AS reading_file FROM events""",
)
def landing_layout(spark, sf_dir):
    moment = F.col("ts")
    return i.table(spark, sf_dir, "events").select(
        "event_id",
        landing_path("nyc_taxi", moment, "csv").alias("trip_file"),
        landing_path("openaq", moment, "json").alias("reading_file"),
    )
