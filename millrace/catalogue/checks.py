"""Checks: audit rows, metric rows and violations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.bands import severity
from ..operators import rules
from ..operators.checks import Check, TableChecks, new_run_id, run_checks
from ..operators.schema_check import payload_drift, schema_rule
from ..operators.silver import UNIQUE_KEY, dedup_by_key, quarantine, silver_reconciliation
from ..plans.daily import run_all_checks
from ..schemas import TRIP_CONTRACT, TRIP_NAMES
from . import inputs as i
from .registry import query

RUN = "catalogue-run"
AUDIT_COLUMNS = ["table_name", "check_name", "status", "row_count", "issue_count", "severity"]
METRIC_COLUMNS = [
    "table_name",
    "metric_name",
    "metric_value",
    "threshold",
    "passed",
    "fail_count",
    "total_count",
]

# --- conditions as the SQL twin states them ------------------------------------
NULLS = "(pickup_datetime IS NULL OR dropoff_datetime IS NULL OR passenger_count IS NULL)"
FARE = "(fare_amount <= 0 OR fare_amount >= 500)"
GEO = """(pickup_latitude IS NULL OR pickup_longitude IS NULL OR dropoff_latitude IS NULL
 OR dropoff_longitude IS NULL OR abs(pickup_latitude) > 90 OR abs(dropoff_latitude) > 90
 OR abs(pickup_longitude) > 180 OR abs(dropoff_longitude) > 180)"""
CLOCK = f"TIMESTAMP '{i.READINGS_CLOCK}'"
STALE = f"(reading_time IS NULL OR reading_time < {CLOCK} - INTERVAL 30 DAY)"


def _trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return i.trips(spark, sf_dir)


def _over_trips(spark: SparkSession, sf_dir: str, *checks: Check) -> TableChecks:
    return run_checks(_trips(spark, sf_dir), checks, as_of=i.RESULTS_CLOCK, run_id=RUN)


def _over_readings(spark: SparkSession, sf_dir: str, *checks: Check) -> TableChecks:
    return run_checks(i.readings(spark, sf_dir), checks, as_of=i.READINGS_CLOCK, run_id=RUN)


def _parsed(violations: DataFrame, fields: str) -> DataFrame:
    return violations.select(
        "table_name", "rule_name", F.from_json("violation_details", fields).alias("d")
    ).select("table_name", "rule_name", "d.*")


def _trip_audit_sql(name: str, condition: str, table: str = "trips") -> str:
    return f"""
SELECT 'silver' AS table_name, '{name}' AS check_name,
 CASE WHEN bad > 0 THEN 'FAIL' ELSE 'PASS' END AS status, n AS row_count, bad AS issue_count,
 CASE WHEN bad > 0 THEN 'MEDIUM' ELSE 'LOW' END AS severity
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE {condition}) AS bad FROM {table}) {name}"""


def _trip_metric_sql(rule: str, condition: str) -> str:
    return f"""
SELECT 'silver' AS table_name, '{rule}' AS metric_name, {i.failpct('bad', 'n')} AS metric_value,
 CAST(0 AS DOUBLE) AS threshold, bad = 0 AS passed, bad AS fail_count, n AS total_count
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE {condition}) AS bad FROM trips) {rule}"""


def _reading_audit_sql(name: str, pool: str, condition: str, limit: int) -> str:
    return f"""
SELECT 'OPENAQ_FLATTENED' AS table_name, '{name}' AS check_name,
 CASE WHEN {i.failpct('bad', 'n')} > {limit} THEN 'FAIL' ELSE 'PASS' END AS status,
 n AS row_count, bad AS issue_count, CASE WHEN bad > 0 THEN 'MEDIUM' ELSE 'LOW' END AS severity
FROM (SELECT count(*) FILTER (WHERE {pool}) AS n, count(*) FILTER (WHERE {condition}) AS bad
 FROM readings) {name}"""


TRIP_SQL = {
    "check_nulls": ("NON_NULL", "RULE_NON_NULL", NULLS),
    "check_range": ("NUM_RANGE", "RULE_FARE_RANGE", FARE),
    "check_geo_bounds": ("GEO_BOUNDS", "RULE_GEO_VERIFY", GEO),
}
TRIP_RULES = {
    "check_nulls": rules.null_rule,
    "check_range": rules.range_rule,
    "check_geo_bounds": rules.geo_rule,
}
VIOLATION_FIELDS = {
    "check_nulls": (
        "null_count bigint, pickup_datetime string, dropoff_datetime string, "
        "passenger_count bigint"
    ),
    "check_range": "fare_amount double",
    "check_geo_bounds": (
        "pickup_latitude double, pickup_longitude double, dropoff_latitude double, "
        "dropoff_longitude double"
    ),
    "check_openaq_nulls": "location_id bigint, sensor_id bigint, issue string",
    "check_freshness": (
        "location_id bigint, sensor_id bigint, reading_time string, days_stale bigint, "
        "issue string"
    ),
    "check_threshold": (
        "location_id bigint, sensor_id bigint, pm25_value double, who_category string, "
        "reading_time string, issue string"
    ),
}
_TEXT = "'%Y-%m-%d %H:%M:%S.%g'"
VIOLATION_SQL = {
    "check_nulls": f"""SELECT 'silver' AS table_name, 'RULE_NON_NULL' AS rule_name,
 (SELECT count(*) FROM trips WHERE {NULLS}) AS null_count,
 strftime(pickup_datetime, {_TEXT}) AS pickup_datetime,
 strftime(dropoff_datetime, {_TEXT}) AS dropoff_datetime, passenger_count
FROM trips WHERE {NULLS}""",
    "check_range": f"""SELECT 'silver' AS table_name, 'RULE_FARE_RANGE' AS rule_name,
 CAST(fare_amount AS DOUBLE) AS fare_amount FROM trips WHERE {FARE}""",
    "check_geo_bounds": f"""SELECT 'silver' AS table_name, 'RULE_GEO_VERIFY' AS rule_name,
 pickup_latitude, pickup_longitude, dropoff_latitude, dropoff_longitude
FROM trips WHERE {GEO}""",
    "check_openaq_nulls": """SELECT 'OPENAQ_FLATTENED' AS table_name,
 'null_pm25_check' AS rule_name, location_id, sensor_id, 'pm25_value is null' AS issue
FROM readings WHERE pm25_value IS NULL""",
    "check_freshness": f"""SELECT 'OPENAQ_FLATTENED' AS table_name,
 'freshness_check' AS rule_name, location_id, sensor_id,
 strftime(reading_time, {_TEXT}) AS reading_time,
 date_diff('day', CAST(reading_time AS DATE), CAST({CLOCK} AS DATE)) AS days_stale,
 'reading older than 30 days' AS issue
FROM readings WHERE {STALE}""",
    "check_threshold": f"""SELECT 'OPENAQ_FLATTENED' AS table_name,
 'who_threshold_check' AS rule_name, location_id, sensor_id, pm25_value, who_category,
 strftime(reading_time, {_TEXT}) AS reading_time,
 'PM2.5 exceeds WHO threshold of 15' AS issue
FROM readings WHERE pm25_value > 15""",
}

READING_RULES = {
    "check_openaq_nulls": rules.reading_null_rule,
    "check_freshness": lambda: rules.freshness_rule(i.READINGS_CLOCK),
    "check_threshold": rules.threshold_rule,
}
READING_AUDIT_SQL = {
    "check_openaq_nulls": _reading_audit_sql(
        "check_openaq_nulls", "true", "pm25_value IS NULL", 30
    ),
    "check_freshness": _reading_audit_sql("check_openaq_freshness", "true", STALE, 50),
    "check_threshold": _reading_audit_sql(
        "check_openaq_who_threshold", "pm25_value IS NOT NULL", "pm25_value > 15", 50
    ),
}
_R = "SELECT 'OPENAQ_FLATTENED' AS table_name"
READING_METRIC_SQL = {
    "check_openaq_nulls": f"""
, c AS (SELECT count(*) AS n, count(*) FILTER (WHERE pm25_value IS NULL) AS v,
 count(*) FILTER (WHERE location_id IS NULL) AS l, count(*) FILTER (WHERE sensor_id IS NULL) AS s
 FROM readings)
{_R}, 'null_pm25_pct' AS metric_name, {i.hu(i.failpct('v', 'n'), 2)} AS metric_value,
 CAST(30 AS DOUBLE) AS threshold, {i.failpct('v', 'n')} <= 30 AS passed,
 v AS fail_count, n AS total_count FROM c
UNION ALL {_R}, 'null_location_pct', {i.hu(i.failpct('l', 'n'), 2)}, 5, l = 0, l, n FROM c
UNION ALL {_R}, 'null_sensor_pct', {i.hu(i.failpct('s', 'n'), 2)}, 5, s = 0, s, n FROM c""",
    "check_freshness": f"""
, c AS (SELECT count(*) AS n, count(*) FILTER (WHERE {STALE}) AS o,
 count(*) FILTER (WHERE reading_time >= {CLOCK} - INTERVAL 30 DAY) AS f,
 count(*) FILTER (WHERE reading_time IS NULL) AS u FROM readings)
{_R}, 'stale_reading_pct' AS metric_name, {i.hu(i.failpct('o', 'n'), 2)} AS metric_value,
 CAST(50 AS DOUBLE) AS threshold, {i.failpct('o', 'n')} <= 50 AS passed,
 o AS fail_count, n AS total_count FROM c
UNION ALL {_R}, 'fresh_sensor_count', CAST(f AS DOUBLE), 1, f >= 1, NULL, NULL FROM c
UNION ALL {_R}, 'null_reading_time', CAST(u AS DOUBLE), 0, u = 0, NULL, NULL FROM c""",
    "check_threshold": f"""
, c AS (SELECT count(pm25_value) AS n, count(*) FILTER (WHERE pm25_value > 15) AS a,
 count(*) FILTER (WHERE pm25_value > 250) AS h, {i.hu(i.exact('pm25_value'), 2)} AS m
 FROM readings)
{_R}, 'who_breach_pct' AS metric_name, {i.hu(i.failpct('a', 'n'), 2)} AS metric_value,
 CAST(80 AS DOUBLE) AS threshold, {i.failpct('a', 'n')} <= 80 AS passed,
 a AS fail_count, n AS total_count FROM c
UNION ALL {_R}, 'hazardous_count', CAST(h AS DOUBLE), 0, h = 0, NULL, NULL FROM c
UNION ALL {_R}, 'avg_pm25_ug_m3', m, 15, m <= 15, NULL, NULL FROM c""",
}


def _register_check(name: str, runner, make, view: str, audit: str, metric: str) -> None:
    @query(name, i.over(view, audit))
    def audit_row(spark, sf_dir):
        return runner(spark, sf_dir, make()).audit.select(*AUDIT_COLUMNS)

    @query(f"{name}_metrics", i.over(view, metric))
    def metric_rows(spark, sf_dir):
        return runner(spark, sf_dir, make()).metrics.select(*METRIC_COLUMNS)

    @query(f"{name}_violations", i.over(view, VIOLATION_SQL[name]))
    def violation_rows(spark, sf_dir):
        return _parsed(runner(spark, sf_dir, make()).violations, VIOLATION_FIELDS[name])


for _name, (_check, _rule, _condition) in TRIP_SQL.items():
    _register_check(
        _name,
        _over_trips,
        TRIP_RULES[_name],
        "trips",
        _trip_audit_sql(_check, _condition),
        _trip_metric_sql(_rule, _condition),
    )
for _name, _make in READING_RULES.items():
    _register_check(
        _name,
        _over_readings,
        _make,
        "readings",
        READING_AUDIT_SQL[_name],
        READING_METRIC_SQL[_name],
    )


_SCHEMA_AUDIT_SQL = """
SELECT 'silver' AS table_name, 'SCHEMA' AS check_name, 'PASS' AS status, count(*) AS row_count,
 CAST(0 AS BIGINT) AS issue_count, 'LOW' AS severity FROM trips"""


@query("check_schema", i.over("trips", _SCHEMA_AUDIT_SQL))
def check_schema(spark, sf_dir):
    trips = _trips(spark, sf_dir)
    return _over_trips(
        spark, sf_dir, schema_rule(trips, TRIP_CONTRACT, table="silver", mode="contract")
    ).audit.select(*AUDIT_COLUMNS)


@query(
    "check_payload_drift",
    i.over(
        "trips",
        """
, p AS (SELECT *, payment_type = 'DISPUTE' AS dispute, store_and_fwd_flag = 'Y' AND
 payment_type = 'CARD' AS text_fare FROM trips)
SELECT * FROM (
 SELECT 'surge_fee' AS column_name, 'unexpected' AS finding,
  count(*) FILTER (WHERE dispute) AS payloads FROM p
 UNION ALL SELECT 'rate_code', 'missing', count(*) FILTER (WHERE dispute) FROM p
 UNION ALL SELECT 'fare_amount', 'mismatch', count(*) FILTER (WHERE text_fare) FROM p
 UNION ALL SELECT 'fare_amount', 'missing',
  count(*) FILTER (WHERE NOT text_fare AND fare_amount IS NULL) FROM p
 UNION ALL SELECT 'pickup_datetime', 'missing', count(*) - count(pickup_datetime) FROM p
 UNION ALL SELECT 'dropoff_datetime', 'missing', count(*) - count(dropoff_datetime) FROM p
 UNION ALL SELECT 'passenger_count', 'missing', count(*) - count(passenger_count) FROM p
 UNION ALL SELECT 'pickup_longitude', 'missing', count(*) - count(pickup_longitude) FROM p
) f WHERE payloads > 0""",
    ),
)
def check_payload_drift(spark, sf_dir):
    """Payloads with planted drift: disputes lost a key and gained one, some fares are
    text. Keys with a NULL value are absent from the payload."""
    dispute = F.col("payment_type") == "DISPUTE"
    text_fare = (F.col("store_and_fwd_flag") == "Y") & (F.col("payment_type") == "CARD")
    changed = {
        "rate_code": F.when(~dispute, F.col("rate_code")),
        "fare_amount": F.when(text_fare, "n/a").otherwise(F.col("fare_amount").cast("string")),
    }
    keys = [changed[n].alias(n) if n in changed else F.col(n) for n in TRIP_NAMES]
    keys.append(F.when(dispute, F.lit(1)).alias("surge_fee"))
    docs = _trips(spark, sf_dir).select(F.parse_json(F.to_json(F.struct(*keys))).alias("raw_data"))
    return payload_drift(docs, "raw_data", TRIP_CONTRACT)


@query(
    "check_unique",
    i.over(
        "silver",
        """
SELECT 'silver' AS table_name, 'UNIQUE' AS check_name,
 CASE WHEN sum(n - 1) > 0 THEN 'FAIL' ELSE 'PASS' END AS status,
 CAST(sum(n) AS BIGINT) AS row_count, CAST(sum(n - 1) AS BIGINT) AS issue_count,
 CASE WHEN sum(n - 1) > 0 THEN 'MEDIUM' ELSE 'LOW' END AS severity
FROM (SELECT count(*) AS n FROM silver GROUP BY pickup_datetime, dropoff_datetime) g""",
    ),
)
def check_unique(spark, sf_dir):
    keys = rules.key_counts(i.silver(spark, sf_dir), UNIQUE_KEY)
    run = run_checks(keys, [rules.unique_rule(UNIQUE_KEY)], as_of=i.RESULTS_CLOCK, run_id=RUN)
    return run.audit.select(*AUDIT_COLUMNS)


_BY_TOTAL = ["total_amount", "fare_amount", "trip_distance"]
_RANKED = """
SELECT pickup_datetime, dropoff_datetime, CAST(total_amount AS DOUBLE) AS total_amount
FROM (SELECT *, row_number() OVER (PARTITION BY pickup_datetime, dropoff_datetime
 ORDER BY total_amount, fare_amount, trip_distance) AS rn FROM silver) r WHERE rn {keep}"""


@query("check_unique_violations", i.over("silver", _RANKED.format(keep="> 1")))
def check_unique_violations(spark, sf_dir):
    surplus = quarantine(
        i.silver(spark, sf_dir, lineage=True), UNIQUE_KEY, [*_BY_TOTAL, "__source_file", "__row_num"]
    )
    return surplus.select(*UNIQUE_KEY, "total_amount")


@query("silver_dedup_by_key", i.over("silver", _RANKED.format(keep="= 1")))
def silver_dedup_by_key(spark, sf_dir):
    kept = dedup_by_key(i.silver(spark, sf_dir), UNIQUE_KEY, _BY_TOTAL)
    return kept.select(*UNIQUE_KEY, "total_amount")


def _all_checks(spark, sf_dir):
    return run_all_checks(
        _trips(spark, sf_dir), i.readings(spark, sf_dir), as_of=i.READINGS_CLOCK, run_id=RUN
    )


_ALL_AUDIT = "\nUNION ALL ".join(
    [_trip_audit_sql(c, cond) for c, _, cond in TRIP_SQL.values()]
    + [_SCHEMA_AUDIT_SQL]
    + list(READING_AUDIT_SQL.values())
)


@query("run_all_checks", i.over("trips readings", _ALL_AUDIT))
def all_checks(spark, sf_dir):
    run = _all_checks(spark, sf_dir)
    return run.trips.audit.unionByName(run.readings.audit).select(*AUDIT_COLUMNS)


@query(
    "check_status_message",
    i.over(
        "trips readings",
        f"""
, t AS (SELECT count(*) FILTER (WHERE {NULLS}) AS n, count(*) FILTER (WHERE {FARE}) AS f,
 count(*) FILTER (WHERE {GEO}) AS g FROM trips),
 r AS (SELECT count(*) AS n, count(pm25_value) AS w,
 count(*) FILTER (WHERE pm25_value IS NULL) AS v, count(*) FILTER (WHERE {STALE}) AS o,
 count(*) FILTER (WHERE pm25_value > 15) AS a, count(*) FILTER (WHERE pm25_value > 250) AS h,
 {i.hu(i.exact('pm25_value'), 2)} AS m FROM readings)
SELECT 'NON_NULL' AS check_name,
 concat('Rule 2 check complete: ', n, ' NULL records found') AS message FROM t
UNION ALL SELECT 'NUM_RANGE',
 concat('Rule 3 check complete: ', f, ' out-of-range records found') FROM t
UNION ALL SELECT 'SCHEMA', 'Rule 4 check complete: 0 unexpected columns found'
UNION ALL SELECT 'GEO_BOUNDS',
 concat('Rule 5 check complete. ', g, ' invalid geographic coordinates found') FROM t
UNION ALL SELECT 'check_openaq_nulls', concat('check_openaq_nulls: ',
 CASE WHEN {i.failpct('v', 'n')} > 30 THEN 'FAIL' ELSE 'PASS' END, ' | null_pm25=', v, '/', n,
 ' (', printf('%.1f', {i.hu(i.failpct('v', 'n'), 1)}), '%)') FROM r
UNION ALL SELECT 'check_openaq_freshness', concat('check_openaq_freshness: ',
 CASE WHEN {i.failpct('o', 'n')} > 50 THEN 'FAIL' ELSE 'PASS' END, ' | stale=', o, '/', n,
 ' (', printf('%.1f', {i.hu(i.failpct('o', 'n'), 1)}), '%)') FROM r
UNION ALL SELECT 'check_openaq_who_threshold', concat('check_openaq_who_threshold: ',
 CASE WHEN {i.failpct('a', 'w')} > 50 THEN 'FAIL' ELSE 'PASS' END, ' | above_who=', a, '/', w,
 ' (', printf('%.1f', {i.hu(i.failpct('a', 'w'), 1)}), '%) | hazardous=', h,
 ' | avg_pm25=', printf('%.2f', m)) FROM r""",
    ),
)
def check_status_message(spark, sf_dir):
    run = _all_checks(spark, sf_dir)
    return run.trips.messages.unionByName(run.readings.messages)


@query(
    "severity_rule",
    i.over(
        "audit",
        """SELECT log_id, CASE WHEN issue_count > 0 THEN 'MEDIUM' ELSE 'LOW' END AS row_severity,
 CASE WHEN issue_count > 0 THEN 'HIGH' ELSE 'LOW' END AS schema_severity FROM audit""",
    ),
)
def severity_rule(spark, sf_dir):
    issues = F.col("issue_count")
    return i.audit(spark, sf_dir).select(
        "log_id",
        severity(issues).alias("row_severity"),
        severity(issues, "HIGH").alias("schema_severity"),
    )


@query(
    "violation_rows",
    i.over(
        "trips readings",
        f"""
SELECT 'silver' AS table_name, 'RULE_NON_NULL' AS rule_name, CAST(NULL AS DOUBLE) AS fare_amount,
 CAST(NULL AS DOUBLE) AS pickup_longitude, CAST(NULL AS BIGINT) AS sensor_id,
 CAST(NULL AS VARCHAR) AS issue FROM trips WHERE {NULLS}
UNION ALL SELECT 'silver', 'RULE_FARE_RANGE', CAST(fare_amount AS DOUBLE), NULL, NULL, NULL
 FROM trips WHERE {FARE}
UNION ALL SELECT 'silver', 'RULE_GEO_VERIFY', NULL, pickup_longitude, NULL, NULL
 FROM trips WHERE {GEO}
UNION ALL SELECT 'OPENAQ_FLATTENED', 'null_pm25_check', NULL, NULL, sensor_id,
 'pm25_value is null' FROM readings WHERE pm25_value IS NULL
UNION ALL SELECT 'OPENAQ_FLATTENED', 'freshness_check', NULL, NULL, sensor_id,
 'reading older than 30 days' FROM readings WHERE {STALE}
UNION ALL SELECT 'OPENAQ_FLATTENED', 'who_threshold_check', NULL, NULL, sensor_id,
 'PM2.5 exceeds WHO threshold of 15' FROM readings WHERE pm25_value > 15""",
    ),
)
def violation_rows(spark, sf_dir):
    run = _all_checks(spark, sf_dir)
    return _parsed(
        run.trips.violations.unionByName(run.readings.violations),
        "fare_amount double, pickup_longitude double, sensor_id bigint, issue string",
    )


@query(
    "silver_reconciliation",
    i.over(
        "trips",
        f"""
SELECT CASE WHEN {NULLS} THEN 'RULE_NON_NULL' WHEN {FARE} THEN 'RULE_FARE_RANGE'
 WHEN fare_amount IS NULL THEN 'FARE_MISSING' WHEN {GEO} THEN 'RULE_GEO_VERIFY'
 ELSE 'SILVER' END AS outcome, count(*) AS row_count
FROM trips GROUP BY 1""",
    ),
)
def reconciliation(spark, sf_dir):
    return silver_reconciliation(_trips(spark, sf_dir))


@query(
    "run_uuid",
    i.over("trips", f"SELECT true AS is_uuid, count(*) AS violations FROM trips WHERE {FARE}"),
)
def run_uuid(spark, sf_dir):
    """A fresh run id: every violation of the run carries the same one."""
    run = run_checks(
        _trips(spark, sf_dir), [rules.range_rule()], as_of=i.RESULTS_CLOCK, run_id=new_run_id()
    )
    shape = "^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"
    return (
        run.violations.groupBy(F.col("run_id").rlike(shape).alias("is_uuid"), "run_id")
        .agg(F.count(F.lit(1)).alias("violations"))
        .drop("run_id")
    )


