"""Observability views, alerts and unions over the result tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.checks import run_checks
from ..operators.rules import freshness_rule
from ..plans import alerts, observability
from ..session import scratch_path
from . import inputs as i
from .checks import CLOCK as READINGS_NOW
from .checks import READING_METRIC_SQL
from .files import PUBLISHED, kpi_frames, published_text, target_rows, with_text
from .registry import query

_QUIET_CLOCK = "2030-01-01 00:00:00"  # nothing fails in the hour before
NOW = f"TIMESTAMP '{i.RESULTS_CLOCK}'"
TODAY = f"DATE '{i.RESULTS_DAY}'"
RECENT = f"run_timestamp >= {TODAY} - INTERVAL 7 DAY AND run_timestamp <= {NOW}"
PASSED = "count(*) FILTER (WHERE passed)"
FAILED = "count(*) FILTER (WHERE NOT passed)"


@query(
    "dq_health_score",
    i.over(
        "metrics",
        f"""SELECT strftime(run_timestamp, '%Y-%m-%d') AS metric_date, run_timestamp, table_name,
 metric_name, count(*) AS total_checks, {PASSED} AS passed_checks, {FAILED} AS failed_checks,
 {i.share(PASSED, 'count(*)')} AS aggregate_dq_score,
 {i.hu(i.share(FAILED, 'count(*)'), 2)} AS fail_percent
FROM metrics GROUP BY run_timestamp, table_name, metric_name""",
    ),
)
def dq_health_score(spark, sf_dir):
    return observability.health_score(i.metrics(spark, sf_dir))


@query(
    "dq_violations_by_type",
    i.over(
        "audit",
        """SELECT check_name, 'FAIL' AS severity, count(*) AS violation_count,
 CAST(sum(issue_count) AS BIGINT) AS total_failed_records, max(run_timestamp) AS last_violation
FROM audit WHERE status = 'FAIL' GROUP BY check_name""",
    ),
)
def dq_violations_by_type(spark, sf_dir):
    return observability.violations_by_type(i.audit(spark, sf_dir))


@query(
    "dq_gold_matrix",
    i.over(
        "metrics",
        f"""SELECT 'DQ Score' AS metric_category, p / nullif(CAST(n AS DOUBLE), 0) AS pass_rate,
 CAST(1 AS DOUBLE) - p / nullif(CAST(n AS DOUBLE), 0) AS fail_rate, n AS total_rules
FROM (SELECT count(*) AS n, CAST({PASSED} AS DOUBLE) AS p FROM metrics WHERE {RECENT}) w""",
    ),
)
def dq_gold_matrix(spark, sf_dir):
    return observability.gold_matrix(i.metrics(spark, sf_dir), i.RESULTS_CLOCK)


TREND = f"""SELECT strftime(run_timestamp, '%Y-%m-%d %H:00') AS time_bucket, table_name,
 metric_name, count(*) AS total_checks, {PASSED} AS pass_count, {FAILED} AS fail_count,
 {i.hu(i.share(FAILED, 'count(*)'), 2)} AS avg_fail_percent"""


@query(
    "dq_trend_7d",
    i.over(
        "metrics",
        f"{TREND} FROM metrics WHERE {RECENT} GROUP BY time_bucket, table_name, metric_name",
    ),
)
def dq_trend_7d(spark, sf_dir):
    return observability.trend(i.metrics(spark, sf_dir), i.RESULTS_CLOCK)


@query(
    "dq_scorecard_today",
    i.over(
        "metrics",
        f"""SELECT count(*) AS total_checks, {PASSED} AS passed_checks, {FAILED} AS failed_checks,
 {i.share(PASSED, 'count(*)')} AS health_score
FROM metrics WHERE run_timestamp BETWEEN {TODAY} AND {NOW}""",
    ),
)
def dq_scorecard_today(spark, sf_dir):
    return observability.scorecard_today(i.metrics(spark, sf_dir), i.RESULTS_CLOCK)


@query(
    "dq_daily_pass_fail",
    i.over(
        "metrics",
        f"""SELECT CAST(run_timestamp AS DATE) AS run_date, {PASSED} AS pass_count,
 {FAILED} AS failed_count FROM metrics WHERE {RECENT} GROUP BY run_date""",
    ),
)
def dq_daily_pass_fail(spark, sf_dir):
    return observability.daily_pass_fail(i.metrics(spark, sf_dir), i.RESULTS_CLOCK)


@query(
    "recent_metrics",
    i.over("metrics", f"SELECT * FROM metrics WHERE {RECENT} ORDER BY run_timestamp DESC"),
)
def recent_metrics(spark, sf_dir):
    return observability.recent_metrics(i.metrics(spark, sf_dir), i.RESULTS_CLOCK)


@query(
    "recent_audit_100",
    i.over("audit", "SELECT * FROM audit ORDER BY run_timestamp DESC, log_id DESC LIMIT 100"),
)
def recent_audit_100(spark, sf_dir):
    return observability.recent_audit(i.audit(spark, sf_dir))


@query(
    "dq_health_rows",
    i.over(
        "audit",
        f"""SELECT CAST(run_timestamp AS DATE) AS check_date, check_name, status, row_count,
 issue_count, {i.hu(i.share('issue_count', 'row_count'), 2)} AS issue_pct,
 CASE WHEN status = 'PASS' THEN '🟢 PASS' WHEN status = 'FAIL' AND issue_count > 100
  THEN '🔴 CRITICAL' ELSE '🟡 WARNING' END AS health_label, run_timestamp
FROM audit WHERE table_name IN ('silver', 'bronze', 'nyc_taxi')""",
    ),
)
def dq_health_rows(spark, sf_dir):
    return observability.health_rows(i.audit(spark, sf_dir))


_ABOVE = i.hu(i.share("count(*) FILTER (WHERE pm25_value > 15)", "count(pm25_value)"), 1)


def _summary_sql(dataset: str) -> str:
    passed = "count(*) FILTER (WHERE status = 'PASS')"
    return f"""SELECT {dataset} AS dataset, count(*) AS total_checks, {passed} AS passed,
 count(*) FILTER (WHERE status = 'FAIL') AS failed,
 {i.hu(i.share(passed, 'count(*)'), 1)} AS pass_rate_pct, max(run_timestamp) AS last_run_ts,
 date_diff('minute', max(run_timestamp), {READINGS_NOW}) AS minutes_since_last_run
FROM audit GROUP BY ALL
UNION ALL SELECT 'OPENAQ', 1, CASE WHEN above < 50 THEN 1 ELSE 0 END,
 CASE WHEN above >= 50 THEN 1 ELSE 0 END, {i.hu('CAST(100 AS DOUBLE) - above', 1)},
 {READINGS_NOW}, 0 FROM (SELECT {_ABOVE} AS above FROM readings) w"""


@query("dataset_health_summary", i.over("audit readings", _summary_sql("'NYC_TAXI'")))
def dataset_health_summary(spark, sf_dir):
    return observability.health_summary(
        i.audit(spark, sf_dir), i.readings(spark, sf_dir), i.READINGS_CLOCK
    )


@query(
    "union_all_health",
    i.over(
        "audit readings",
        _summary_sql(
            "CASE WHEN table_name = 'OPENAQ_FLATTENED' THEN 'OPENAQ' ELSE 'NYC_TAXI' END"
        ),
    ),
)
def union_all_health(spark, sf_dir):
    return observability.health_summary(
        i.audit(spark, sf_dir), i.readings(spark, sf_dir), i.READINGS_CLOCK, per_dataset=True
    )


@query("metrics_union", i.over("readings", READING_METRIC_SQL["check_freshness"]))
def metrics_union(spark, sf_dir):
    """Three metric rows out of one aggregate row, without another scan."""
    run = run_checks(
        i.readings(spark, sf_dir), [freshness_rule(i.READINGS_CLOCK)], as_of=i.READINGS_CLOCK, run_id="union"
    )
    return run.metrics.select(
        "table_name",
        "metric_name",
        "metric_value",
        "threshold",
        "passed",
        "fail_count",
        "total_count",
    )


# --- alerts ----------------------------------------------------------------------

_FAILURES = f"""SELECT log_id, table_name, check_name, status, row_count, issue_count, run_timestamp
FROM audit WHERE status = 'FAIL' AND issue_count > 100
 AND run_timestamp BETWEEN {NOW} - INTERVAL 60 MINUTE AND {NOW}"""


@query(
    "alert_query",
    i.over("audit", f"{_FAILURES} ORDER BY run_timestamp DESC, log_id DESC"),
)
def alert_query(spark, sf_dir):
    return alerts.newest_first(alerts.recent_failures(i.audit(spark, sf_dir), i.RESULTS_CLOCK))


_LINE = (
    "'• [' || table_name || '] ' || check_name || ' — ' || issue_count || ' issues / ' "
    "|| row_count || ' rows'"
)


@query(
    "alert_message",
    i.over(
        "audit",
        f""", f AS ({_FAILURES}),
 placed AS (SELECT *, (row_number() OVER (ORDER BY run_timestamp DESC, log_id DESC) - 1)
   // {alerts.LINES_PER_PART} AS part, count(*) OVER () AS failures FROM f)
SELECT part, failures, '🔴 DQ ALERT — ' || failures || ' FAIL(s) detected' AS subject,
 failures || ' critical failure(s):' || chr(10) || chr(10)
  || string_agg({_LINE}, chr(10) ORDER BY run_timestamp DESC, log_id DESC) AS message
FROM placed GROUP BY part, failures""",
    ),
)
def alert_message(spark, sf_dir):
    return alerts.alert_messages(
        alerts.recent_failures(i.audit(spark, sf_dir), i.RESULTS_CLOCK)
    )


@query(
    "join_lines",
    i.over(
        "audit",
        f"""SELECT log_id // 500 AS block,
 string_agg({_LINE}, chr(10) ORDER BY run_timestamp DESC, log_id DESC) AS lines
FROM audit WHERE status = 'FAIL' GROUP BY block""",
    ),
)
def join_lines(spark, sf_dir):
    """All failures as texts, one text per block of 500 log ids."""
    failed = i.audit(spark, sf_dir).where(F.col("status") == "FAIL")
    blocks = failed.withColumn("block", F.floor(F.col("log_id") / 500))
    return alerts.join_lines(blocks, ["block"])


@query(
    "alert_branch",
    i.over(
        "audit silver readings",
        f""", f AS ({_FAILURES}), total AS (SELECT count(*) AS n FROM f)
SELECT '{i.RESULTS_CLOCK}' AS run, 'alert' AS branch, NULL AS target, NULL AS row_count,
 '🔴 DQ ALERT — ' || n || ' FAIL(s) detected' AS subject, NULL AS message
FROM total, range(CAST(ceil(n / {alerts.LINES_PER_PART}) AS BIGINT)) WHERE n > 0
UNION ALL SELECT run, 'publish', target, row_count, {published_text("run")}
FROM ({PUBLISHED}) t, (SELECT '{_QUIET_CLOCK}' AS run
 UNION ALL SELECT '{i.RESULTS_CLOCK}' FROM total WHERE n = 0) r""",
    ),
)
def alert_branch(spark, sf_dir):
    """A run with recent failures sends the alert and publishes nothing; one without publishes
    the three targets in one commit and sends the message."""
    root, out = scratch_path(spark, "branch"), []
    for clock_text in (i.RESULTS_CLOCK, _QUIET_CLOCK):
        sent = alerts.alert_or_publish(
            i.audit(spark, sf_dir),
            clock_text,
            lambda at=clock_text: kpi_frames(spark, sf_dir, at),
            f"{root}/{clock_text[:4]}",
        )
        if sent.published:
            rows = with_text(target_rows(sent.published), sent.messages)
        else:  # the text itself is in alert_message
            rows = sent.messages.selectExpr(
                "NULL AS target", "NULL AS row_count", "subject", "NULL AS message"
            )
        out.append(rows.select(F.lit(clock_text).alias("run"), F.lit(sent.branch).alias("branch"), "*"))
    first, second = out
    kinds = dict(second.dtypes)
    return second.unionByName(first.select(*(F.col(c).cast(kinds[c]).alias(c) for c in kinds)))

