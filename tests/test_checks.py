"""Checks: edges, invariants, plan shape."""

import json
import os
import random
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.catalogue import inputs
from millrace.operators import rules
from millrace.operators.checks import run_checks
from millrace.operators.schema_check import compare_schema, payload_drift, payload_schema, schema_rule
from millrace.plans.daily import reading_checks, run_all_checks, trip_checks
from millrace.schemas import AUDIT, METRICS, VIOLATIONS, column_names

SF = "/root/testdata/sf0.001"
CLOCK = "2024-02-10 00:00:00"
READING = "location_id bigint, sensor_id bigint, pm25_value double, reading_time timestamp_ntz"


def result(frame, checks, **extra):
    return run_checks(frame, checks, as_of=CLOCK, run_id="r", **extra)


def test_empty_input(spark):
    empty = spark.createDataFrame([], READING)
    run = result(empty, reading_checks(CLOCK))
    assert [r.status for r in run.audit.collect()] == ["PASS"] * 3
    metrics = {r.metric_name: r for r in run.metrics.collect()}
    assert metrics["null_pm25_pct"].metric_value == 0.0 and metrics["null_pm25_pct"].passed
    assert metrics["avg_pm25_ug_m3"].metric_value is None
    assert metrics["avg_pm25_ug_m3"].passed is None
    assert metrics["fresh_sensor_count"].passed is False
    assert run.violations.count() == 0


def test_freshness_edge(spark):
    rows = spark.sql(
        "SELECT 1L location_id, 1L sensor_id, 1D pm25_value, t AS reading_time FROM VALUES "
        "(TIMESTAMP_NTZ '2024-01-11 00:00:00'), (TIMESTAMP_NTZ '2024-01-10 23:59:59.999999'), "
        "(CAST(NULL AS TIMESTAMP_NTZ)) AS v(t)"
    )
    run = result(rows, [rules.freshness_rule(CLOCK)])
    assert run.audit.collect()[0].issue_count == 2
    details = [json.loads(r.violation_details) for r in run.violations.collect()]
    assert sorted(len(d) for d in details) == [3, 5]  # no time: two keys are left out


def test_tolerances_of_the_threshold_check_differ(spark):
    rows = spark.sql(
        "SELECT 1L location_id, 1L sensor_id, IF(id < 6, 20D, 10D) pm25_value, "
        "TIMESTAMP_NTZ '2024-02-01 00:00:00' reading_time FROM range(10)"
    )
    run = result(rows, [rules.threshold_rule()])
    assert run.audit.collect()[0].status == "FAIL"
    assert {r.metric_name: r.passed for r in run.metrics.collect()}["who_breach_pct"] is True


def test_result_schemas_and_invariants(spark):
    run = run_all_checks(
        inputs.trips(spark, SF), inputs.readings(spark, SF), as_of=CLOCK, run_id="x"
    ).pinned()
    out = run.result
    assert out.audit.columns == column_names(AUDIT)
    assert out.metrics.columns == column_names(METRICS)
    assert out.violations.columns == column_names(VIOLATIONS)
    audit = {r.check_name: r for r in out.audit.collect()}
    assert len({r.log_id for r in audit.values()}) == 7
    metrics = out.metrics.collect()
    assert len({m.metric_id for m in metrics}) == len(metrics) == 13
    found = {r.rule_name: r["count"] for r in out.violations.groupBy("rule_name").count().collect()}
    pairs = {
        "RULE_NON_NULL": "NON_NULL",
        "RULE_FARE_RANGE": "NUM_RANGE",
        "RULE_GEO_VERIFY": "GEO_BOUNDS",
        "null_pm25_check": "check_openaq_nulls",
        "freshness_check": "check_openaq_freshness",
        "who_threshold_check": "check_openaq_who_threshold",
    }
    for rule, check in pairs.items():
        assert found[rule] == audit[check].issue_count
    assert all(r.issue_count <= r.row_count for r in audit.values())


def test_pinned_equals_lazy(spark):
    trips = inputs.trips(spark, SF)
    lazy = result(trips, trip_checks(trips))
    assert lazy.audit.collect() == lazy.pinned().audit.collect()
    assert sorted(lazy.violations.collect()) == sorted(lazy.pinned().violations.collect())


def test_one_aggregate_for_all_checks_of_a_table(spark):
    trips = inputs.trips(spark, SF)
    plan = result(trips, trip_checks(trips)).audit._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange") == 1  # one row per task


def test_violations_scan_once(spark):
    trips = inputs.trips(spark, SF)
    run = result(trips, [rules.range_rule(), rules.geo_rule()])
    plan = run.violations._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_pinned_audit_reads_nothing(spark):
    trips = inputs.trips(spark, SF)
    run = result(trips, trip_checks(trips)).pinned()
    assert "FileScan" not in run.audit._jdf.queryExecution().executedPlan().toString()


def test_same_counter_with_two_meanings_is_refused(spark):
    one = rules.range_rule(high=500)
    two = rules.range_rule(high=900)
    with pytest.raises(ValueError):
        result(inputs.trips(spark, SF), [one, two]).counts


def test_own_rule(spark):
    rule = rules.row_rule(
        "TIP",
        "RULE_TIP",
        F.col("tip_amount") > 9,
        table="silver",
        fields=lambda: [F.col("tip_amount")],
        summary="tips: {n}",
        message="tips checked: {n}",
        counter="big_tips",
    )
    trips = inputs.trips(spark, SF)
    run = result(trips, [rule])
    want = trips.where("tip_amount > 9").count()
    assert run.audit.collect()[0].summary == f"tips: {want}"
    assert run.violations.count() == want


def test_schema_contract(spark):
    frame = spark.sql("SELECT 1L AS A, 'x' AS b, 2 AS extra")
    diff = compare_schema(frame.schema, {"a": "bigint", "B": "int", "c": "string"})
    assert (diff.unexpected, diff.missing, diff.mismatched) == (["extra"], ["c"], ["b"])
    assert diff.count("reference") == 1 and diff.count("contract") == 3
    run = result(frame, [schema_rule(frame, {"a": "bigint", "c": "string"}, table="t")])
    audit = run.audit.collect()[0]
    assert (audit.status, audit.severity, audit.issue_count) == ("FAIL", "HIGH", 2)
    assert run.metrics.collect()[0].metric_value == 100.0
    assert json.loads(run.violations.collect()[0].violation_details) == {
        "missing_cols": 2,
        "missing": ["c"],
        "unexpected": ["b", "extra"],
    }


def test_upper_case_names_are_no_finding(spark):
    frame = spark.sql("SELECT 1L AS PICKUP, 2D AS Fare")
    diff = compare_schema(frame.schema, {"pickup": "bigint", "fare": "double"})
    assert diff.count("contract") == 0
    run = result(frame, [schema_rule(frame, {"pickup": "bigint", "fare": "double"}, table="t")])
    assert run.violations.count() == 0


def test_payload_drift(spark):
    docs = spark.sql(
        "SELECT parse_json(j) AS v FROM VALUES ('{\"a\":1,\"b\":\"x\"}'), ('{\"a\":null,\"z\":1}'), "
        "('{\"a\":\"no\",\"b\":\"y\"}'), ('[1]') AS t(j)"
    )
    found = {
        (r.column_name, r.finding): r.payloads
        for r in payload_drift(docs, "v", {"a": "bigint", "b": "string"}).collect()
    }
    assert found == {
        ("a", "mismatch"): 1,
        ("a", "missing"): 1,
        ("b", "missing"): 2,
        ("z", "unexpected"): 1,
    }


def test_payload_schema(spark):
    docs = spark.sql(
        "SELECT parse_json(j) AS v FROM VALUES ('{\"a\":1}'), ('{\"b\":\"x\"}') AS t(j)"
    )
    assert payload_schema(docs, "v").collect()[0][0] == "OBJECT<a: BIGINT, b: STRING>"


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10**6), st.floats(0, 1), st.floats(0, 1))
def test_planted_faults_are_counted_exactly(spark, seed, null_rate, outlier_rate):
    rng = random.Random(seed)
    rows, nulls, bad = [], 0, 0
    for _ in range(300):
        value = None if rng.random() < null_rate else 20.0
        if rng.random() < outlier_rate:
            value = 900.0
        nulls += value is None
        bad += value == 900.0
        rows.append((1, 1, value, None))
    frame = spark.createDataFrame(rows, READING)
    checks = [rules.reading_null_rule(), rules.threshold_rule()]
    row = result(frame, checks).counts.collect()[0]
    assert (row.null_values, row.hazardous_rows) == (nulls, bad)


def test_one_scan_gives_counts_and_violations(spark, folder):
    """The rows pass once, and all result frames are those of the two-scan run."""
    passed = spark.sparkContext.accumulator(0)

    def watched(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch

    trips = inputs.trips(spark, SF)
    scanned = trips.mapInArrow(watched, trips.schema)
    wanted = [rules.null_rule(), rules.range_rule(), rules.geo_rule()]
    run = run_checks(scanned, wanted, as_of="2024-01-30 12:00:00", run_id="r").scanned_once(f"{folder}/stage")
    got = [Counter(map(tuple, f.collect())) for f in (run.audit, run.metrics, run.violations)]
    assert passed.value == trips.count()
    plain = run_checks(trips, wanted, as_of="2024-01-30 12:00:00", run_id="r").pinned()
    assert got == [Counter(map(tuple, f.collect())) for f in (plain.audit, plain.metrics, plain.violations)]
    none = run_checks(trips.limit(0), wanted, as_of="2024-01-30 12:00:00", run_id="r").scanned_once(f"{folder}/none")
    assert [r.status for r in none.audit.collect()] == ["PASS"] * 3 and none.violations.isEmpty()


def test_counters_in_parts_are_pinned_instead(spark, folder):
    readings = inputs.readings(spark, SF)
    run = run_checks(readings, [rules.threshold_rule()], as_of="2024-01-30 12:00:00", run_id="r")
    once = run.scanned_once(f"{folder}/stage")
    assert Counter(map(tuple, once.audit.collect())) == Counter(map(tuple, run.audit.collect()))
    assert not os.path.exists(f"{folder}/stage")
