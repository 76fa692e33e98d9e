"""Sums of doubles that depend on no order."""

import math
import random

import pytest
from pyspark.sql import functions as F

from millrace.catalogue import inputs
from millrace.operators import exact, rules
from millrace.operators.checks import run_checks
from millrace.plans import air_marts, observability
from millrace.plans.daily import run_all_checks

SF = "/root/testdata/sf0.001"


def means(spark, groups, keys=("k",)):
    rows = [(k, v) for k, values in groups.items() for v in values]
    random.Random(0).shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    got = exact.aggregate(df, list(keys), {"mean": exact.ExactMean(F.col("v"))})
    return {r["k"]: r["mean"] for r in got.collect()}


def test_means_are_correctly_rounded(spark):
    rng = random.Random(1)
    groups = {
        "cancelling": [1e300, -1e300, 1e-300, 1.0],
        "tenths": [0.1] * 10,
        "subnormal": [5e-324, 5e-324, 1e-310],
        "zeros": [0.0, -0.0],
        "negative": [-1.5, 0.25, -1e-9],
        "none": [None, None],
        "powers": [2.0**k for k in range(-1074, 1000, 13)],
        "edges": [math.nextafter(2.0**k, s) for k in range(-60, 60, 4) for s in (0, math.inf)],
        "ties": [2.0**53, 1.0, 2.0**-1000],
    }
    for n in range(20):
        groups[f"wide{n}"] = [rng.choice((-1, 1)) * math.ldexp(rng.random(), rng.randint(-900, 900)) for _ in range(30)]
        groups[f"usual{n}"] = [round(rng.uniform(-1000, 1000), 2) for _ in range(200)]
    got = means(spark, groups)
    for name, values in groups.items():
        values = [v for v in values if v is not None]
        assert got[name] == (math.fsum(values) / len(values) if values else None), name


def test_values_that_are_not_finite(spark):
    inf, nan = math.inf, math.nan
    got = means(spark, {"a": [inf, 1.0], "b": [inf, -inf], "c": [nan, 1.0], "d": [-inf], "e": [1.7e308] * 2})
    assert got["a"] == inf and got["d"] == -inf and math.isnan(got["b"]) and math.isnan(got["c"])
    assert got["e"] == inf  # the sum itself is beyond a double


def test_bits_do_not_depend_on_partitions(spark):
    frame = spark.range(20_000).select((F.rand(3) * 1000 - 300).alias("v"), (F.col("id") % 3).alias("k")).persist()
    wanted = {"mean": exact.ExactMean(F.col("v")), "n": F.count(F.lit(1)), "top": exact.largest(F.col("v"))}
    seen = [
        sorted(map(tuple, exact.aggregate(df, ["k"], wanted).collect()))
        for df in (frame.repartition(7), frame.orderBy("v"), frame.coalesce(1))
    ]
    assert seen[0] == seen[1] == seen[2]
    frame.unpersist()


def test_other_aggregates_in_parts(spark):
    rows = [("a", 1.0, "x"), ("a", 900.0, "y"), ("a", None, "x"), (None, 1e-5, "z"), (None, 7.0, "z")]
    df = spark.createDataFrame(rows, "k string, v double, c string")
    v = F.col("v")
    wanted = {
        "n": F.count(F.lit(1)), "mean": exact.ExactMean(v), "low": exact.smallest(v), "high": exact.largest(v),
        "kinds": exact.distinct(F.col("c")), "at": exact.largest_of(F.col("c"), v), "big": F.count_if(v > 5),
        "twice": exact.ExactMean(v * 2, lambda m: m + 1),
    }
    got = {r.k: tuple(r)[1:] for r in exact.aggregate(df, ["k"], wanted).collect()}
    assert got["a"] == (3, 450.5, 1.0, 900.0, 2, "y", 1, 902.0)
    assert got[None][:4] == (2, math.fsum([1e-5, 7.0]) / 2, 1e-5, 7.0)
    total = exact.aggregate(df.limit(0), [], wanted).collect()
    assert [tuple(r) for r in total] == [(0, None, None, None, 0, None, 0, None)]


def test_one_scan_and_one_shuffle_of_rows(spark):
    df = inputs.readings(spark, SF)
    plan = air_marts.location_kpi(df, inputs.READINGS_CLOCK)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 2  # rows, then steps


@pytest.fixture()
def outliers(spark):
    readings = inputs.readings(spark, SF)
    odd = spark.createDataFrame([(1e300,), (-1e300,), (1e-300,), (1.0,)], "v double")
    return readings.unionByName(
        readings.limit(1).drop("pm25_value").crossJoin(odd).withColumnRenamed("v", "pm25_value")
    )


def test_an_outlier_stops_no_check_and_no_mart(spark, outliers):
    run = run_all_checks(inputs.trips(spark, SF), outliers, as_of=inputs.READINGS_CLOCK, run_id="r").pinned()
    assert run.result.audit.count() == 7
    values = [r.pm25_value for r in outliers.where("pm25_value IS NOT NULL").collect()]
    want = math.floor(math.fsum(values) / len(values) * 10 + 0.5) / 10
    assert air_marts.who_breaches(outliers, inputs.READINGS_CLOCK).first().overall_avg_pm25 == want
    assert air_marts.location_kpi(outliers, inputs.READINGS_CLOCK).count() > 1
    assert air_marts.category_distribution(outliers).count() > 1
    audit = inputs.audit(spark, SF)
    assert observability.health_summary(audit, outliers, inputs.READINGS_CLOCK).count() == 2


def test_checks_without_a_mean_are_one_plain_aggregate(spark):
    run = run_checks(inputs.trips(spark, SF), [rules.null_rule()], as_of=inputs.RESULTS_CLOCK)
    assert "Sort" not in run.counts._jdf.queryExecution().optimizedPlan().toString()
    assert run.counts._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1
