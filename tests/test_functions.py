"""Edge rows of the column functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.functions import bands, numbers, predicates, text, times


def values(spark, sql_values, expr):
    return [r[0] for r in spark.sql(f"SELECT * FROM VALUES {sql_values} AS t(x)").select(expr).collect()]


def test_fare_edges(spark):
    got = values(
        spark,
        "(0.00), (0.01), (499.99), (500.00), (-1.00), (NULL)",
        predicates.outside_open_range(F.col("x"), 0, 500),
    )
    assert got == [True, False, False, True, True, None]


def test_bounds_are_inclusive(spark):
    got = values(
        spark,
        "(-90D), (90D), (90.01D), (NULL)",
        predicates.outside_bounds(F.col("x"), (-90, 90)),
    )
    assert got == [False, False, True, None]


def test_air_bands(spark):
    got = values(
        spark,
        "(15D), (15.01D), (35D), (55D), (150D), (250D), (250.01D), (NULL)",
        bands.air_category(F.col("x")),
    )
    assert got == [
        "GOOD",
        "MODERATE",
        "MODERATE",
        "UNHEALTHY_SENSITIVE",
        "UNHEALTHY",
        "VERY_UNHEALTHY",
        "HAZARDOUS",
        "NO_DATA",
    ]


def test_fare_buckets(spark):
    got = values(spark, "(4.99), (5), (10), (20), (50), (100)", bands.fare_bucket(F.col("x")))
    assert got == ["< $5", "$5–$10", "$10–$20", "$20–$50", "$50–$100", "> $100"]


def test_score_colours(spark):
    got = values(spark, "(0D), (49.9D), (50D), (79.9D), (80D)", bands.score_colour(F.col("x")))
    assert got == ["red", "red", "orange", "orange", "green"]


def test_health_labels(spark):
    rows = spark.sql(
        "SELECT * FROM VALUES ('PASS', 500), ('FAIL', 100), ('FAIL', 101), (NULL, 500) AS t(s, n)"
    ).select(bands.health_label(F.col("s"), F.col("n")))
    assert [r[0][2:] for r in rows.collect()] == ["PASS", "WARNING", "CRITICAL", "WARNING"]


def test_freshness_edges(spark):
    now = times.clock("2024-02-10 00:00:00")
    moments = "(TIMESTAMP_NTZ '2024-01-11 00:00:00'), (TIMESTAMP_NTZ '2024-01-10 23:59:59.999999'), (NULL)"
    got = values(spark, moments, bands.freshness_label(F.col("x"), now))
    assert got[0].endswith("Month old")
    assert got[1] == got[2] and "Stale" in got[1]


def test_differences_count_boundaries(spark):
    one = spark.sql(
        "SELECT TIMESTAMP_NTZ '2024-01-01 23:59:59' a, TIMESTAMP_NTZ '2024-01-02 00:00:00' b, "
        "TIMESTAMP_NTZ '2024-01-01 00:00:59' c, TIMESTAMP_NTZ '2024-01-01 00:01:00' d"
    )
    row = one.select(
        times.days_between(F.col("a"), F.col("b")), times.minutes_between(F.col("c"), F.col("d"))
    ).collect()[0]
    assert tuple(row) == (1, 1)


@pytest.mark.parametrize(
    "raw,places,want",
    [(2.5, 0, 3.0), (-2.5, 0, -3.0), (1.25, 1, 1.3), (0.0, 2, 0.0), (14.285714, 2, 14.29)],
)
def test_half_up(spark, raw, places, want):
    assert values(spark, f"({raw}D)", numbers.half_up(F.col("x"), places)) == [want]


def test_percentages_guard_zero(spark):
    row = spark.sql("SELECT 0L a, 0L b").select(
        numbers.fail_percent(F.col("a"), F.col("b")), numbers.share_pct(F.col("a"), F.col("b"))
    ).collect()[0]
    assert tuple(row) == (0.0, None)


def test_bad_time_text_is_null(spark):
    got = values(spark, "('nope'), ('2024-01-10T00:00:00Z')", times.parsed_time(F.col("x")))
    assert got == [None, dt.datetime(2024, 1, 10)]


def test_markdown(spark):
    got = values(spark, "('## Head **bold** *it*')", text.strip_markdown(F.col("x")))
    assert got == ["Head bold it"]


def test_json_object_drops_null_keys(spark):
    row = spark.sql("SELECT 1 a, CAST(NULL AS INT) b").select(
        text.json_object(F.col("a"), F.col("b"))
    )
    assert row.collect()[0][0] == '{"a":1}'


def test_same_day_is_pushed_down(spark, folder):
    spark.sql(
        "SELECT TIMESTAMP_NTZ '2024-01-30 10:00:00' AS ts, 1 AS other"
    ).write.parquet(f"{folder}/t")
    read = spark.read.parquet(f"{folder}/t")
    plan = (
        read.where(times.on_day(F.col("ts"), times.clock("2024-01-30 12:00:00")))
        .select("ts")
        ._jdf.queryExecution()
        .toString()
    )
    pushed = "GreaterThanOrEqual(ts,2024-01-30T00:00), LessThan(ts,2024-01-31T00:00)"
    assert f"PushedFilters: [IsNotNull(ts), {pushed}]" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan


def test_times_do_not_depend_on_the_session_zone(spark):
    """02:30 on this day does not exist in New York."""
    moment = "(TIMESTAMP_NTZ '2024-03-10 02:30:59.1234')"
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        late = times.clock("2024-03-10 03:30:00")
        row = spark.sql(f"SELECT * FROM VALUES {moment} AS t(x)").select(
            times.month_text(F.col("x")),
            times.day_text(F.col("x")),
            times.hour_text(F.col("x")),
            times.time_text(F.col("x")),
            times.stamp_text(F.col("x")),
            times.minutes_between(F.col("x"), late),
            times.days_between(F.col("x"), late),
            times.parsed_time(F.lit("2024-03-10T02:30:00Z")).cast("string"),
        )
        assert tuple(row.collect()[0]) == (
            "2024-03",
            "2024-03-10",
            "2024-03-10 02:00",
            "2024-03-10 02:30:59.123",
            "20240310_023059",
            60,
            0,
            "2024-03-10 02:30:00",
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
