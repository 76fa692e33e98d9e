"""Rows that must not be lost: other splits, missing keys, late snapshots, failed exports."""

import pytest

from millrace.operators.bronze import with_row_numbers
from millrace.operators.silver import dedup_by_key
from millrace.sinks import tables
from millrace.streaming import jobs


def test_numbers_when_the_split_size_changes(spark, folder):
    spark.range(300_000).selectExpr("id", "repeat('x', 60) AS t").coalesce(1).write.option(
        "header", True
    ).csv(f"{folder}/in")
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "2")
    try:
        scan = spark.read.schema("id long, t string").option("header", True).csv(f"{folder}/in")
        rows = with_row_numbers(
            scan.selectExpr(
                "id", "_metadata.file_path AS file_path", "_metadata.file_block_start AS block_start"
            )
        )
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "8")
        got = rows.selectExpr("count(*)", "count(DISTINCT file_row_number)", "max(file_row_number)",
                              "count_if(file_row_number = id + 1)").first()
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
    assert tuple(got) == (300_000,) * 4


def test_rows_without_a_key_are_kept(spark):
    rows = spark.createDataFrame(
        [(None, i) for i in range(5)] + [("a", 7), ("a", 8)], "k string, n int"
    )
    got = sorted(r.n for r in dedup_by_key(rows, ["k"], ["n"]).collect())
    assert got == [0, 1, 2, 3, 4, 7]


def test_late_upsert_joins_the_newest_snapshot(spark, folder):
    def rows(*pairs):
        return spark.createDataFrame(list(pairs), "k string, n int")

    tables.upsert_snapshot(rows(("a", 2)), folder, ["k"], "2024-01-02 00:00:00")
    for _ in range(2):
        tables.upsert_snapshot(rows(("b", 1), ("a", 1)), folder, ["k"], "2024-01-01 00:00:00")
        got = {(r.k, r.n) for r in tables.read_snapshot(spark, folder).collect()}
        assert got == {("a", 2), ("b", 1)}
    tables.upsert_snapshot(rows(("b", 3)), folder, ["k"], "2024-01-03 00:00:00")
    got = {(r.k, r.n) for r in tables.read_snapshot(spark, folder).collect()}
    assert got == {("a", 2), ("b", 3)}


def test_hours_do_not_depend_on_the_session_zone(spark, folder):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        rows = "TIMESTAMP_NTZ'2024-01-30 10:15:00' AS run_timestamp, 't' AS table_name, 'm' AS metric_name, true AS passed"
        spark.sql(f"SELECT {rows}").write.parquet(f"{folder}/in")
        given = spark.read.parquet(f"{folder}/in")
        stream = spark.readStream.schema(given.schema).parquet(f"{folder}/in")
        query = (
            jobs.hourly_trend_stream(stream).writeStream.format("memory").queryName("zone_hours")
            .outputMode("complete").trigger(availableNow=True).start()
        )
        jobs.finish(query)
        assert [r.time_bucket for r in spark.table("zone_hours").collect()] == ["2024-01-30 10:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_failed_export_fails_the_batch(spark, folder, monkeypatch):
    from millrace.sinks.export import ExportStatus

    class Run:
        result = None

        def pinned(self):
            return self

    monkeypatch.setattr(jobs, "run_all_checks", lambda *a, **k: Run())
    monkeypatch.setattr(jobs, "read_merged", lambda *a, **k: spark.range(1))
    monkeypatch.setattr(jobs, "TRIP_NAMES", ["id"])
    monkeypatch.setattr(jobs, "append_results", lambda *a, **k: None)
    monkeypatch.setattr(jobs, "read_results", lambda *a, **k: None)
    monkeypatch.setattr(jobs, "export_all", lambda *a, **k: ExportStatus(False, "no space"))
    log = []
    step = jobs.check_and_export(spark, "", None, "", "", "2024-01-30 00:00:00", log)
    with pytest.raises(RuntimeError, match="no space"):
        step(None, "load")
    assert log[0].message == "no space"
