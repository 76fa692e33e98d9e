"""Hours that late rows revise."""

import datetime as dt

from pyspark.sql import functions as F

from millrace.streaming import jobs, revisions

KIND = "metric_id long, run_timestamp timestamp_ntz, table_name string, metric_name string, passed boolean"


def deliver(spark, folder, rows):
    frame = spark.createDataFrame([(n, t, "t", "m", ok) for n, (t, ok) in enumerate(rows)], KIND)
    frame.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    source = spark.readStream.schema(KIND).parquet(f"{folder}/in")
    stream = revisions.revised_trend_stream(source, "1 day")
    return jobs.finish(revisions.write_revisions(stream, f"{folder}/out", f"{folder}/state"))


def trend(spark, folder):
    found = spark.read.schema(revisions.REVISED).parquet(f"{folder}/out")
    return {
        r.time_bucket: (r.total_checks, r.pass_count, r.fail_count, r.avg_fail_percent, r.revision)
        for r in revisions.newest_revisions(found).collect()
    }, found


def test_late_rows_revise_hours_within_the_horizon(spark, folder):
    def at(day, hour, minute=0):
        return dt.datetime(2024, 1, day, hour, minute)

    before = spark.conf.get(revisions.PROVIDER, None)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        deliver(spark, folder, [(at(1, 5), True), (at(3, 10), True), (at(3, 10, 59), False), (at(3, 12), None)])
        first, _ = trend(spark, folder)
        assert first["2024-01-03 10:00"] == (2, 1, 1, 50.0, 1) and first["2024-01-03 12:00"] == (1, 0, 0, 0.0, 1)
        done = deliver(spark, folder, [(at(3, 10, 30), False), (at(2, 13), True), (at(1, 5, 1), False), (at(2, 11), False)])
        second, found = trend(spark, folder)
        assert second["2024-01-03 10:00"] == (3, 1, 2, 66.67, 2)  # revised
        assert second["2024-01-02 13:00"] == (1, 1, 0, 0.0, 1)  # a new hour inside the horizon
        assert second["2024-01-01 05:00"] == (1, 1, 0, 0.0, 1) and "2024-01-02 11:00" not in second
        assert revisions.behind_horizon(done) == 2
        deliver(spark, folder, [(at(9, 0), True)])
        third, found = trend(spark, folder)
        assert {k: third[k] for k in second} == second
        closed = {r.hour for r in found.where("closed").collect()}
        assert len(closed) == 4 and not found.where(F.col("closed") & (F.col("hour") == max(r.hour for r in found.collect()))).count()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert spark.conf.get(revisions.PROVIDER, None) == before
