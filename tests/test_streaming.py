"""Streams: replays change nothing, late rows, equality with batch."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.catalogue import inputs
from millrace.operators.silver import silver_filter
from millrace.plans.observability import trend_rows
from millrace.schemas import BRONZE, TRIP_NAMES
from millrace.sinks import tables
from millrace.streaming import jobs

SF = "/root/testdata/sf0.001"
CLOCK = "2024-01-30 12:00:00"
STREAMED = f"{BRONZE}, load_id string"


def ingest(spark, folder, state="state"):
    scan = jobs.landing_stream(spark, f"{folder}/in", "CSV", columns=TRIP_NAMES)
    return jobs.finish(
        jobs.stream_to_bronze(scan, "CSV", f"{folder}/bronze", f"{folder}/{state}", as_of=CLOCK)
    )


def merge(spark, folder, state, **extra):
    stream = spark.readStream.schema(STREAMED).parquet(f"{folder}/bronze")
    return jobs.finish(
        jobs.stream_to_silver(stream, f"{folder}/silver", f"{folder}/{state}", as_of=CLOCK, **extra)
    )


def forget_last_commit(state):
    """As if the driver had died after the batch was written, before it was committed."""
    last = max(int(n) for n in os.listdir(f"{state}/commits") if n.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        if os.path.exists(f"{state}/commits/{name}"):
            os.remove(f"{state}/commits/{name}")


def test_replayed_batches_change_nothing(spark, folder):
    trips = inputs.trips(spark, SF).limit(500)
    trips.write.option("header", True).csv(f"{folder}/in")
    ingest(spark, folder)
    forget_last_commit(f"{folder}/state")
    ingest(spark, folder)
    assert spark.read.schema(STREAMED).parquet(f"{folder}/bronze").count() == 500
    merge(spark, folder, "merged", filtered=False)
    once = Counter(tuple(r) for r in tables.read_merged(spark, f"{folder}/silver").collect())
    forget_last_commit(f"{folder}/merged")
    merge(spark, folder, "merged", filtered=False)
    twice = Counter(tuple(r) for r in tables.read_merged(spark, f"{folder}/silver").collect())
    assert once == twice and sum(once.values()) == 500  # rows with a NULL key included


def test_a_new_checkpoint_does_not_replace_earlier_loads(spark, folder):
    trips = inputs.trips(spark, SF).limit(300)
    trips.write.option("header", True).csv(f"{folder}/in")
    ingest(spark, folder, "one")
    ingest(spark, folder, "two")
    assert spark.read.schema(STREAMED).parquet(f"{folder}/bronze").count() == 600


def test_chain_can_check_the_new_load_only(spark, folder):
    readings = inputs.readings(spark, SF)
    trips = silver_filter(inputs.trips(spark, SF))
    log = []
    for part in (trips.where("payment_type = 'CARD'"), trips.where("payment_type <> 'CARD'")):
        part.write.mode("append").option("header", True).csv(f"{folder}/in")
        ingest(spark, folder)
        then = jobs.check_and_export(
            spark, f"{folder}/silver", readings, f"{folder}/results", f"{folder}/export",
            CLOCK, log, whole_table=False,
        )
        merge(spark, folder, "merged", then=then)
    audit = tables.read_results(spark, f"{folder}/results", "audit_log").where("check_name = 'NON_NULL'")
    per_load = sorted(r.row_count for r in audit.collect())
    assert len(per_load) == 2 and sum(per_load) == tables.read_merged(spark, f"{folder}/silver").count()
    assert all(status.ok for status in log)


def test_small_batches_equal_one_batch(spark, folder):
    trips = inputs.trips(spark, SF)
    trips.repartition(3).write.option("header", True).csv(f"{folder}/in")
    scan = jobs.landing_stream(
        spark, f"{folder}/in", "CSV", columns=TRIP_NAMES, files_per_batch=1
    )
    done = jobs.finish(
        jobs.stream_to_bronze(scan, "CSV", f"{folder}/bronze", f"{folder}/state", as_of=CLOCK)
    )
    assert sum(1 for p in done.recentProgress if p["numInputRows"] > 0) == 3
    merge(spark, folder, "state-silver")
    got = tables.read_merged(spark, f"{folder}/silver")
    assert got.count() == silver_filter(trips).count()


def test_trend_stream_equals_batch_for_closed_hours(spark, folder):
    metrics = inputs.metrics(spark, SF)
    metrics.write.parquet(f"{folder}/in")
    stream = jobs.hourly_trend_stream(
        spark.readStream.schema(metrics.schema).parquet(f"{folder}/in")
    )
    jobs.finish(jobs.write_stream(stream, f"{folder}/out", f"{folder}/state"))
    out = spark.read.schema(stream.schema).parquet(f"{folder}/out")
    batch = {tuple(r) for r in trend_rows(metrics).select(out.columns).collect()}
    got = {tuple(r) for r in out.collect()}
    newest = metrics.agg(F.date_format(F.max("run_timestamp"), "yyyy-MM-dd HH:00")).collect()[0][0]
    assert got <= batch and len(got) > 0.98 * len(batch)
    assert all(r[0] != newest for r in got)


def test_metrics_stream_of_json(spark, folder):
    inputs.reading_documents(spark, SF).select(
        F.get_json_object("document", "$.results").alias("value")
    ).write.text(f"{folder}/in")
    scan = jobs.landing_stream(spark, f"{folder}/in", "JSON")
    jobs.finish(
        jobs.stream_to_bronze(scan, "JSON", f"{folder}/bronze", f"{folder}/state", as_of=CLOCK)
    )
    bronze = spark.read.schema(STREAMED).parquet(f"{folder}/bronze")
    assert bronze.count() == bronze.select("file_name", "file_row_number").distinct().count() == 1000


@pytest.mark.parametrize("multi_line, want", [(True, (2, 1, 0)), (False, None)])
def test_indented_and_malformed_json(spark, folder, multi_line, want):
    os.makedirs(f"{folder}/in")
    with open(f"{folder}/in/a.json", "w") as f:
        f.write('[\n  {\n    "id": 1,\n    "b": [\n      2\n    ]\n  }\n]\n')
    with open(f"{folder}/in/b.json", "w") as f:
        f.write('{"id": \n')
    scan = jobs.landing_stream(spark, f"{folder}/in", "JSON", multi_line=multi_line)
    jobs.finish(jobs.stream_to_bronze(scan, "JSON", f"{folder}/bronze", f"{folder}/state", as_of=CLOCK))
    bronze = spark.read.schema(STREAMED).parquet(f"{folder}/bronze")
    got = jobs.rejected_count(bronze).first()
    if want:
        assert tuple(got) == want
        assert [r[0] for r in bronze.selectExpr("try_variant_get(raw_data, '$.id', 'int') AS id").where("id IS NOT NULL").collect()] == [1]
    else:  # line by line nothing is lost without being counted
        assert got.malformed > 0 and got.scalars > 0 and got.malformed + got.scalars <= got.records
