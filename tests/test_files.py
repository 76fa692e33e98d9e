"""Landed files, exports, snapshots, alerts."""

import gzip
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from millrace.catalogue import inputs
from millrace.operators import bronze, rules
from millrace.operators.bronze import (
    bronze_rows,
    flatten_readings,
    raw_summary,
    typed_trips,
    typing_rejects,
)
from millrace.operators.checks import run_checks
from millrace.plans import alerts, observability
from millrace.sinks import export, tables
from millrace.sinks.layout import landing_path
from millrace.sources import landing, listing

SF = "/root/testdata/sf0.001"
CLOCK = "2024-01-30 12:00:00"


def write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_row_numbers_in_a_split_file(spark, folder):
    names = ["a", "b"]
    for part in range(2):
        lines = "\n".join(f"{part},{n}" for n in range(1, 20_001))
        write(f"{folder}/f{part}.csv", f"a,b\n{lines}\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        scan = landing.scan_csv(spark, folder, names)
        assert scan.rdd.getNumPartitions() > 8
        rows = bronze_rows(scan, "CSV", CLOCK)
        wrong = rows.where(
            F.variant_get("raw_data", "$.b", "bigint") != F.col("file_row_number")
        )
        assert rows.count() == 40_000 and wrong.count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_csv_by_header_and_by_contract(spark, folder):
    write(f"{folder}/a.csv", "x,y\n1,\n2,two\n")
    by_header = landing.scan_csv(spark, folder)
    by_contract = landing.scan_csv(spark, folder, ["x", "y"])
    for scan in (by_header, by_contract):
        got = scan.select(
            F.try_variant_get("raw_data", "$.x", "bigint"),
            F.try_variant_get("raw_data", "$.y", "string"),
        ).collect()
        assert sorted(map(tuple, got)) == [(1, None), (2, "two")]


def test_outer_array_and_malformed(spark, folder):
    write(f"{folder}/a.json", '[{"a":1},{"a":2}]\n{"a":3}\n{bad\n')
    rows = landing.scan_json(spark, folder, strip_outer_array=True)
    got = rows.select(F.variant_get("raw_data", "$.a", "int")).collect()
    assert sorted(r[0] for r in got) == [1, 2, 3]
    assert tuple(landing.malformed_count(spark, folder).collect()[0]) == (3, 1)


def test_pretty_printed_document(spark, folder):
    document = {"results": [{"location_id": 1, "latest_value": 16.5, "latest_time": "nope"}]}
    write(f"{folder}/a.json", json.dumps(document, indent=2))
    docs = landing.scan_documents(spark, folder, CLOCK, multi_line=True)
    row = flatten_readings(docs).collect()[0]
    assert (row.location_id, row.pm25_value, row.reading_time, row.who_category) == (
        1,
        16.5,
        None,
        "MODERATE",
    )
    assert row.source_file == "a.json"


def test_json_null_and_missing_key(spark):
    docs = spark.sql(
        "SELECT TIMESTAMP_NTZ '2024-01-01 00:00:00' ingest_ts, 'f' source_file, parse_json("
        "'{\"results\":[{\"latest_value\":null},{\"sensor_id\":1}]}') raw_data "
        "UNION ALL SELECT NULL, 'g', parse_json('{\"results\":[]}') "
        "UNION ALL SELECT NULL, 'h', parse_json('{\"meta\":1}')"
    )
    plain = [r.who_category for r in flatten_readings(docs).orderBy("sensor_id").collect()]
    compat = [
        r.who_category
        for r in flatten_readings(docs, json_null_compat=True).orderBy("sensor_id").collect()
    ]
    assert plain == ["NO_DATA", "NO_DATA"]
    assert compat == ["GOOD", "NO_DATA"]


def test_typed_view_options_and_rejects(spark):
    bronze = spark.sql(
        "SELECT parse_json('{\"fare_amount\":12.50,\"passenger_count\":\"many\"}') raw_data, "
        "'f' file_name, 1L file_row_number, TIMESTAMP_NTZ '2024-01-01 00:00:00' load_timestamp, "
        "'JSON' source_format"
    )
    row = typed_trips(bronze).collect()[0]
    assert str(row.fare_amount) == "12.50" and row.passenger_count is None
    assert str(typed_trips(bronze, whole_number_compat=True).collect()[0].fare_amount) == "13"
    rejects = {r.column_name: r.rejected for r in typing_rejects(bronze).collect()}
    assert rejects["passenger_count"] == 1 and sum(rejects.values()) == 1
    assert raw_summary(typed_trips(bronze)).collect()[0].total_files == 1


def test_inventory_lists_prefixes_by_tasks_of_their_own(spark, folder):
    write(f"{folder}/a.csv", "x\n1\n")
    write(f"{folder}/_hidden", "x")
    for prefix, name, text in (("p=1", "é b%20.csv", "abc"), ("p=1", "empty.csv", ""), ("q/r", "deep.txt", "12")):
        os.makedirs(f"{folder}/{prefix}", exist_ok=True)
        write(f"{folder}/{prefix}/{name}", text)
    files = listing.file_inventory(spark, folder)
    got = {r.key.removeprefix(f"{folder}/"): (r.size, r.is_empty) for r in files.collect()}
    assert got == {
        "a.csv": (4, False), "p=1/é b%20.csv": (3, False), "p=1/empty.csv": (0, True), "q/r/deep.txt": (2, False),
    }
    assert files.where("last_modified IS NULL").isEmpty()
    assert files.rdd.getNumPartitions() == 3  # the files of the folder itself, p=1 and q
    assert listing.file_inventory(spark, folder, "*.csv").count() == 3
    by_uri = listing.file_inventory(spark, f"file:{folder}")
    assert {r.key for r in by_uri.collect()} == {r.key for r in files.collect()}
    with pytest.raises(Exception, match="FileNotFound"):
        listing.file_inventory(spark, f"{folder}/none").count()


def test_csv_headers_in_any_order_and_parallel_splits(spark, folder):
    write(f"{folder}/a b%+é.csv", "x,y\n1,\n2,two\n")
    write(f"{folder}/b.csv", '\ufeffy,"z, w",x\nsix,7,5\n"a,b",,9\n')
    write(f"{folder}/c.csv", "x,y\n" + "".join(f"{n},v{n}\n" for n in range(20_000)))
    write(f"{folder}/empty.csv", "")
    write(f"{folder}/header.csv", "y,x\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        scan = landing.scan_csv(spark, folder)
        assert scan.rdd.getNumPartitions() > 8  # the large file gives many tasks
        small = scan.where("file_name NOT LIKE 'c%'").selectExpr("to_json(raw_data) AS j").collect()
        assert sorted(json.dumps(json.loads(r.j), sort_keys=True) for r in small) == sorted(
            json.dumps(d, sort_keys=True)
            for d in (
                {"x": "1", "y": None}, {"x": "2", "y": "two"},
                {"x": "5", "y": "six", "z, w": "7"}, {"x": "9", "y": "a,b", "z, w": None},
            )
        )
        rows = bronze_rows(scan, "CSV", CLOCK)
        wrong = rows.where(
            "file_name = 'c.csv' AND variant_get(raw_data, '$.x', 'bigint') + 1 <> file_row_number"
        )
        assert rows.count() == 20_004 and wrong.isEmpty()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_header_with_a_name_twice_stops_the_scan(spark, folder):
    write(f"{folder}/a.csv", "x,x\n1,2\n")
    with pytest.raises(Exception, match="there twice"):
        landing.scan_csv(spark, folder).count()


def test_json_layouts_are_found_out(spark, folder):
    write(f"{folder}/array.json", json.dumps([{"a": 1}, {"a": 2}], indent=2))
    write(f"{folder}/one.json", "\ufeff" + json.dumps({"a": 3}, indent=4) + "\n\n")
    write(f"{folder}/lines.json", '{"a": 4}\n\n{"a": 5}\r\n[{"a": 6}]\n')
    rows = landing.scan_json(spark, folder, strip_outer_array=True)
    got = rows.select(F.variant_get("raw_data", "$.a", "int")).collect()
    assert sorted(r[0] for r in got) == [1, 2, 3, 4, 5, 6]
    assert landing.rejected_texts(spark, folder, strip_outer_array=True).count() == 0


def test_rejected_texts_say_why(spark, folder):
    bad = {
        "cut.json": ('[\n  {"a": 1},\n  {"a"', "MALFORMED_JSON"),
        "two.json": ('{"a": 1} {"a": 2}', "MALFORMED_JSON"),
        "tail.json": ('{"a": 1}] rest', "MALFORMED_JSON"),
        "blank.json": (" \n", "EMPTY"),
        "none.json": ("[]", "EMPTY_ARRAY"),
        "scalar.json": ("7", "NOT_A_RECORD"),
        "null.json": ("null", "NOT_A_RECORD"),
    }
    for name, (text, _) in bad.items():
        write(f"{folder}/{name}", text)
    write(f"{folder}/mixed.json", '[{"a": 1}, 5, {"a": 2}]')
    write(f"{folder}/lines.json", '{"a": 3}\n{broken\n')
    found = landing.rejected_texts(spark, folder, strip_outer_array=True).collect()
    got = {r.file_name: (r.text, r.reason) for r in found}
    assert got == bad | {"mixed.json": ("5", "NOT_A_RECORD"), "lines.json": ("{broken", "MALFORMED_JSON")}
    assert [r.element for r in found if r.file_name == "mixed.json"] == [1]
    good = landing.scan_json(spark, folder, strip_outer_array=True).where("schema_of_variant(raw_data) LIKE 'OBJECT%'")
    assert good.count() == 3



def test_latest_files(spark):
    rows = [(f"p{i % 2}/f{i:02d}",) for i in range(9)] + [("q/only",)]
    files = spark.createDataFrame(rows, "key string")
    got = listing.latest_files(files, "key", F.split("key", "/")[0])
    assert sorted(r.key for r in got.collect()) == [
        "p0/f04", "p0/f06", "p0/f08", "p1/f03", "p1/f05", "p1/f07", "q/only",
    ]


def test_expected_prefix_without_files(spark):
    files = spark.createDataFrame([("a/1",), ("a/2",)], "key string")
    got = listing.latest_files(files, "key", F.split("key", "/")[0], 1, expected=["a", "b"])
    assert sorted((r.prefix, r.key or "") for r in got.collect()) == [("a", "a/2"), ("b", "")]


def test_unfinished_snapshot_version_is_ignored(spark, folder):
    rows = spark.createDataFrame([("a", 1)], "k string, n int")
    tables.upsert_snapshot(rows, folder, ["k"], "2024-01-01 00:00:00")
    rows.withColumn("snapshot_at", F.lit(None).cast("timestamp_ntz")).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).parquet(f"{folder}/version=2024-01-02T000000")
    assert tables.read_snapshot(spark, folder).collect()[0].snapshot_at is not None


def test_catalog(spark):
    spark.sql("SELECT 1L AS a, 'x' AS b").createOrReplaceTempView("tiny")
    tables_seen = [r.table_name for r in listing.catalog_tables(spark).collect()]
    assert "tiny" in tables_seen and tables_seen == sorted(tables_seen)
    assert [tuple(r)[2:] for r in listing.catalog_columns(spark, pattern="tin*").collect()] == [
        ("a", "bigint", 1),
        ("b", "string", 2),
    ]


def test_registered_tables_have_row_counts(spark, folder):
    spark.range(7).write.parquet(f"{folder}/one")
    spark.range(3).selectExpr("id AS a", "id AS b").write.parquet(f"{folder}/two")
    paths = {"one": f"{folder}/one", "two": f"{folder}/two"}
    for _ in range(2):  # registering again changes nothing
        listing.register_tables(spark, "some", paths, f"{folder}/some")
    found = listing.catalog_tables(spark, "some").where("table_schema = 'some'")
    assert [(r.table_name, r.table_type, r.row_count) for r in found.collect()] == [
        ("one", "EXTERNAL", 7), ("two", "EXTERNAL", 3),
    ]
    assert [r.column_name for r in listing.catalog_columns(spark, "some", "tw*").collect()] == ["a", "b"]


def test_export_is_cut_into_files_and_replaced(spark, folder):
    rows = spark.range(1000).selectExpr(
        "id AS log_id", "TIMESTAMP_NTZ '2024-01-30 01:00:00' AS run_timestamp", "'t' AS table_name",
        "'c' AS check_name", "'PASS' AS status", "1L AS row_count", "0L AS issue_count",
        "IF(id = 0, '{\"n\":{\"m\":1}}', NULL) AS details",
    )
    for _ in range(2):
        path = export.export_json(
            rows.coalesce(1), export.AUDIT_KEYS, "2024-01-30", folder, "log", file_bytes=40_000
        )
    names = glob.glob(f"{path}/*.json.gz")
    lines = [json.loads(line) for n in names for line in gzip.open(n, "rt")]
    assert len(names) == 4 and len(lines) == 1000  # about 131 bytes a row
    assert [line["details"] for line in lines if "details" in line] == [{"n": {"m": 1}}]
    assert lines[0]["run_timestamp"] == "2024-01-30 01:00:00.000"


def test_export_error_is_a_message(spark, folder):
    seen = []
    status = export.export_all(
        spark.range(1), spark.range(1), "2024-01-30", folder, on_error=seen.append
    )
    assert not status.ok and status.message.startswith("Export failed: ") and len(seen) == 1


def test_snapshot_upsert_versions(spark, folder):
    def rows(*pairs):
        return spark.createDataFrame(list(pairs), "k string, n int")

    tables.upsert_snapshot(rows(("a", 1), ("b", 1)), folder, ["k"], "2024-01-01 00:00:00")
    for _ in range(2):
        out = tables.upsert_snapshot(rows(("b", 2), ("c", 2)), folder, ["k"], "2024-01-02 00:00:00")
        assert sorted((r.k, r.n) for r in out.collect()) == [("a", 1), ("b", 2), ("c", 2)]


def test_violation_files_follow_their_volume(spark, folder):
    trips = inputs.trips(spark, SF).repartition(40)
    run = run_checks(trips, [rules.range_rule()], as_of=CLOCK, run_id="r").pinned()
    tables.append_results(run.result, folder)
    files = glob.glob(f"{folder}/data/*/kind=violations/*/*.parquet")
    assert len(files) == 1
    assert tables.read_results(spark, folder, "violations").count() == 235


def test_landing_path(spark):
    one = spark.sql("SELECT TIMESTAMP_NTZ '2024-03-05 06:07:08' AS t")
    path = one.select(landing_path("openaq", F.col("t"), "json")).collect()[0][0]
    assert path == "landing/openaq/openaq_20240305_060708.json"


def failures(spark, n):
    return spark.range(n).selectExpr(
        "id AS log_id", "'t' AS table_name", "'c' AS check_name", "'FAIL' AS status",
        "10L AS row_count", "200 + id AS issue_count",
        "TIMESTAMP_NTZ '2024-01-30 11:30:00' AS run_timestamp",
    )


def test_alert_message(spark):
    row = alerts.alert_messages(failures(spark, 2)).collect()[0]
    assert row.subject.endswith("2 FAIL(s) detected")
    assert row.message == (
        "2 critical failure(s):\n\n• [t] c — 201 issues / 10 rows\n• [t] c — 200 issues / 10 rows"
    )
    assert alerts.alert_messages(failures(spark, 0)).count() == 0


def test_many_failures_are_split_and_complete(spark):
    parts = alerts.alert_messages(failures(spark, 1000), lines_per_part=100).collect()
    lines = [line for p in parts for line in p.message.split("\n\n")[1].split("\n")]
    assert 5 < len(parts) <= 10 and len(lines) == len(set(lines)) == 1000


def test_alert_or_publish(spark, folder):
    frames = lambda: {"kpis": (spark.range(3).toDF("k"), ["k"])}
    alert = alerts.alert_or_publish(failures(spark, 1), CLOCK, frames, folder)
    assert alert.branch == "alert" and not alert.published
    publish = alerts.alert_or_publish(failures(spark, 1).limit(0), CLOCK, frames, folder)
    assert publish.branch == "publish" and publish.published["kpis"].count() == 3


def test_scorecard_of_150_checks(spark):
    rows = spark.range(150).selectExpr(
        "id < 135 AS passed", "TIMESTAMP_NTZ '2024-01-30 01:00:00' AS run_timestamp"
    )
    assert tuple(observability.scorecard_today(rows, CLOCK).collect()[0]) == (150, 135, 15, 90.0)


def test_empty_window_gives_null_rates(spark):
    row = observability.gold_matrix(inputs.metrics(spark, SF), "2030-01-01 00:00:00").collect()[0]
    assert (row.pass_rate, row.fail_rate, row.total_rules) == (None, None, 0)


def test_worst_category_two_ways(spark):
    from millrace.plans.air_marts import location_kpi

    rows = spark.sql(
        "SELECT 1L location_id, 'pm25' parameter, 'u' unit, v AS pm25_value, c AS who_category, "
        "TIMESTAMP_NTZ '2024-01-01 00:00:00' reading_time FROM VALUES (300D, 'HAZARDOUS'), "
        "(20D, 'MODERATE') AS t(v, c)"
    )
    row = location_kpi(rows, CLOCK).collect()[0]
    assert (row.worst_category, row.worst_category_by_value) == ("MODERATE", "HAZARDOUS")
