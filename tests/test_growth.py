"""Steps whose cost must not outgrow their input: what is shuffled, sorted or read twice."""

import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from millrace.catalogue import CATALOGUE, inputs, streams
from millrace.operators import bloom, skew
from millrace.operators.bronze import bronze_rows, typed_trips, with_row_numbers
from millrace.operators.schema_check import payload_drift
from millrace.operators.silver import silver_filter
from millrace.schemas import TRIP_CONTRACT, TRIP_NAMES
from millrace.sinks import manifest, tables
from millrace.sources import landing
from millrace.sources.landing import rejected_texts, scan_csv, scan_json, scan_texts
from millrace.streaming import jobs

DATA = "/root/testdata/sf0.001"
CLOCK = "2024-01-30 12:00:00"


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_trips_are_dealt_out_only_where_the_scan_is_uneven(spark, monkeypatch):
    even = inputs.trip_bridge(spark, DATA)
    assert "Exchange" not in plan(even)
    monkeypatch.setattr(inputs, "EVEN_ROWS", 100)
    dealt = inputs.trip_bridge(spark, DATA)
    assert "hashpartitioning(__row_num" in plan(dealt)  # round robin would sort all rows
    assert even.exceptAll(dealt).isEmpty() and dealt.exceptAll(even).isEmpty()


def test_landed_rows_are_numbered_without_a_shuffle(spark, folder):
    spark.range(1000).selectExpr(*[f"id AS {n}" for n in TRIP_NAMES]).repartition(3).write.option(
        "header", True
    ).csv(f"{folder}/in")
    rows = with_row_numbers(scan_csv(spark, f"{folder}/in", TRIP_NAMES))
    assert "BroadcastHashJoin" in plan(rows) and "SortMergeJoin" not in plan(rows)
    seen = []

    def step(batch, _load_id):
        numbered = with_row_numbers(batch, counted_first=True)
        seen.append((plan(numbered), numbered.groupBy("file_name").agg(F.max("file_row_number")).collect()))

    stream = jobs.landing_stream(spark, f"{folder}/in", "CSV", columns=TRIP_NAMES)
    jobs.finish(jobs._start(stream, step, f"{folder}/state", None, "csv"))
    assert "BroadcastHashJoin" in seen[0][0] and "SortMergeJoin" not in seen[0][0]
    assert sum(r[1] for r in seen[0][1]) == 1000


def test_whole_texts_are_numbered_without_a_second_scan(spark, folder):
    spark.range(6).selectExpr("CAST(id AS STRING) AS value").repartition(3).write.text(folder + "/in")
    rows = with_row_numbers(scan_texts(spark, f"{folder}/in"))
    assert plan(rows).count("FileScan") == 1
    assert {r.file_row_number for r in rows.collect()} == {1}
    lines = with_row_numbers(scan_texts(spark, f"{folder}/in", lines=True))
    assert sorted(r.file_row_number for r in lines.collect())[-1] > 1


def test_a_silver_batch_holds_typed_rows_and_no_payload(spark, folder):
    bronze = "raw_data variant, file_name string, file_row_number bigint, load_timestamp timestamp_ntz"
    spark.sql(
        """SELECT parse_json('{"pickup_datetime":"2024-01-01 00:00:00"}') AS raw_data, 'f' AS file_name,
        1L AS file_row_number, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS load_timestamp"""
    ).write.parquet(f"{folder}/bronze")
    seen = []
    jobs.finish(
        jobs.stream_to_silver(
            spark.readStream.schema(bronze).parquet(f"{folder}/bronze"),
            f"{folder}/silver",
            f"{folder}/state",
            as_of=CLOCK,
            filtered=False,
            then=lambda batch, _: seen.append((dict(batch.dtypes), batch.count())),
        )
    )
    assert set(TRIP_NAMES) <= set(seen[0][0]) and "variant" not in seen[0][0].values()
    assert seen[0][1] == 1


def test_payloads_are_typed_in_one_pass_or_key_by_key_alike(spark):
    docs = [
        '{"pickup_datetime":"bad","fare_amount":"12.555","passenger_count":"x","rate_code":{"a":1}}',
        '{"pickup_datetime":"2024-01-01 00:00:01","passenger_count":3.7,"fare_amount":null,"rate_code":5}',
        '{"trip_distance":1e30,"pickup_longitude":"1.5"}', '{"Fare_amount":3}', "{}", "[1]", "7", "null",
    ]
    rows = spark.createDataFrame([(d,) for d in docs] + [(None,)], "j string").select(
        F.parse_json("j").alias("raw_data"),
        F.col("j").alias("file_name"),
        F.lit(1).alias("file_row_number"),
        F.lit(CLOCK).alias("load_timestamp"),
    )
    one, by_key = (typed_trips(rows, at_once=a).select(*TRIP_NAMES, "__ingested_file") for a in (True, False))
    assert one.schema == by_key.schema
    assert one.collect() == by_key.collect()
    assert plan(silver_filter(one)).count("try_variant_get(") == 1


ODD_CELLS = [
    "2024-01-01 00:00:01", "2024-1-5", "2024-01-01T10:00:00.123456789", "2024-01-01T10:00:00+02:00",
    "10:00", " 12 ", "1e3", "-0", "+7", "1.5", ".5", "12.555", "12.545", "1e30", "99999999999999999999",
    "NaN", "-inf", "Infinity", "0x1F", "1d", "true", "null", "NULL", "abc", "\u0661", "1,5", "\tx", "",
]


def test_cells_are_typed_as_their_payloads_and_make_none(spark, folder):
    # every odd text in every column, one column left out of the files, one unknown to the contract
    names = [*TRIP_NAMES[:-1], "More"]
    rows = spark.createDataFrame([(t,) for t in ODD_CELLS] + [(None,)], "t string")
    rows.select(*[F.col("t").alias(n) for n in names]).write.option("header", True).csv(f"{folder}/in")
    empty = {"file_row_number": F.lit(None), "load_timestamp": F.lit(None)}
    kept, plain = (
        typed_trips(scan_csv(spark, f"{folder}/in", names, cells=c).withColumns(empty)) for c in (True, False)
    )
    assert kept.schema == plain.schema
    wanted = [*TRIP_NAMES, F.col("__raw_payload").cast("string"), "__ingested_file"]
    got, want = ([str(r) for r in v.select(*wanted).collect()] for v in (kept, plain))
    assert sorted(got) == sorted(want) and len(got) == len(ODD_CELLS) + 1
    assert "variant" in plan(plain.select(*TRIP_NAMES))
    assert "variant" not in plan(kept.select(*TRIP_NAMES))


def test_streamed_checks_make_no_payloads(spark, monkeypatch):
    seen, start = [], jobs.stream_check_counts
    monkeypatch.setattr(
        jobs, "stream_check_counts", lambda *a, **k: seen.append(start(*a, **k)) or seen[-1]
    )
    assert CATALOGUE["stream_dq_metrics"].run(spark, DATA).count() == 6
    for done in seen:
        ran = done._jsq.explainInternal(False)
        assert "csv" in ran and "variant" not in ran
    assert len(seen) == 2


def test_large_merges_get_more_shuffle_partitions(spark, monkeypatch):
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 100)
    rows = spark.range(1000).selectExpr("IF(id % 10 = 0, NULL, id % 500) AS k", "id AS n")
    target = spark.range(250).selectExpr("id AS k")
    plain = skew.left_anti_spread(rows, target, ["k"], spread_by=["n"])
    wide = skew.left_anti_spread(rows, target, ["k"], spread_by=["n"], rows=1000)
    assert re.search(r"hashpartitioning\(k#\w+, __lane#\w+, 10\)", plan(wide))
    assert sorted(r.n for r in wide.collect()) == sorted(r.n for r in plain.collect())


def test_filter_bits_are_gathered_without_a_row_for_each_bit(spark):
    rows = spark.range(500).selectExpr("id % 3 AS b", "xxhash64(id) AS h")
    made = bloom.buckets(rows, ["b"])
    found = {r.b: bytes(r.bits) for r in made.collect()}
    places = rows.select("b", F.explode(F.array(*bloom.bit_places("h"))).alias("p")).distinct()
    wanted = {b: bytearray(bloom.BUCKET_BITS // 8) for b in range(3)}
    for r in places.collect():
        wanted[r.b][r.p // 8] |= 1 << r.p % 8
    assert found == {b: bytes(w) for b, w in wanted.items()}
    assert "Generate" not in plan(made).split("bitmap_construct_agg")[-1]


def test_drift_reads_payloads_once(spark, folder):
    spark.range(10).selectExpr(
        "parse_json(CASE id WHEN 0 THEN '7' WHEN 1 THEN '{\"fare_amount\":\"n/a\",\"x\":1}' ELSE '{}' END) AS v"
    ).write.parquet(folder + "/docs")
    drift = payload_drift(spark.read.schema("v variant").parquet(folder + "/docs"), "v", TRIP_CONTRACT)
    assert plan(drift).count("FileScan") == 1
    found = {(r.column_name, r.finding): r.payloads for r in drift.collect()}
    assert found[("fare_amount", "mismatch")] == 1 and found[("fare_amount", "missing")] == 9
    assert found[("x", "unexpected")] == 1 and found[("extra", "missing")] == 10


def test_a_merge_shuffles_keys_and_reads_few_rows_whole(spark, folder, monkeypatch):
    """Rows of old keys, of keys beyond the table and without one, hot ones among them: no whole row
    moves where few keys between are new, and the result is the same where many are."""
    even = spark.range(0, 4000, 2, 3).selectExpr("id AS k", "0L AS n", "repeat('x', 50) AS t")
    new = spark.range(0, 9000, 1, 5).selectExpr(
        "CASE WHEN id % 10 = 0 THEN NULL WHEN id % 3 = 0 THEN 77 WHEN id % 3 = 1 THEN id * 2 ELSE id + 3000 END AS k",
        "id AS n", "repeat('y', 50) AS t",
    )
    want = sorted(r.n for r in new.join(even, "k", "left_anti").select("n").collect())
    monkeypatch.setattr(skew, "ROWS_PER_LANE", 100)
    for sent in (100_000, 10):
        monkeypatch.setattr(skew, "SENT_KEYS", sent)
        tables.merge_insert_only(even, f"{folder}/{sent}", "a", ["k"])
        plans, commit = [], tables._commit_load
        with monkeypatch.context() as m:
            m.setattr(tables, "_commit_load", lambda rows, *a: plans.append(plan(rows)) or commit(rows, *a))
            tables.merge_insert_only(new, f"{folder}/{sent}", "b", ["k"], persist_source=False)
        got = tables.read_merged(spark, f"{folder}/{sent}", "b")
        assert sorted(r.n for r in got.collect()) == want and len(want) > 3000
        assert ("Exchange hashpartitioning" in plans[0]) == (sent == 10)


def test_one_load_is_not_written_twice(spark, folder):
    """A load from many tasks is written in few files, and so gives no cause for a rewrite."""
    wide = spark.range(0, 10_000, 1, 2 * tables.SMALL_FILES).selectExpr("id AS k", "id AS n")
    for name, rows in (("a", wide), ("b", wide.selectExpr("k + 5000 AS k", "n"))):
        tables.merge_insert_only(rows, f"{folder}/t", name, ["k"], persist_source=False)
        live = manifest.newest(spark, f"{folder}/t")
        assert live.files.where("rows > 0").count() <= tables.SMALL_FILES
    assert live.number == 2 and tables.read_merged(spark, f"{folder}/t").count() == 15_000


def test_a_streamed_merge_holds_no_rows_on_the_executors(spark, folder, monkeypatch):
    """Beyond a bounded number of rows nothing is persisted, and rows are read again instead."""
    kept, persist = [], type(spark.range(0)).persist
    monkeypatch.setattr(type(spark.range(0)), "persist", lambda df, *a: kept.append(df.columns) or persist(df, *a))
    monkeypatch.setattr(tables, "KEPT_ROWS", 99)
    for name, first in (("a", 0), ("b", 50)):
        rows = spark.range(first, first + 100).selectExpr("id AS k", "id AS n")
        tables.merge_insert_only(rows, f"{folder}/t", name, ["k"])
    assert tables.read_merged(spark, f"{folder}/t").count() == 150
    assert ["k", "n"] not in kept


def test_files_go_when_bronze_has_their_rows(spark, folder):
    def land(low, high):
        rows = spark.range(low, high, 1, 2).selectExpr(*[f"id AS {n}" for n in TRIP_NAMES])
        rows.write.mode("append").option("header", True).option("compression", "gzip").csv(f"{folder}/in dir")

    def take():
        scan = jobs.landing_stream(spark, f"{folder}/in dir", "CSV", columns=TRIP_NAMES, files_per_batch=1)
        jobs.finish(jobs.stream_to_bronze(scan, "CSV", f"{folder}/bronze", f"{folder}/state", as_of=CLOCK))

    assert jobs.drop_taken(spark, f"{folder}/state") == 0
    land(0, 10)
    take()
    land(10, 30)  # not taken yet
    assert jobs.drop_taken(spark, f"{folder}/state") == 2
    assert spark.read.option("header", True).csv(f"{folder}/in dir").count() == 20
    take()
    assert jobs.drop_taken(spark, f"{folder}/state") == 2
    assert spark.read.parquet(f"{folder}/bronze").select("file_name", "file_row_number").distinct().count() == 30


def test_the_chain_keeps_no_delivery_and_no_second_table(spark, folder, monkeypatch):
    """What the chain leaves on disk is bronze, silver, results and exports."""
    made = []
    monkeypatch.setattr(streams, "scratch_path", lambda _, name: made.append(f"{folder}/{name}") or made[-1])
    monkeypatch.setattr(inputs, "landed", lambda _s, _d, kind: pytest.fail(f"{kind} was written"))
    assert CATALOGUE["task_chain"].run(spark, DATA).count() == 7
    assert not glob.glob(f"{folder}/chain/in/*.csv*")
    bronze = spark.read.parquet(f"{folder}/chain/bronze")
    assert bronze.count() == inputs.table(spark, DATA, "lineitem").count()


def test_large_files_of_json_lines_are_read_in_splits(spark, folder, monkeypatch):
    """With the rows, row numbers and rejects that a whole reading gives; documents stay whole."""
    line = '[{"a": 1, "b": "%s"}, {"a": 2}]' % ("x" * 40)
    texts = {
        "lines [1] b%20.json": "﻿\n \r\n" + "\n".join([line] * 200 + ["{broken", "7", " ", '{"a": 3}\r']),
        "document.json": "[\n" + ",\n".join(['{"a": 4}'] * 300) + "\n]\n",
        "one.json": "[" + ", ".join(['{"a": 5}'] * 300) + "]\n\n",
        "broken.json": '{"a": 6}, {"a": 7}\n' + line * 50,
        "blank.json": " \n" * 900,
        "small.json": '{"a": 8}\n{"a": 9}\n',
    }
    os.makedirs(f"{folder}/in")
    for name, text in texts.items():
        with open(f"{folder}/in/{name}", "w", newline="") as f:
            f.write(text)

    def found():
        rows = scan_json(spark, f"{folder}/in", strip_outer_array=True, skip_malformed=False)
        bronze = bronze_rows(rows, "JSON", CLOCK).selectExpr("file_name", "file_row_number", "to_json(raw_data) AS j")
        bad = rejected_texts(spark, f"{folder}/in", strip_outer_array=True)
        return sorted(map(str, bronze.collect())), sorted(map(str, bad.collect())), rows

    whole = found()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        monkeypatch.setattr(landing, "WHOLE_BYTES", 1000)
        split = found()
        assert split[0] == whole[0] and split[1] == whole[1] and len(whole[0]) > 1000 and len(whole[1]) > 3
        spread = split[2].where("file_name LIKE 'lines%'").select(F.spark_partition_id()).distinct().count()
        assert spread > 3
        by_line, others = landing.large_line_files(spark, f"{folder}/in")
        assert len(by_line) + len(others) == len(texts) and len(by_line) == 2  # lines, and one
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
