"""Incremental jobs, run to completion over files that Spark lands from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.bronze import typed_trips
from ..operators.rules import geo_rule, null_rule, range_rule
from ..schemas import BRONZE, TRIP_NAMES
from ..session import scratch_path
from ..sinks import tables
from ..streaming import jobs, revisions
from . import inputs as i
from .checks import AUDIT_COLUMNS, FARE, GEO, NULLS, READING_AUDIT_SQL
from .files import first_load
from .marts import ALL, FIRST_LOAD
from .observe import TREND
from .registry import query

BRONZE_STREAM = f"{BRONZE}, load_id string"


def _land(frame: DataFrame, path: str) -> None:
    """One delivery of trip files."""
    frame.select(*TRIP_NAMES).write.mode("append").option("header", True).csv(path)


def _early_and_rest(trips: DataFrame) -> tuple[DataFrame, DataFrame]:
    early = first_load(trips)
    late = trips.where(
        F.col("pickup_datetime").isNull()
        | (F.col("pickup_datetime") >= F.lit(i.FIRST_LOAD_BEFORE).cast("timestamp_ntz"))
    )
    return early, late


def _ingest(
    spark: SparkSession, landing: str, bronze: str, checkpoint: str, consumed: bool = False
) -> int:
    """Take what has landed; the number of batches that had rows. With ``consumed`` the files
    go when bronze has their rows."""
    scan = jobs.landing_stream(spark, landing, "CSV", columns=TRIP_NAMES)
    done = jobs.finish(
        jobs.stream_to_bronze(scan, "CSV", bronze, checkpoint, as_of=i.RESULTS_CLOCK)
    )
    if consumed:
        jobs.drop_taken(spark, checkpoint)
    return sum(1 for p in done.recentProgress if p["numInputRows"] > 0)


@query("incremental_file_ingest", i.over("trips", f"SELECT {ALL} FROM trips"))
def incremental_file_ingest(spark, sf_dir):
    """Two deliveries, an ingest after each: every file is loaded exactly once."""
    root = scratch_path(spark, "incremental")
    landing, bronze, checkpoint = f"{root}/in", f"{root}/bronze", f"{root}/state"
    for delivery in _early_and_rest(i.trips(spark, sf_dir)):
        _land(delivery, landing)
        _ingest(spark, landing, bronze, checkpoint)
    return typed_trips(spark.read.schema(BRONZE_STREAM).parquet(bronze)).select(*TRIP_NAMES)


@query(
    "stream_bronze",
    i.over(
        "trips",
        """SELECT 'CSV' AS source_format, count(*) AS row_count, count(*) AS distinct_rows,
 true AS has_load_time FROM trips""",
    ),
)
def stream_bronze(spark, sf_dir):
    root = scratch_path(spark, "stream-bronze")
    _ingest(spark, i.landed(spark, sf_dir, "trips"), f"{root}/bronze", f"{root}/state")
    bronze = spark.read.schema(BRONZE_STREAM).parquet(f"{root}/bronze")
    pairs = bronze.groupBy("source_format", "file_name", "file_row_number").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.col("load_timestamp").isNotNull()).alias("timed")
    )
    return pairs.groupBy("source_format").agg(
        F.sum("n").alias("row_count"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.bool_and("timed").alias("has_load_time"),
    )


_BLOCK = f"event_id // {i.INDENTED}"


@query(
    "stream_dead_letters",
    i.over(
        "readings",
        f"""SELECT 'record' AS outcome, NULL AS reason, count(*) AS n,
 CAST(sum(event_id) AS BIGINT) AS event_ids FROM readings WHERE {_BLOCK} % 5 <> 3
UNION ALL SELECT 'dead', CASE {_BLOCK} % 5 WHEN 3 THEN 'MALFORMED_JSON' ELSE 'NOT_A_RECORD' END,
 count(DISTINCT {_BLOCK}), NULL FROM readings WHERE {_BLOCK} % 5 IN (3, 4) GROUP BY 2""",
    ),
)
def stream_dead_letters(spark, sf_dir):
    """Indented documents, JSON lines and broken documents in one stream: what is a record goes
    to bronze, what is none to the dead letters of the same batch, with the whole text."""
    root = scratch_path(spark, "dead-letters")
    source = i.landed(spark, sf_dir, "indented")
    jobs.finish(
        jobs.stream_records(
            jobs.records_stream(spark, source),
            "JSON",
            f"{root}/bronze",
            f"{root}/state",
            as_of=i.RESULTS_CLOCK,
        )
    )
    event = F.variant_get("raw_data", "$.event_id", "bigint")
    taken = tables.read_records(spark, f"{root}/bronze").agg(
        F.lit(tables.RECORD).alias("outcome"),
        F.lit(None).cast("string").alias("reason"),
        F.count(F.lit(1)).alias("n"),
        F.sum(event).alias("event_ids"),
    )
    letters = tables.dead_letters(spark, f"{root}/bronze").where("text IS NOT NULL")
    dead = letters.groupBy(F.lit(tables.DEAD).alias("outcome"), "reason").agg(
        F.count(F.lit(1)).alias("n"), F.lit(None).cast("bigint").alias("event_ids")
    )
    return taken.unionByName(dead)


@query(
    "stream_gate",
    i.over(
        "trips",
        """SELECT 'new files' AS run, true AS ran, count(*) AS bronze_rows FROM trips
UNION ALL SELECT 'no new files', false, count(*) FROM trips""",
    ),
)
def stream_gate(spark, sf_dir):
    """The second run finds nothing new, so no batch fires."""
    root = scratch_path(spark, "gate")
    landing = i.landed(spark, sf_dir, "trips")
    out = None
    for run in ("new files", "no new files"):
        batches = _ingest(spark, landing, f"{root}/bronze", f"{root}/state")
        one = spark.read.schema(BRONZE_STREAM).parquet(f"{root}/bronze").agg(
            F.lit(run).alias("run"),
            F.lit(batches > 0).alias("ran"),
            F.count(F.lit(1)).alias("bronze_rows"),
        )
        out = one if out is None else out.unionByName(one)
    return out


def _bronze_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(BRONZE_STREAM).parquet(path)


@query("stream_silver_merge", i.over("silver", f"SELECT {ALL} FROM silver"))
def stream_silver_merge(spark, sf_dir):
    """Early trips are delivered first, then all trips (the early ones a second time):
    the merge adds only what silver lacks. Files are deleted when bronze has their rows."""
    root = scratch_path(spark, "stream-silver")
    trips = i.trip_bridge(spark, sf_dir)  # read twice only: no table of them is kept
    for delivery in (first_load(trips), trips):
        i.write_packed(delivery, f"{root}/in")
        _ingest(spark, f"{root}/in", f"{root}/bronze", f"{root}/state-bronze", consumed=True)
        jobs.finish(
            jobs.stream_to_silver(
                _bronze_stream(spark, f"{root}/bronze"),
                f"{root}/silver",
                f"{root}/state-silver",
                as_of=i.RESULTS_CLOCK,
            )
        )
    return tables.read_merged(spark, f"{root}/silver").select(*TRIP_NAMES)


_CLEAN = "\nUNION ALL ".join(
    f"""SELECT 'silver' AS table_name, '{name}' AS check_name, 'PASS' AS status,
 count(*) AS row_count, CAST(0 AS BIGINT) AS issue_count FROM silver"""
    for name in ("NON_NULL", "NUM_RANGE", "SCHEMA", "GEO_BOUNDS")
)
_CHAIN_READINGS = "\nUNION ALL ".join(
    f"SELECT table_name, check_name, status, row_count, issue_count FROM ({sql}) {name}_audit"
    for name, sql in READING_AUDIT_SQL.items()
)


@query("task_chain", i.over("silver readings", f"{_CLEAN}\nUNION ALL {_CHAIN_READINGS}"))
def task_chain(spark, sf_dir):
    """Merge, checks and export in one batch; the result is what was exported. The delivered files
    are deleted when bronze has their rows."""
    root = scratch_path(spark, "chain")
    i.write_packed(i.trip_bridge(spark, sf_dir), f"{root}/in")
    _ingest(spark, f"{root}/in", f"{root}/bronze", f"{root}/state-bronze", consumed=True)
    then = jobs.check_and_export(
        spark,
        f"{root}/silver",
        i.readings(spark, sf_dir),
        f"{root}/results",
        f"{root}/export",
        i.READINGS_CLOCK,
    )
    jobs.finish(
        jobs.stream_to_silver(
            _bronze_stream(spark, f"{root}/bronze"),
            f"{root}/silver",
            f"{root}/state-silver",
            as_of=i.RESULTS_CLOCK,
            then=then,
        )
    )
    day = i.READINGS_CLOCK[:10]
    return (
        spark.read.schema(
            "table_name string, check_name string, status string, row_count bigint, "
            "issue_count bigint"
        )
        .json(f"{root}/export/dq_audit_log/{day}")
        .select(*AUDIT_COLUMNS[:5])
    )


def _batch_counts(batch: int, condition: str) -> str:
    return "\nUNION ALL ".join(
        f"""SELECT {batch} AS batch, '{rule}' AS metric_name,
 count(*) FILTER (WHERE {bad}) AS fail_count, count(*) AS total_count
FROM trips WHERE {condition}"""
        for rule, bad in (
            ("RULE_NON_NULL", NULLS),
            ("RULE_FARE_RANGE", FARE),
            ("RULE_GEO_VERIFY", GEO),
        )
    )


@query(
    "stream_dq_metrics",
    i.over(
        "trips",
        _batch_counts(0, f"pickup_datetime < {FIRST_LOAD}")
        + "\nUNION ALL "
        + _batch_counts(
            1, f"(pickup_datetime IS NULL OR pickup_datetime >= {FIRST_LOAD})"
        ),
    ),
)
def stream_dq_metrics(spark, sf_dir):
    """Checks over each delivery as it arrives: one run per batch."""
    root = scratch_path(spark, "stream-checks")
    for delivery in _early_and_rest(i.trips(spark, sf_dir)):
        _land(delivery, f"{root}/in")
        scan = jobs.landing_stream(spark, f"{root}/in", "CSV", columns=TRIP_NAMES, cells=True)
        bronze_shape = scan.withColumns(
            {"file_row_number": F.lit(None), "load_timestamp": F.lit(None)}
        )
        jobs.finish(
            jobs.stream_check_counts(
                typed_trips(bronze_shape).select(*TRIP_NAMES),
                lambda batch: [null_rule(), range_rule(), geo_rule()],
                f"{root}/results",
                f"{root}/state",
                as_of=i.RESULTS_CLOCK,
            )
        )
    batch = F.substring_index("run_id", "-", -1).cast("int")
    return tables.read_results(spark, f"{root}/results", "metrics").select(
        batch.alias("batch"), "metric_name", "fail_count", "total_count"
    )


@query(
    "stream_hourly_trend",
    i.over(
        "metrics",
        f"""{TREND} FROM metrics
WHERE date_trunc('hour', run_timestamp) + INTERVAL 2 HOUR
 <= (SELECT max(run_timestamp) FROM metrics)
GROUP BY time_bucket, table_name, metric_name""",
    ),
)
def stream_hourly_trend(spark, sf_dir):
    """All hours that the watermark (one hour behind the newest row) has closed."""
    root = scratch_path(spark, "stream-trend")
    source = i.landed(spark, sf_dir, "metrics")
    schema = i.metrics(spark, sf_dir).schema
    stream = jobs.hourly_trend_stream(spark.readStream.schema(schema).parquet(source))
    jobs.finish(jobs.write_stream(stream, f"{root}/out", f"{root}/state"))
    return spark.read.schema(stream.schema).parquet(f"{root}/out")


_LATE, _HORIZON_DAYS = "metric_id % 50 = 0", 3
_REACHED = f"""run_timestamp > (SELECT max(run_timestamp) FROM metrics WHERE NOT ({_LATE}))
 - INTERVAL {_HORIZON_DAYS} DAY"""


@query(
    "stream_trend_revisions",
    i.over(
        "metrics",
        f"""{TREND}, CAST(max(CASE WHEN {_LATE} THEN 1 ELSE 0 END)
 + max(CASE WHEN {_LATE} THEN 0 ELSE 1 END) AS INTEGER) AS revision,
 (SELECT count(*) FROM metrics WHERE {_LATE} AND NOT ({_REACHED})) AS behind
FROM metrics WHERE NOT ({_LATE}) OR {_REACHED} GROUP BY time_bucket, table_name, metric_name""",
    ),
)
def stream_trend_revisions(spark, sf_dir):
    """One row in fifty arrives after all others: within the horizon it revises its hour, before
    that it is counted."""
    root = scratch_path(spark, "trend-revisions")
    metrics, behind = i.metrics(spark, sf_dir), 0
    for delivery in (metrics.where(f"NOT ({_LATE})"), metrics.where(_LATE)):
        delivery.write.mode("append").parquet(f"{root}/in")
        source = spark.readStream.schema(metrics.schema).parquet(f"{root}/in")
        stream = revisions.revised_trend_stream(source, f"{_HORIZON_DAYS} days")
        done = jobs.finish(revisions.write_revisions(stream, f"{root}/out", f"{root}/state"))
        behind += revisions.behind_horizon(done)
    found = spark.read.schema(revisions.REVISED).parquet(f"{root}/out")
    return revisions.newest_revisions(found).withColumn("behind", F.lit(behind).cast("bigint"))
