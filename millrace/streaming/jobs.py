"""Incremental ingest, the silver merge and the hourly trend as streams."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.numbers import half_up, share_pct
from ..functions.times import clock, hour_text
from ..operators.bronze import bronze_rows, typed_trips, with_row_numbers
from ..operators.checks import run_checks
from ..operators.silver import LINEAGE, MERGE_KEY, silver_filter, silver_shape
from ..plans.daily import run_all_checks
from ..schemas import TRIP_NAMES, conform
from ..session import scratch_path
from ..sinks import manifest
from ..sinks.export import ExportStatus, export_all
from ..sinks.tables import (
    DEAD,
    LANDED_RECORDS,
    RECORD,
    append_results,
    merge_insert_only,
    read_merged,
    read_results,
)
from ..sources.landing import json_records, scan_csv, scan_json, scan_texts

MERGE_INTERVAL = "5 minutes"

BatchStep = Callable[[DataFrame, str], None]


def load_prefix(name: str, checkpoint: str) -> str:
    """Batch numbers are unique within a checkpoint only, so load ids carry its path."""
    return f"{name}-{hashlib.sha256(checkpoint.encode()).hexdigest()[:32]}"


def _start(stream: DataFrame, step: BatchStep, checkpoint: str, every: str | None, name: str):
    """Run ``step(batch, load_id)`` per micro-batch. ``every=None`` takes what is there
    and stops. Without new files no batch runs at all. A batch that runs again after a
    failure gets the same load id."""
    prefix = load_prefix(name, checkpoint)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        step(batch, f"{prefix}-{batch_id}")

    writer = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    return _triggered(writer, every).start()


def _triggered(writer, every: str | None):
    if every is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every)


def landing_stream(
    spark: SparkSession,
    path: str,
    source_format: str,
    *,
    columns: Sequence[str] | None = None,
    files_per_batch: int | None = None,
    multi_line: bool | None = None,
    cells: bool = False,
) -> DataFrame:
    """New landed files, each exactly once. ``cells`` keeps the texts of a CSV row beside its
    payload, for typing without it. JSON files hold one document, indented or not, or
    lines (``multi_line=False`` reads lines only, in splits). Malformed JSON records stay, with a
    NULL payload; ``rejected_count`` counts them and the scalars."""
    if source_format == "CSV":
        return scan_csv(
            spark, path, columns, stream=True, files_per_batch=files_per_batch, cells=cells
        )
    return scan_json(
        spark,
        path,
        strip_outer_array=True,
        multi_line=multi_line,
        skip_malformed=False,
        stream=True,
        files_per_batch=files_per_batch,
    )


def rejected_count(bronze: DataFrame) -> DataFrame:
    """How many bronze rows hold no record: malformed ones, and scalars, which indented JSON
    read line by line leaves behind."""
    payload = F.col("raw_data")
    scalar = ~F.schema_of_variant(payload).rlike("^(OBJECT|ARRAY)")
    return bronze.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(payload.isNull()).alias("malformed"),
        F.count_if(payload.isNotNull() & scalar).alias("scalars"),
    )


def records_stream(
    spark: SparkSession,
    path: str,
    *,
    files_per_batch: int | None = None,
    multi_line: bool | None = None,
) -> DataFrame:
    """New landed JSON files as texts, for :func:`stream_records`."""
    return scan_texts(
        spark, path, lines=multi_line is False, stream=True, files_per_batch=files_per_batch
    )


def stream_records(
    texts: DataFrame,
    source_format: str,
    path: str,
    checkpoint: str,
    *,
    multi_line: bool | None = None,
    every: str | None = None,
    as_of: dt.datetime | str | None = None,
) -> StreamingQuery:
    """Append the records of new files to bronze, and what is no record to its dead letters.

    Both come from one scan and one write of the batch, so they are there together or not at
    all, and a replayed batch replaces both. ``sinks.tables.read_records`` and ``dead_letters``
    read them."""

    def step(batch: DataFrame, load_id: str) -> None:
        numbered = with_row_numbers(batch, counted_first=True)
        if "file_row_number" in batch.columns:  # a file a row: few files are written of many
            numbered = numbered.hint("rebalance", "file_path")
        rows = json_records(numbered, strip_outer_array=True, multi_line=multi_line)
        loaded = F.localtimestamp() if as_of is None else clock(as_of)
        shaped = rows.withColumns(
            {
                "load_timestamp": loaded,
                "source_format": F.lit(source_format),
                "outcome": F.when(F.col("reason").isNull(), RECORD).otherwise(DEAD),
                "load_id": F.lit(load_id),
            }
        )
        (
            conform(shaped, LANDED_RECORDS)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("outcome", "source_format", "load_id")
            .parquet(path)
        )

    return _start(texts, step, checkpoint, every, source_format.lower())


def stream_to_bronze(
    scan: DataFrame,
    source_format: str,
    path: str,
    checkpoint: str,
    *,
    every: str | None = None,
    as_of: dt.datetime | str | None = None,
) -> StreamingQuery:
    """Append every new file to bronze with file name and row number. A replayed batch
    replaces its own ``load_id`` partition."""

    def step(batch: DataFrame, load_id: str) -> None:
        (
            bronze_rows(batch, source_format, as_of, counted_first=True)
            .withColumn("load_id", F.lit(load_id))
            .write.mode("overwrite")
            .option("compression", "zstd")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("source_format", "load_id")
            .parquet(path)
        )

    return _start(scan, step, checkpoint, every, source_format.lower())


def stream_to_silver(
    bronze: DataFrame,
    silver_path: str,
    checkpoint: str,
    *,
    every: str | None = None,
    as_of: dt.datetime | str | None = None,
    filtered: bool = True,
    then: BatchStep | None = None,
) -> StreamingQuery:
    """Insert-only merge of new bronze rows into silver; ``then`` runs after each
    merge, in the same batch, and gets the rows that were to be merged.

    Rows are typed and filtered in the stream itself, so that its scan takes the keys out of the
    stored payloads; a batch that held payloads would build and search each of them every time
    it is read."""
    typed_view = typed_trips(bronze)
    accepted = silver_shape(silver_filter(typed_view) if filtered else typed_view)

    def step(batch: DataFrame, load_id: str) -> None:
        loaded = F.localtimestamp() if as_of is None else F.lit(str(as_of)).cast("timestamp_ntz")
        rows = batch.withColumn("__silver_loaded_ts", loaded)
        merge_insert_only(rows, silver_path, load_id, MERGE_KEY, spread_by=LINEAGE)
        if then is not None:
            then(batch, load_id)

    return _start(accepted, step, checkpoint, every, "silver")


def check_and_export(
    spark: SparkSession,
    silver_path: str,
    readings: DataFrame,
    results_root: str,
    export_root: str,
    as_of: dt.datetime | str,
    log: list[ExportStatus] | None = None,
    whole_table: bool = True,
) -> BatchStep:
    """The steps after a merge: run all checks, append their results, export the day.

    The run id is the load id, so a replayed batch replaces its own results. With
    ``whole_table=False`` the trip checks cover the rows of this load only (one silver
    partition), which keeps the cost of a batch independent of the size of silver."""

    def step(_batch: DataFrame, load_id: str) -> None:
        run = run_all_checks(
            read_merged(spark, silver_path, None if whole_table else load_id).select(*TRIP_NAMES),
            readings,
            as_of=as_of,
            run_id=load_id,
        ).pinned()
        append_results(run.result, results_root)
        day = str(as_of)[:10]
        status = export_all(
            read_results(spark, results_root, "audit_log"),
            read_results(spark, results_root, "metrics"),
            day,
            export_root,
        )
        if log is not None:
            log.append(status)
        if not status.ok:  # the batch is not committed and will be repeated
            raise RuntimeError(status.message)

    return step


def stream_check_counts(
    stream: DataFrame,
    checks: Callable[[DataFrame], list],
    results_root: str,
    checkpoint: str,
    *,
    as_of: dt.datetime | str,
    every: str | None = None,
) -> StreamingQuery:
    """Check results per micro-batch: one run per batch, and one scan of its files per run. The
    counters are observed on the scan that writes the violations (``observe``), and all results
    of the batch are committed together."""

    def step(batch: DataFrame, load_id: str) -> None:
        stage = scratch_path(batch.sparkSession, "violations")
        run = run_checks(batch, checks(batch), as_of=as_of, run_id=load_id).scanned_once(stage)
        append_results(run.result, results_root)

    return _start(stream, step, checkpoint, every, "checks")


def hourly_trend_stream(metrics: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Pass and fail counts per hour, table and metric as an event-time window. An hour
    is final, and emitted, once the watermark has passed its end; later rows are
    dropped. The state is one row per open hour, table and metric."""
    checks = F.count(F.lit(1))
    failed = F.count_if(~F.col("passed"))
    hours = (
        metrics.withColumn("event_time", F.expr("CAST(CAST(run_timestamp AS STRING) || 'Z' AS TIMESTAMP)"))
        .withWatermark("event_time", delay)
        .groupBy(F.window("event_time", "1 hour").alias("hour"), "table_name", "metric_name")
        .agg(
            checks.alias("total_checks"),
            F.count_if(F.col("passed")).alias("pass_count"),
            failed.alias("fail_count"),
            half_up(share_pct(failed, checks), 2).alias("avg_fail_percent"),
        )
    )
    # the zone-free time is read as UTC on the way in and out, whatever the session's zone
    start = "TIMESTAMP_NTZ'1970-01-01' + make_dt_interval(0, 0, 0, unix_seconds(hour.start))"
    return hours.select(
        hour_text(F.expr(start)).alias("time_bucket"),
        "table_name",
        "metric_name",
        "total_checks",
        "pass_count",
        "fail_count",
        "avg_fail_percent",
    )


def write_stream(
    stream: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Append a stream to a parquet folder."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return _triggered(writer, every).start()


def drop_taken(spark: SparkSession, checkpoint: str) -> int:
    """Delete the landed files that committed batches of a stopped stream have taken, as its
    checkpoint lists them; how many there were. Files of a batch that is to run again, and files that
    landed since, stay."""
    done = [int(n) for n in manifest.names(spark, f"{checkpoint}/commits") if n.isdigit()]
    if not done:
        return 0
    reached = F.get_json_object("value", "$.logOffset").cast("bigint")
    offset = spark.read.text(f"{checkpoint}/offsets/{max(done)}").agg(F.max(reached)).first()[0]
    entry = F.from_json("value", "path string, batchId bigint")
    listed = spark.read.text(f"{checkpoint}/sources/0").select(entry.alias("entry"))
    taken = listed.where(F.col("entry.batchId") <= offset).select("entry.path").distinct()
    dropped = 0
    for row in taken.toLocalIterator():
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(row.path))
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        dropped += fs.delete(path, False)
    return dropped


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait for an available-now query; an error in it is raised here."""
    query.awaitTermination()
    return query

