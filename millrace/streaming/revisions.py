"""Hourly counts that late rows revise, within a stated horizon.

An hour is emitted as soon as it has rows, and again, with the next revision number, whenever a
row comes late. A timer ends it when the watermark, the horizon behind the newest row, has passed
its end; its state is dropped then. Rows further behind reach no hour: Spark takes them out before
the state and counts them, and :func:`behind_horizon` gives that count.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.numbers import half_up, share_pct
from ..functions.times import hour_text

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
HOUR_MS = 3_600_000
KEYS = ["hour", "table_name", "metric_name"]
REVISED = (
    "hour long, table_name string, metric_name string, total_checks long, pass_count long, "
    "fail_count long, revision int, closed boolean"
)


class HourCounts(StatefulProcessor):
    """The counts of one hour, table and metric."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getValueState("counts", "total long, passed long, failed long, revision int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        total, passed, failed, revision = self.counts.get() if self.counts.exists() else (0, 0, 0, 0)
        if not revision:
            self.handle.registerTimer((key[0] + 1) * HOUR_MS)
        for row in rows:
            total += row.total
            passed += row.passed
            failed += row.failed
        self.counts.update((total, passed, failed, revision + 1))
        yield self._row(key, total, passed, failed, revision + 1, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        total, passed, failed, revision = self.counts.get()
        self.counts.clear()
        yield self._row(key, total, passed, failed, revision, True)

    def _row(self, key, total, passed, failed, revision, closed) -> Row:
        return Row(
            hour=key[0], table_name=key[1], metric_name=key[2], total_checks=total,
            pass_count=passed, fail_count=failed, revision=revision, closed=closed,
        )

    def close(self) -> None:
        pass


def revised_trend_stream(metrics: DataFrame, horizon: str = "3 days") -> DataFrame:
    """Revisions of hourly pass and fail counts (``REVISED``; ``hour`` counts from 1970)."""
    known = F.col("passed").cast("int")
    rows = metrics.select(
        F.expr("CAST(CAST(run_timestamp AS STRING) || 'Z' AS TIMESTAMP)").alias("event_time"),
        "table_name",
        "metric_name",
        F.lit(1).cast("long").alias("total"),
        F.coalesce(known, F.lit(0)).cast("long").alias("passed"),
        F.coalesce(1 - known, F.lit(0)).cast("long").alias("failed"),
    ).withColumn("hour", F.floor(F.unix_seconds("event_time") / 3600))
    return (
        rows.withWatermark("event_time", horizon)
        .groupBy(*KEYS)
        .transformWithState(HourCounts(), REVISED, "Append", "EventTime")
    )


def write_revisions(stream: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append revisions to a parquet folder. The state of a query with timers is kept in RocksDB."""
    spark = stream.sparkSession
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        writer = (
            stream.writeStream.format("parquet")
            .outputMode("append")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
        )
        trigger = {"availableNow": True} if every is None else {"processingTime": every}
        return writer.trigger(**trigger).start()
    finally:  # the query has its own copy of the settings
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def behind_horizon(query: StreamingQuery) -> int:
    """Rows that a run of the query left out as too late."""
    return sum(
        state["numRowsDroppedByWatermark"] for p in query.recentProgress for state in p["stateOperators"]
    )


def newest_revisions(revisions: DataFrame) -> DataFrame:
    """The trend as the last revision of every hour tells it."""
    last = Window.partitionBy(*KEYS).orderBy(F.desc("revision"), F.desc("closed"))
    failed, total = F.col("fail_count"), F.col("total_checks")
    start = F.expr("TIMESTAMP_NTZ'1970-01-01' + make_dt_interval(0, cast(hour AS int), 0, 0)")
    return (
        revisions.withColumn("place", F.row_number().over(last))
        .where("place = 1")
        .select(
            hour_text(start).alias("time_bucket"),
            "table_name",
            "metric_name",
            "total_checks",
            "pass_count",
            "fail_count",
            half_up(share_pct(failed, total), 2).alias("avg_fail_percent"),
            "revision",
        )
    )
