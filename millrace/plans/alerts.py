"""Recent failures, the alert message and the publish branch."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions.times import clock, on_run_days, shifted, within_minutes
from ..session import one_row
from ..sinks.tables import publish_snapshots

LINES_PER_PART = 500
DEFAULT_TITLE = "DQ ALERT"


def recent_failures(
    audit: DataFrame,
    as_of: dt.datetime | str,
    minutes: int = fv.ALERT_MINUTES,
    issues: int = fv.ALERT_ISSUES,
) -> DataFrame:
    """Failed checks with more than ``issues`` issues in the last ``minutes``."""
    moment, now = F.col("run_timestamp"), clock(as_of)
    listed = on_run_days(audit, F.to_date(shifted(now, minutes=-minutes)), F.to_date(now))
    return listed.where(
        (F.col("status") == "FAIL")
        & (F.col("issue_count") > issues)
        & within_minutes(moment, now, minutes)
        & (moment <= now)
    ).select(
        "log_id",
        "table_name",
        "check_name",
        "status",
        "row_count",
        "issue_count",
        "run_timestamp",
    )


def newest_first(failures: DataFrame) -> DataFrame:
    return failures.orderBy(F.col("run_timestamp").desc(), F.col("log_id").desc())


def alert_line() -> Column:
    """``• [table] check — n issues / m rows``"""
    return F.concat(
        F.lit("• ["),
        F.col("table_name"),
        F.lit("] "),
        F.col("check_name"),
        F.lit(" — "),
        F.col("issue_count").cast("string"),
        F.lit(" issues / "),
        F.col("row_count").cast("string"),
        F.lit(" rows"),
    )


def join_lines(failures: DataFrame, group: list[str]) -> DataFrame:
    """The alert lines of each group as one text, newest first. The caller chooses a
    group that is bounded (a part, a block of log ids): its lines meet in one task."""
    entry = F.struct("run_timestamp", "log_id", alert_line().alias("line"))
    ordered = F.sort_array(F.collect_list(entry), asc=False)
    lines = F.array_join(F.transform(ordered, lambda e: e["line"]), "\n")
    return failures.groupBy(*group).agg(lines.alias("lines"))


def alert_messages(
    failures: DataFrame, title: str = DEFAULT_TITLE, lines_per_part: int = LINES_PER_PART
) -> DataFrame:
    """The alert text, newest line first; no row when nothing failed.

    Part 0 holds the newest ``lines_per_part`` failures, part 1 those before, and so on: every
    line is sent once and no task joins more than a part. Failures are numbered inside their
    second; the seconds, 3,600 an hour, give the offset. The total count is in every subject.
    """
    newest = [F.col("run_timestamp").desc(), F.col("log_id").desc()]
    by_second = failures.withColumn("second", F.date_trunc("second", "run_timestamp"))
    newer = Window.partitionBy().orderBy(F.desc("second")).rowsBetween(Window.unboundedPreceding, -1)
    seconds = (
        by_second.groupBy("second")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "second",
            F.coalesce(F.sum("n").over(newer), F.lit(0)).alias("before"),
            F.sum("n").over(Window.partitionBy()).alias("failures"),
        )
    )
    within = F.row_number().over(Window.partitionBy("second").orderBy(*newest))
    place = F.col("before") + F.col("place") - 1
    dealt = (
        by_second.withColumn("place", within)
        .join(seconds, "second")
        .withColumn("part", F.floor(place / lines_per_part))
    )
    count = F.col("failures").cast("string")
    return join_lines(dealt, ["part", "failures"]).select(
        "part",
        "failures",
        F.concat(F.lit(f"🔴 {title} — "), count, F.lit(" FAIL(s) detected")).alias("subject"),
        F.concat(count, F.lit(" critical failure(s):\n\n"), F.col("lines")).alias("message"),
    )


def publish_message(
    spark: SparkSession, targets: list[str], as_of: dt.datetime | str
) -> DataFrame:
    """The fixed success text, one line per published target."""
    done = "\n".join(f"✅ {t} — rows written" for t in targets)
    text = f"KPI publish complete.\n\n{done}\n\nTime: {as_of}"
    return one_row(spark, subject=F.lit("✅ KPIs published"), message=F.lit(text))


@dataclass(frozen=True)
class Outcome:
    """What a run sent: the alert's messages, or the publication's and its targets."""

    branch: str
    messages: DataFrame
    published: dict[str, DataFrame] = field(default_factory=dict)


def alert_or_publish(
    audit: DataFrame,
    as_of: dt.datetime | str,
    frames: Callable[[], dict[str, tuple[DataFrame, Sequence[str]]]],
    root: str,
    title: str = DEFAULT_TITLE,
) -> Outcome:
    """Any recent failure: the alert only. None: all KPI frames are published below ``root``, in
    one commit, and after it the success message.

    Only a yes/no answer passes through the driver (one row is looked for)."""
    failures = recent_failures(audit, as_of)
    if not failures.isEmpty():
        return Outcome("alert", alert_messages(failures, title))
    published = publish_snapshots(frames(), root, as_of)
    message = publish_message(audit.sparkSession, list(published), as_of)
    return Outcome("publish", message, published)
