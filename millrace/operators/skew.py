"""Helpers that keep one frequent key from landing in one task.

Lane numbers come from a hash of columns that tell rows apart (lineage), never from
``rand`` or a running id: a recomputed task must put every row in the same lane.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.predicates import any_null

FREQUENT_KEYS = 100_000  # most rows a frequent-key list may have, so it can be broadcast
ROWS_PER_LANE = 1_000_000  # rows of one key that one task may hold
ROWS_PER_TASK = 1_000_000  # rows that a task of a shuffle of known size is given
SENT_KEYS = 100_000  # most keys that are sent to all executors


def lane_count(df: DataFrame) -> int:
    """Four lanes per shuffle partition: a key that holds a share of all rows is then
    spread about as evenly as the rest of the table."""
    return 4 * max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def spreadable(df: DataFrame) -> list[str]:
    """Columns that can be hashed."""
    return [f.name for f in df.schema.fields if "variant" not in f.dataType.simpleString()]


def lane_of(columns: Sequence[str], lanes: int | Column) -> Column:
    lanes = F.lit(lanes) if isinstance(lanes, int) else lanes
    return F.pmod(F.xxhash64(*columns), lanes).cast("int")


def frequent_keys(
    df: DataFrame,
    key: Sequence[str],
    rows_per_lane: int = ROWS_PER_LANE,
    limit: int = FREQUENT_KEYS,
) -> DataFrame:
    """Non-null keys with more than ``rows_per_lane`` rows, and their ``__lanes``.

    At most ``limit`` rows, the most frequent first, which bounds what is broadcast. It
    is no cut of the result: with N rows in all, a key that is not listed has at most
    max(rows_per_lane, N / limit) rows and takes the plain path. Ties are ordered by the
    key, so that two evaluations give the same list.
    """
    counted = df.where(~any_null(key)).groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
    return hot_keys(counted, key, rows_per_lane, limit)


def hot_keys(
    counted: DataFrame,
    key: Sequence[str],
    rows_per_lane: int | None = None,
    limit: int = FREQUENT_KEYS,
) -> DataFrame:
    """As :func:`frequent_keys`, of keys that are counted already as ``__n``."""
    rows_per_lane = rows_per_lane or ROWS_PER_LANE
    return (
        counted.where(F.col("__n") > rows_per_lane)
        .orderBy(F.col("__n").desc(), *key)
        .limit(limit)
        .select(*key, F.ceil(F.col("__n") / rows_per_lane).cast("int").alias("__lanes"))
    )


def left_anti_spread(
    left: DataFrame,
    right: DataFrame,
    key: Sequence[str],
    *,
    spread_by: Sequence[str] | None = None,
    rows_per_lane: int = ROWS_PER_LANE,
    rows: int | None = None,
) -> DataFrame:
    """Rows of ``left`` whose key is not in ``right`` (a NULL key never matches).

    Hot keys: the right side is reduced to distinct keys before the join. Rows of
    ``left`` with a frequent key are dealt over as many lanes as their number asks for,
    and those keys of the right side are repeated once per lane (no more than one row
    per ``rows_per_lane`` rows of ``left``). Rows with a NULL key are dealt over lanes
    of their own, which nothing on the right side can match.

    ``rows``, how many ``left`` has as far as that is known, raises the number of shuffle
    partitions where a task would get more than about ``ROWS_PER_TASK`` of them.
    """
    key, spread = list(key), list(spread_by or spreadable(left))
    hot = F.broadcast(frequent_keys(left, key, rows_per_lane))
    dealt = left.join(hot, key, "left").withColumn(
        "__lane",
        F.when(any_null(key), -1 - lane_of(spread, lane_count(left))).otherwise(
            lane_of(spread, F.coalesce(F.col("__lanes"), F.lit(1)))
        ),
    )
    last_lane = F.coalesce(F.col("__lanes"), F.lit(1)) - 1
    wanted = (
        right.select(*key)
        .where(~any_null(key))
        .distinct()
        .join(hot, key, "left")
        .select(*key, F.explode(F.sequence(F.lit(0), last_lane)).alias("__lane"))
    )
    tasks = -(-(rows or 0) // ROWS_PER_TASK)
    if tasks > int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        dealt, wanted = (x.repartition(tasks, *key, "__lane") for x in (dealt, wanted))
    return dealt.join(wanted, [*key, "__lane"], "left_anti").select(*left.columns)


def mark_first(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[Column],
    order_columns: Sequence[str],
    name: str = "is_first",
) -> DataFrame:
    """Flag the first row of every key by ``order``; all rows are kept.

    Two windows instead of one: the first ranks inside (key, lane), where a lane is
    a hash share of the key; only the lane winners (at most one per lane) meet in
    the second. A key with a third of the table never sits in one task. A key with
    a NULL in it is never a duplicate.
    """
    lanes = lane_count(df)
    local = Window.partitionBy(*key, "__lane").orderBy(*order)
    final = Window.partitionBy(*key, "__group").orderBy(*order)
    ranked = (
        df.withColumn("__lane", lane_of(list(order_columns), lanes))
        .withColumn("__local", F.row_number().over(local))
        .withColumn("__group", F.when(F.col("__local") == 1, 0).otherwise(1 + F.col("__lane")))
        .withColumn("__final", F.row_number().over(final))
    )
    first = (F.col("__group") == 0) & (F.col("__final") == 1)
    return ranked.withColumn(name, any_null(key) | first).select(*df.columns, name)


def first_per_key(
    df: DataFrame, key: Sequence[str], order: Sequence[Column], keep: int = 1
) -> DataFrame:
    """The first ``keep`` rows of every key. Spark limits each group inside the map
    tasks before the shuffle, so a frequent key arrives as a few rows per task."""
    ranked = df.withColumn(
        "__rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    )
    return ranked.where(F.col("__rank") <= keep).drop("__rank")
