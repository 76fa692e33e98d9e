"""Bronze to silver: filter, distinct, deduplication, insert-only merge."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions.predicates import any_null, bad_coordinates, outside_open_range
from ..functions.times import clock
from ..schemas import TRIP_NAMES
from ..session import scratch_path
from . import rules, skew
from .bloom import may_be_among
from .skew import first_per_key, hot_keys, lane_of, left_anti_spread, mark_first

LINEAGE = ["__source_file", "__row_num"]
UNIQUE_KEY = ["pickup_datetime", "dropoff_datetime"]
MERGE_KEY = ["pickup_datetime"]


def silver_condition() -> Column:
    """What silver accepts. A conjunction of plain comparisons: an unknown drops the
    row, and every term can be pushed into a parquet scan."""
    lat, lon = fv.LATITUDE_BOUNDS, fv.LONGITUDE_BOUNDS
    terms = [F.col(n).isNotNull() for n in rules.CRITICAL]
    terms += [F.col("fare_amount") > fv.FARE_LOW, F.col("fare_amount") < fv.FARE_HIGH]
    terms += [F.col(n).between(*lat) for n in rules.LATITUDES]
    terms += [F.col(n).between(*lon) for n in rules.LONGITUDES]
    return reduce(and_, terms)


def silver_filter(trips: DataFrame) -> DataFrame:
    return trips.where(silver_condition())


def silver_shape(typed_view: DataFrame) -> DataFrame:
    """The 18 columns and lineage; the payload stays in bronze."""
    return typed_view.select(
        *TRIP_NAMES, F.col("__ingested_file").alias("__source_file"), F.col("__row_num")
    )


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows. Copies collapse in the map tasks before they are shuffled."""
    return df.dropDuplicates(list(columns) if columns else None)


def build_silver(typed_view: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    """The initial silver table: accepted rows, distinct, stamped."""
    rows = distinct_rows(silver_shape(silver_filter(typed_view)))
    return rows.withColumn("__silver_loaded_ts", clock(as_of))


def merge_rows(
    source: DataFrame,
    target: DataFrame,
    key: Sequence[str] = MERGE_KEY,
    *,
    spread_by: Sequence[str] | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Rows an insert-only merge adds: those whose key is not in ``target``. NULL keys
    never match, and copies inside ``source`` are all added. ``rows``: how many ``source``
    has, if known."""
    return left_anti_spread(source, target, key, spread_by=spread_by, rows=rows)


def merge_rows_by_keys(
    source: DataFrame,
    target: DataFrame,
    key: Sequence[str] = MERGE_KEY,
    *,
    keys: DataFrame,
    ends: DataFrame,
    spread_by: Sequence[str] | None = None,
    rows: int | None = None,
) -> tuple[DataFrame, bool]:
    """As :func:`merge_rows`, for wide rows: only keys are shuffled, and rows as far as they have to.

    ``keys`` are those of ``source``, wherever they are cheap to read, and ``ends`` is a row with
    the ``low`` and ``high`` end of the first key column in ``target``. Rows beyond them are new, as are those with a NULL key. Of the keys between them, those that
    ``target`` lacks are worked out and written to the scratch folder. Few are sent to all tasks,
    and no row moves. Otherwise the rows that pass a Bloom filter of them are joined, which are those
    that will be added and by chance some others. Also tells whether the rows stay where they are read.
    """
    spark, key = source.sparkSession, list(key)
    low, high = F.col("__low"), F.col("__high")
    sent = F.broadcast(ends.select(F.col("low").alias("__low"), F.col("high").alias("__high")))
    beyond = any_null(key) | low.isNull() | (F.col(key[0]) < low) | (F.col(key[0]) > high)
    marked, asked = (x.crossJoin(sent).withColumn("__beyond", beyond) for x in (source, keys))
    asked = asked.where("NOT __beyond").select(*key).distinct()
    known = target.select(*key).where(~any_null(key)).distinct()
    stage = scratch_path(spark, "lacking")
    asked.join(known, key, "left_anti").write.parquet(stage)
    lacking = spark.read.schema(asked.schema).parquet(stage)
    count = lacking.count()
    if count <= skew.SENT_KEYS:
        if count:
            found = F.broadcast(lacking.withColumn("__lacking", F.lit(True)))
            marked = marked.join(found, key, "left").where("__beyond OR __lacking")
        else:
            marked = marked.where("__beyond")
        return marked.select(*source.columns), True
    between = may_be_among(marked.where("NOT __beyond").select(*source.columns), lacking, key)
    late = merge_rows(between, target, key, spread_by=spread_by, rows=rows)
    return marked.where("__beyond").select(*source.columns).unionByName(late), False


def with_first_flag(
    df: DataFrame, key: Sequence[str] = UNIQUE_KEY, order_by: Sequence[str] = LINEAGE
) -> DataFrame:
    return mark_first(df, key, [F.col(c).asc_nulls_last() for c in order_by], order_by)


def quarantine(
    df: DataFrame, key: Sequence[str] = UNIQUE_KEY, order_by: Sequence[str] = LINEAGE
) -> DataFrame:
    """The surplus rows of repeated keys: all but the first by ``order_by``.

    Keys are counted first, without the other columns. A Bloom filter of the repeated ones, of
    bounded size, is sent to all tasks, and only rows that pass it (those of repeated keys, and
    by chance a few others) are shuffled whole, once. Keys of very many rows are dealt over
    lanes; the first of each lane meet in a second, small step.
    """
    counted = df.where(~any_null(key)).groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
    repeated = counted.where("__n > 1")
    candidates = may_be_among(df, repeated, key)
    hot = F.broadcast(hot_keys(repeated, key))
    lane = lane_of(order_by, F.coalesce(F.col("__lanes"), F.lit(1)))
    order = [F.col(c).asc_nulls_last() for c in order_by]
    ranked = (
        candidates.join(hot, list(key), "left")
        .withColumn("__lane", lane)
        .withColumn("__rank", F.row_number().over(Window.partitionBy(*key, "__lane").orderBy(*order)))
    )
    first = ranked.where("__rank = 1 AND __lanes > 1")
    later = first.withColumn("__rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.unionByName(later).where("__rank > 1").select(*df.columns)


def dedup_by_key(
    df: DataFrame, key: Sequence[str] = UNIQUE_KEY, order_by: Sequence[str] = LINEAGE
) -> DataFrame:
    """One row per complete key, the first by ``order_by``, and all rows without one.

    Unlike :func:`quarantine` this needs only the winners, so rows are limited to one
    per key inside the map tasks and one shuffle is enough. Rows with an incomplete key
    repeat nothing: all of them stay, as they do in no quarantine.
    """
    complete = reduce(and_, [F.col(c).isNotNull() for c in key])
    first = first_per_key(df.where(complete), key, [F.col(c).asc_nulls_last() for c in order_by])
    return first.unionByName(df.where(~complete))


def dedup_latest(
    df: DataFrame, key: Sequence[str], newest_by: Sequence[str], keep: int = 1
) -> DataFrame:
    """The latest ``keep`` rows of every key."""
    return first_per_key(df, key, [F.col(c).desc_nulls_last() for c in newest_by], keep)


def reject_reason() -> Column:
    """Why a row does not reach silver, first failing rule wins; NULL when it does."""
    fare = F.col("fare_amount")
    geo = bad_coordinates(
        rules.LATITUDES, rules.LONGITUDES, fv.LATITUDE_BOUNDS, fv.LONGITUDE_BOUNDS
    )
    return (
        F.when(any_null(rules.CRITICAL), "RULE_NON_NULL")
        .when(outside_open_range(fare, fv.FARE_LOW, fv.FARE_HIGH), "RULE_FARE_RANGE")
        .when(fare.isNull(), "FARE_MISSING")
        .when(geo, "RULE_GEO_VERIFY")
    )


def silver_reconciliation(trips: DataFrame) -> DataFrame:
    """Every input row counted once: accepted, or under its reject reason."""
    outcome = F.coalesce(reject_reason(), F.lit("SILVER")).alias("outcome")
    return trips.groupBy(outcome).agg(F.count(F.lit(1)).alias("row_count"))
