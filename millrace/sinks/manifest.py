"""Tables of data files that never change, listed by a manifest.

Parquet has no transactions. Here a commit writes its rows to a folder of its own and then a
new version of the manifest, one row for each live file. A version counts once Spark has marked
it complete, so readers, who pin the newest complete one, see a commit whole or not at all. One
writer per table is assumed.

::

    <root>/data/<commit>/...            rows
    <root>/filters/<commit>/...         Bloom filters: (commit, name, bucket, bits)
    <root>/manifest/<version>           a row for each live file, and for each committed load

A file's row holds its number of rows and, for keyed tables, the range of its keys and the size
of its Bloom filter (:mod:`millrace.operators.bloom`). Filters never pass through the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.predicates import any_null
from ..operators.bloom import BUCKET_BITS, KEY_BITS, all_set, buckets, hashes

BINS = 1024  # steps of the range of a load's keys
BROADCAST_ROWS = 200_000  # most rows of a list of files that is sent to all executors
KEPT_VERSIONS = 4
LARGE_SHARE = 0.1


@dataclass(frozen=True)
class Version:
    """One complete version: its number, its files and its loads as frames."""

    number: int
    files: DataFrame
    loads: DataFrame


def _hadoop(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def names(spark: SparkSession, path: str) -> list[str]:
    fs, place = _hadoop(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(place)] if fs.exists(place) else []


def _numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the complete versions, newest first."""
    fs, _ = _hadoop(spark, root)
    path = spark._jvm.org.apache.hadoop.fs.Path
    found = sorted((int(n) for n in names(spark, f"{root}/manifest") if n.isdigit()), reverse=True)
    return [n for n in found if fs.exists(path(f"{_at(root, n)}/_SUCCESS"))]


def _at(root: str, number: int) -> str:
    return f"{root}/manifest/{number:010d}"


def newest(spark: SparkSession, root: str) -> Version | None:
    """The newest complete version, or nothing for a table that has none."""
    numbers = _numbers(spark, root)
    if not numbers:
        return None
    rows = spark.read.parquet(_at(root, numbers[0]))
    files = rows.where("load_id IS NULL").drop("load_id")
    return Version(numbers[0], files, rows.where("load_id IS NOT NULL").select("load_id"))


def new_commit() -> str:
    return uuid.uuid4().hex


def data_path(root: str, commit: str) -> str:
    return f"{root}/data/{commit}"


def paths(root: str, files: DataFrame) -> list[str]:
    """Paths of files, in order: a row of the manifest each, no data."""
    listed = files.select("commit", "name").collect()
    return sorted(f"{data_path(root, r.commit)}/{r.name}" for r in listed)


def read_files(spark: SparkSession, schema: StructType, listed: list[str], base: str | None = None) -> DataFrame:
    """The rows of listed files. ``base`` names the folder below which folders are columns."""
    if not listed:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    return (reader.option("basePath", base) if base else reader).parquet(*listed)


def publish(
    spark: SparkSession,
    root: str,
    files: DataFrame,
    loads: DataFrame,
    after: Version | None,
) -> int:
    """Write the next version: its mark of completion is the commit. What an interrupted try
    left at the same number is replaced."""
    number = after.number + 1 if after else 1
    rows = files.unionByName(loads.select("load_id"), allowMissingColumns=True)
    rows.coalesce(1).write.mode("overwrite").parquet(_at(root, number))
    return number


def expire(spark: SparkSession, root: str, keep: int = KEPT_VERSIONS) -> None:
    """Remove versions older than the ``keep`` newest, and data and filters of no kept one.
    A reader that pinned an older version has to read again."""
    numbers = _numbers(spark, root)
    kept, old = numbers[:keep], numbers[keep:]
    if not old:
        return
    fs, _ = _hadoop(spark, root)
    path = spark._jvm.org.apache.hadoop.fs.Path
    live: set[str] = set()
    for number in kept:
        rows = spark.read.parquet(_at(root, number)).select("commit").distinct()
        live |= {r.commit for r in rows.collect()}
    for number in old:
        fs.delete(path(_at(root, number)), True)
    for kind in ("data", "filters"):
        for name in names(spark, f"{root}/{kind}"):
            if name not in live:
                fs.delete(path(f"{root}/{kind}/{name}"), True)


# --- keys ------------------------------------------------------------------------


def position(column: Column, kind: str) -> Column:
    """A whole number that rises with the column, as far as its type has one."""
    if kind == "timestamp_ntz":
        seconds = F.hour(column) * 3600 + F.minute(column) * 60 + F.second(column)
        return (F.unix_date(F.to_date(column)).cast("bigint") * 86_400 + seconds).cast("bigint")
    if kind == "timestamp":
        return F.unix_seconds(column)
    if kind == "date":
        return F.unix_date(column).cast("bigint")
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return column.cast("bigint")
    if kind in ("string", "binary"):
        head = F.rpad(F.hex(F.substring(column.cast("binary"), 1, 7)), 14, "0")
        return F.conv(head, 16, 10).cast("bigint")
    return F.lit(0).cast("bigint")


def describe(spark: SparkSession, root: str, commit: str, schema: StructType, key: Sequence[str]) -> DataFrame:
    """Manifest rows of a commit whose rows are written: rows, key range, size of the filter.
    Reads the key columns only. A null in the key makes a row keyless."""
    rows = spark.read.schema(schema).parquet(data_path(root, commit))
    keyed = ~any_null(key)
    first = F.when(keyed, F.col(key[0]))
    return rows.groupBy(F.col("_metadata.file_name").alias("name")).agg(
        F.lit(commit).alias("commit"),
        F.count(F.lit(1)).alias("rows"),
        F.ceil(F.count_if(keyed) * KEY_BITS / F.lit(BUCKET_BITS)).cast("int").alias("buckets"),
        F.min(first).alias("low"),
        F.max(first).alias("high"),
    )


def write_filters(
    spark: SparkSession, root: str, commit: str, schema: StructType, key: Sequence[str], files: DataFrame
) -> None:
    """The Bloom filters of a commit's files. Files are numbered, so that rows are sorted by one
    whole number, file and bucket, and not by a name."""
    rows = spark.read.schema(schema).parquet(data_path(root, commit))
    spot, bits = hashes(key)
    number = F.row_number().over(Window.orderBy("name")).cast("bigint")
    numbered = files.where(F.col("commit") == commit).select("name", "buckets", number.alias("file"))
    place = F.shiftleft("file", 32) + F.pmod("spot", "buckets")
    hashed = (
        rows.where(~any_null(key))
        .select(F.col("_metadata.file_name").alias("name"), spot.alias("spot"), bits.alias("h"))
        .join(F.broadcast(numbered), "name")
        .select(place.alias("place"), "h")
    )
    bucket = F.col("place").bitwiseAND(F.lit((1 << 32) - 1))
    (
        buckets(hashed, ["place"])
        .join(F.broadcast(numbered), F.shiftright("place", 32) == F.col("file"))
        .select(F.lit(commit).alias("commit"), "name", bucket.alias("bucket"), "bits")
        .write.mode("overwrite")
        .parquet(f"{root}/filters/{commit}")
    )


def key_range(source: DataFrame, key: Sequence[str]) -> Row:
    """How many rows a load has (``rows``; ``keyed`` with a whole key), and the ends of its keys."""
    first, kind = F.col(key[0]), dict(source.dtypes)[key[0]]
    keyed = ~any_null(key)

    def among(value: Column) -> Column:
        return F.when(keyed, value)

    return source.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(keyed).alias("keyed"),
        F.min(among(first)).alias("low"),
        F.max(among(first)).alias("high"),
        F.min(among(position(first, kind))).alias("start"),
        F.max(among(position(first, kind))).alias("stop"),
    ).first()


def may_hold(
    spark: SparkSession,
    root: str,
    files: DataFrame,
    source: DataFrame,
    key: Sequence[str],
    ends: Row | None = None,
) -> DataFrame:
    """Those of ``files`` that may hold a key of ``source``, by key range and Bloom filter.

    The range of all source keys (``ends``) comes first. The remaining files and the distinct keys are laid
    on steps of that range and joined by step, which the ranges narrow to the files that cover a
    key; of those, the filter decides. No file with a key of ``source`` is ever left out. A load
    of a ``LARGE_SHARE`` of the rows in range would open about every file, so it is not probed.
    """
    kind = dict(source.dtypes)[key[0]]
    rows = source.where(~any_null(key)).select(*key)
    first = F.col(key[0])
    ends = ends or key_range(source, key)
    if ends.low is None:
        return files.limit(0)
    low, high = (F.lit(x).cast(kind) for x in (ends.low, ends.high))
    near = files.where((F.col("buckets") > 0) & (F.col("high") >= low) & (F.col("low") <= high))
    held_rows = {r.commit: r for r in near.groupBy("commit").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files")).collect()}
    if ends.keyed >= LARGE_SHARE * sum(r["rows"] for r in held_rows.values()):
        return near
    width = max(1, -(-(ends.stop - ends.start + 1) // BINS))

    def step(column: Column) -> Column:
        inside = F.least(F.greatest(position(column, kind), F.lit(ends.start)), F.lit(ends.stop))
        return F.floor((inside - F.lit(ends.start)) / F.lit(width)).cast("bigint")

    laid = near.select(
        "commit", "name", "buckets", "low", "high",
        F.explode(F.sequence(step(F.col("low")), step(F.col("high")))).alias("step"),
    )
    if sum(r.files for r in held_rows.values()) * BINS <= BROADCAST_ROWS:
        laid = F.broadcast(laid)
    spot, bits = hashes(key)
    asked = rows.distinct().select(first.alias("k"), step(first).alias("step"), spot.alias("spot"), bits.alias("h"))
    pairs = (
        asked.join(laid, "step")
        .where((F.col("low") <= F.col("k")) & (F.col("k") <= F.col("high")))
        .select("commit", "name", F.pmod("spot", "buckets").alias("bucket"), "h")
    )
    filters = spark.read.schema("commit string, name string, bucket bigint, bits binary").parquet(
        *[f"{root}/filters/{c}" for c in held_rows]
    )
    held = pairs.join(filters, ["commit", "name", "bucket"]).where(all_set("bits", "h"))
    return files.join(F.broadcast(held.select("commit", "name").distinct()), ["commit", "name"], "left_semi")
