"""Result tables, bronze, silver and keyed snapshots on parquet.

Parquet has no transactions. Results and silver are listed by a manifest, bronze is
partitioned by load. One writer per table is assumed; a repeated write of the same run or load
leaves what that run or load wrote, once, and nothing else.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.times import clock
from ..operators.checks import CheckResult
from ..operators.silver import MERGE_KEY, dedup_latest, merge_rows_by_keys
from ..operators.skew import spreadable
from ..schemas import AUDIT, BRONZE, METRICS, VIOLATIONS, conform
from ..session import scratch_path
from . import manifest

SMALL_FILES = 64  # more small files than this are rewritten
FILE_ROWS = 4_000_000  # rows of a rewritten file
KEPT_ROWS = 1_000_000  # most rows of a load that are kept while it is merged


def append_bronze(rows: DataFrame, path: str) -> None:
    """Append rows of one load, partitioned by source format."""
    appended = rows.write.mode("append").option("compression", "zstd")
    appended.partitionBy("source_format").parquet(path)


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BRONZE).parquet(path)


#: Records and dead letters of landed texts, side by side.
RECORD, DEAD = "record", "dead"
LANDED_RECORDS = f"{BRONZE}, element int, reason string, text string, outcome string, load_id string"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of landed texts, in the bronze shape."""
    rows = spark.read.schema(LANDED_RECORDS).parquet(path).where(F.col("outcome") == RECORD)
    return conform(rows, BRONZE)


def dead_letters(spark: SparkSession, path: str) -> DataFrame:
    """Landed texts, or elements of their arrays, that are no records: where they were, why they
    were not taken, and the text itself."""
    rows = spark.read.schema(LANDED_RECORDS).parquet(path).where(F.col("outcome") == DEAD)
    return rows.select(
        "file_name", "file_row_number", "element", "reason", "text", "load_timestamp", "load_id"
    )


#: The three result frames, their time columns and schemas.
_RESULTS = {
    "audit_log": ("run_timestamp", AUDIT),
    "metrics": ("run_timestamp", METRICS),
    "violations": ("detected_at", VIOLATIONS),
}
_RESULT_SCHEMA = ", ".join(dict.fromkeys(", ".join(s for _, s in _RESULTS.values()).split(", ")))


def append_results(result: CheckResult, root: str) -> None:
    """Commit the three result frames of a run together: readers see all of them or none.
    Writing a run again replaces its rows.

    Violations come straight from the table scan, a few out of every task. They are
    rebalanced first, so that the number of files follows their volume and not the
    number of scan tasks. Days with many files are rewritten into a few."""
    spark = result.audit.sparkSession
    frames = (result.audit, result.metrics, result.violations.hint("rebalance"))
    rows = [
        conform(frame.withColumns({"kind": F.lit(kind), "run_date": F.to_date(moment)}), _STORED)
        for (kind, (moment, _)), frame in zip(_RESULTS.items(), frames)
    ]
    table = manifest.newest(spark, root)
    added = _result_files(reduce(DataFrame.unionByName, rows), root).persist()
    try:
        runs = [r.run_id for r in added.select(F.explode("runs").alias("run_id")).distinct().collect()]
        files = added
        if table is not None:
            again = F.arrays_overlap("runs", F.array(*map(F.lit, runs))) if runs else F.lit(False)
            files = files.unionByName(table.files.where(~again))
            shared = table.files.where(again & (F.size("runs") > 1))
            if not shared.isEmpty():  # rewritten files hold other runs as well
                others = _stored_results(spark, root, shared).where(~F.col("run_id").isin(runs))
                files = files.unionByName(_result_files(others, root))
        _publish_results(spark, root, files, table)
    finally:
        added.unpersist()
    compact_results(spark, root)


_STORED = f"{_RESULT_SCHEMA}, kind string, run_date date"


def _result_files(rows: DataFrame, root: str) -> DataFrame:
    """Write a commit of result rows; its manifest rows."""
    spark, commit = rows.sparkSession, f"commit={manifest.new_commit()}"
    path = manifest.data_path(root, commit)
    rows.write.partitionBy("kind", "run_date").parquet(path)
    name = F.regexp_extract(F.col("_metadata.file_path"), f"{commit}/(.*)$", 1)
    stored = spark.read.schema(_STORED).parquet(path)
    return stored.groupBy(name.alias("name"), "kind", "run_date").agg(
        F.lit(commit).alias("commit"),
        F.count(F.lit(1)).alias("rows"),
        F.collect_set("run_id").alias("runs"),  # the runs of a day at most
    )


def _publish_results(spark, root: str, files: DataFrame, after: manifest.Version | None) -> None:
    loads = spark.createDataFrame([], "load_id string")  # runs are listed with their files
    manifest.publish(spark, root, files, loads, after)
    manifest.expire(spark, root)


def _stored_results(spark: SparkSession, root: str, files: DataFrame) -> DataFrame:
    schema = StructType.fromDDL(f"{_STORED}, commit string")
    listed = manifest.paths(root, files)
    return manifest.read_files(spark, schema, listed, base=f"{root}/data").drop("commit")


def compact_results(spark: SparkSession, root: str, small_files: int = SMALL_FILES) -> bool:
    """Rewrite the files of days that have more than ``small_files`` of one frame, by their
    volume. True if files were rewritten."""
    table = manifest.newest(spark, root)
    day = Window.partitionBy("kind", "run_date")
    marked = table.files.withColumn("many", F.count(F.lit(1)).over(day) > small_files)
    if marked.where("many").isEmpty():
        return False
    rows = _stored_results(spark, root, marked.where("many")).hint("rebalance", "kind", "run_date")
    files = marked.where("NOT many").drop("many").unionByName(_result_files(rows, root))
    _publish_results(spark, root, files, table)
    return True


def read_results(
    spark: SparkSession,
    root: str,
    name: str,
    first_day: dt.date | str | None = None,
    last_day: dt.date | str | None = None,
) -> DataFrame:
    """A result table with its ``run_date``, as of the newest commit when called. Only files of
    the wanted days are listed; a filter on ``run_date`` prunes among them."""
    schema = f"{_RESULTS[name][1]}, run_date date"
    table = manifest.newest(spark, root)
    if table is None:
        return spark.createDataFrame([], schema)
    files = table.files.where(F.col("kind") == name)
    if first_day is not None:
        files = files.where(F.col("run_date") >= F.lit(str(first_day)).cast("date"))
    if last_day is not None:
        files = files.where(F.col("run_date") <= F.lit(str(last_day)).cast("date"))
    return conform(_stored_results(spark, root, files), schema)


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Create or replace a table as the result of a query, and read it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def merge_insert_only(
    source: DataFrame,
    path: str,
    load_id: str,
    key: Sequence[str] = MERGE_KEY,
    *,
    spread_by: Sequence[str] | None = None,
    prune: bool = True,
    persist_source: bool = True,
) -> None:
    """Insert the rows of ``source`` whose key the table at ``path`` lacks.

    The table is listed by a manifest (:mod:`millrace.sinks.manifest`) with the key range and a
    Bloom filter of every data file; with ``prune`` only the files that may hold a key of the
    source are opened. A load is committed as a whole, and once: repeating a committed load
    changes nothing, rows with a NULL key included. Files of many small loads are rewritten
    into a few, in the order of their keys, and what no version lists any more is removed, so
    neither files nor folders grow with the number of loads. Rows are written by the tasks that
    read them, in files as large as rewritten ones, so that a large load is not written twice. The
    source is read for its keys, which go to the scratch folder, and again for its rows. Where many keys
    are new between old ones it is read a few times more; with ``persist_source`` a load of no more than
    ``KEPT_ROWS`` rows is kept on the executors for that. A larger one would fill their disks.
    """
    spark = source.sparkSession
    table = manifest.newest(spark, path)
    if table and not table.loads.where(F.col("load_id") == load_id).isEmpty():
        return
    if table is None:
        _commit_load(_gathered(source, source.count()), path, load_id, key, None)
        return
    stage = scratch_path(spark, "keys")
    source.select(*key).write.option("compression", "zstd").parquet(stage)
    keys = spark.read.schema(source.select(*key).schema).parquet(stage)
    ends = manifest.key_range(keys, key)
    kept = persist_source and ends.rows <= KEPT_ROWS
    if kept:
        source = source.persist()
    try:
        files = table.files
        if prune:
            files = manifest.may_hold(spark, path, files, keys, key, ends)
        opened, here = manifest.paths(path, files), True
        added = source
        if opened:
            target = manifest.read_files(spark, _with_load(source).schema, opened).select(*key)
            held = files.agg(F.min("low").alias("low"), F.max("high").alias("high"))
            added, here = merge_rows_by_keys(
                source, target, key, keys=keys, ends=held, spread_by=spread_by, rows=ends.rows
            )
        _commit_load(_gathered(added, ends.rows) if here else added, path, load_id, key, table)
    finally:
        if kept:
            source.unpersist()


def _gathered(rows: DataFrame, count: int) -> DataFrame:
    """Rows in as many tasks, and so files, as ``count`` of them fill; in a small load as many as
    run side by side, but no more than ``SMALL_FILES``. Rows do not move."""
    beside = min(rows.sparkSession.sparkContext.defaultParallelism, SMALL_FILES)
    return rows.coalesce(max(1, beside, -(-count // FILE_ROWS)))


def _with_load(rows: DataFrame, load_id: str = "") -> DataFrame:
    return rows.withColumn("load_id", F.lit(load_id).cast("string"))


def _commit_load(
    rows: DataFrame, path: str, load_id: str, key: Sequence[str], after: manifest.Version | None
) -> None:
    rows = _with_load(rows, load_id)
    loads = rows.sparkSession.createDataFrame([(load_id,)], "load_id string")
    if after is not None:
        loads = after.loads.union(loads)
    _commit(rows, path, key, after.files if after else None, loads, after)
    compact(rows.sparkSession, path, rows.schema, key)


def _commit(
    rows: DataFrame,
    path: str,
    key: Sequence[str],
    others: DataFrame | None,
    loads: DataFrame,
    after: manifest.Version | None,
) -> None:
    """Write ``rows`` as a commit beside the files ``others``."""
    spark, commit = rows.sparkSession, manifest.new_commit()
    rows.write.option("compression", "zstd").parquet(manifest.data_path(path, commit))
    files = manifest.describe(spark, path, commit, rows.schema, key).persist()
    try:
        manifest.write_filters(spark, path, commit, rows.schema, key, files)
        manifest.publish(
            spark, path, files if others is None else others.unionByName(files), loads, after
        )
    finally:
        files.unpersist()


def compact(
    spark: SparkSession,
    path: str,
    schema: StructType,
    key: Sequence[str] = MERGE_KEY,
    *,
    small_files: int = SMALL_FILES,
    file_rows: int = FILE_ROWS,
) -> bool:
    """Rewrite the small files of a table, where there are more than ``small_files`` of them,
    into files of about ``file_rows`` rows in the order of the key, and remove what no recent
    version lists. True if files were rewritten."""
    table = manifest.newest(spark, path)
    small = table.files.where(F.col("rows") < file_rows // 2)
    found = small.agg(F.count(F.lit(1)).alias("n"), F.sum("rows").alias("rows")).first()
    done = found.n > small_files
    if done:
        rows = manifest.read_files(spark, schema, manifest.paths(path, small))
        ordered = rows.repartitionByRange(-(-found.rows // file_rows), *key, F.xxhash64(*spreadable(rows)))
        others = table.files.where(F.col("rows") >= file_rows // 2)
        _commit(ordered.sortWithinPartitions(*key), path, key, others, table.loads, table)
    manifest.expire(spark, path)
    return done


def read_merged(spark: SparkSession, path: str, load_id: str | None = None) -> DataFrame:
    """The merged table, or the rows that one load added: the newest version when called."""
    listed = manifest.paths(path, manifest.newest(spark, path).files)
    rows = spark.read.parquet(*listed) if listed else spark.read.parquet(f"{path}/data/*")
    if load_id is not None:
        rows = rows.where(F.col("load_id") == load_id)
    return rows.drop("load_id")


def upserted(
    old: DataFrame | None, new: DataFrame, key: Sequence[str], as_of: dt.datetime | str
) -> DataFrame:
    """A keyed snapshot after an append-or-update: for every key the newest row."""
    rows = new.withColumn("snapshot_at", clock(as_of))
    if old is not None:
        rows = old.unionByName(rows)
    return dedup_latest(rows, key, ["snapshot_at"])


def publish_snapshots(
    frames: dict[str, tuple[DataFrame, Sequence[str]]], root: str, as_of: dt.datetime | str
) -> dict[str, DataFrame]:
    """Upsert several keyed frames, ``{target: (rows, key)}``, behind one pointer: readers of
    :func:`read_published` see all targets of a publication or none. Every target is written to
    the publication's folder, and one version of the manifest names them all. Publishing again
    by the same clock changes nothing; a target that is not among ``frames`` stays as it is."""
    spark = next(iter(frames.values()))[0].sparkSession
    table, commit = manifest.newest(spark, root), manifest.new_commit()
    for target, (rows, key) in frames.items():
        old = _published(spark, root, table, target)
        path = f"{manifest.data_path(root, commit)}/{target}"
        upserted(old, rows, key, as_of).write.parquet(path)
    listed = spark.createDataFrame([(t, commit) for t in frames], "target string, commit string")
    if table is not None:
        listed = listed.unionByName(table.files.where(~F.col("target").isin(list(frames))))
    loads = spark.createDataFrame([], "load_id string")
    manifest.publish(spark, root, listed, loads, table)
    manifest.expire(spark, root)
    return {target: read_published(spark, root, target) for target in frames}


def _published(
    spark: SparkSession, root: str, table: manifest.Version | None, target: str
) -> DataFrame | None:
    place = table and table.files.where(F.col("target") == target).select("commit").first()
    return spark.read.parquet(f"{manifest.data_path(root, place[0])}/{target}") if place else None


def read_published(spark: SparkSession, root: str, target: str) -> DataFrame | None:
    """A target of the newest complete publication, or nothing."""
    return _published(spark, root, manifest.newest(spark, root), target)


def upsert_snapshot(
    new: DataFrame, root: str, key: Sequence[str], as_of: dt.datetime | str
) -> DataFrame:
    """Upsert ``new`` into the snapshot table below ``root``.

    Every upsert writes a new version folder named by its clock and leaves the old
    one readable; the newest folder is the table. Repeating the newest upsert rewrites its
    own version. An upsert that arrives late is merged into the newest version, row by row
    by clock, as a revision of that version.
    """
    spark = new.sparkSession
    version = str(as_of).replace(" ", "T").replace(":", "")
    newest = next(iter(_versions(spark, root)), version)
    late = newest > version
    old = read_snapshot(spark, root, before=None if late else version)
    result = upserted(old, new, key, as_of)
    path = f"{root}/version={_revision(newest) if late else version}"
    result.write.mode("overwrite").parquet(path)
    return spark.read.schema(result.schema).parquet(path)


def _revision(version: str) -> str:
    """The name of the next revision: it sorts after the version and before the next one."""
    clock_text, _, number = version.partition("_r")
    return f"{clock_text}_r{int(number or 0) + 1:06d}"


def _versions(spark: SparkSession, root: str) -> list[str]:
    """Names of the complete versions, newest first."""
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    top = path_of(root)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(top):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(top)]
    return [
        n.removeprefix("version=")
        for n in sorted(names, reverse=True)
        if n.startswith("version=") and fs.exists(path_of(f"{root}/{n}/_SUCCESS"))
    ]


def read_snapshot(spark: SparkSession, root: str, before: str | None = None) -> DataFrame | None:
    """The newest complete version (older than ``before``), or nothing."""
    for version in _versions(spark, root):
        if before is None or version < before:
            return spark.read.parquet(f"{root}/version={version}")
    return None
