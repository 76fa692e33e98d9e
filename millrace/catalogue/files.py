"""Landed files in, tables and exports out."""

from __future__ import annotations

import zlib
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.bronze import bronze_rows, results_count, typed_trips
from ..operators.checks import run_checks
from ..operators.rules import geo_rule, null_rule, range_rule
from ..plans import air_marts, observability, trip_marts
from ..plans.alerts import publish_message
from ..schemas import TRIP_NAMES
from ..session import scratch_path
from ..sinks import export, tables
from ..sources import landing, listing
from . import inputs as i
from .checks import FARE, GEO, NULLS
from .marts import ALL, FIRST_LOAD, PER_LOCATION
from .registry import query

TODAY = f"DATE '{i.RESULTS_DAY}'"


# --- sources -----------------------------------------------------------------------


@query("scan_csv_landing", i.over("trips", f"SELECT {ALL} FROM trips"))
def scan_csv_landing(spark, sf_dir):
    scan = landing.scan_csv(spark, i.landed(spark, sf_dir, "trips"))
    return typed_trips(
        scan.withColumns({"file_row_number": F.lit(None), "load_timestamp": F.lit(None)}),
        at_once=True,
    ).select(*TRIP_NAMES)


@query("scan_csv_split", i.over("trips", f"SELECT {ALL} FROM trips"))
def scan_csv_split(spark, sf_dir):
    """The same files read by contract, so that a large file is split into blocks."""
    scan = landing.scan_csv(spark, i.landed(spark, sf_dir, "trips"), TRIP_NAMES)
    return typed_trips(
        scan.withColumns({"file_row_number": F.lit(None), "load_timestamp": F.lit(None)}),
        at_once=True,
    ).select(*TRIP_NAMES)


def _element(name: str, kind: str):
    return F.try_variant_get("raw_data", f"$.{name}", kind)


@query(
    "scan_json_landing",
    i.over("readings", "SELECT event_id, location_id, sensor_id, pm25_value FROM readings"),
)
def scan_json_landing(spark, sf_dir):
    path = i.landed(spark, sf_dir, "reading-arrays")
    return landing.scan_json(spark, path, strip_outer_array=True).select(
        _element("event_id", "bigint").alias("event_id"),
        _element("location_id", "bigint").alias("location_id"),
        _element("sensor_id", "bigint").alias("sensor_id"),
        _element("latest_value", "double").alias("pm25_value"),
    )


@query(
    "copy_openaq_json",
    i.over(
        "readings",
        f"""SELECT sensor_id, CAST(sum(n) AS BIGINT) AS readings, count(*) AS documents
FROM (SELECT sensor_id, count(*) AS n FROM readings
 GROUP BY sensor_id, event_id // {i.READINGS_PER_DOCUMENT}) d
WHERE n > 1 GROUP BY sensor_id""",
    ),
)
def copy_openaq_json(spark, sf_dir):
    """Documents stay whole; the cut-off ones are skipped."""
    docs = landing.scan_documents(spark, i.landed(spark, sf_dir, "documents"), i.READINGS_CLOCK)
    first = F.try_variant_get("raw_data", "$.results[0].sensor_id", "bigint")
    return (
        docs.groupBy(first.alias("sensor_id"))
        .agg(
            F.sum(results_count(F.col("raw_data"))).alias("readings"),
            F.count(F.lit(1)).alias("documents"),
        )
    )


@query(
    "malformed_records",
    i.over(
        "readings",
        f"""SELECT count(*) AS records, count(*) FILTER (WHERE n = 1) AS malformed
FROM (SELECT count(*) AS n FROM readings
 GROUP BY sensor_id, event_id // {i.READINGS_PER_DOCUMENT}) d""",
    ),
)
def malformed_records(spark, sf_dir):
    return landing.malformed_count(spark, i.landed(spark, sf_dir, "documents"))


@query(
    "copy_report",
    i.over(
        "readings",
        f"""SELECT reason, text, count(*) AS n FROM (
SELECT CASE WHEN count(*) = 1 THEN 'MALFORMED_JSON' END AS reason,
 CASE WHEN count(*) = 1 THEN '{{"results":[{{bad' END AS text FROM readings
 GROUP BY sensor_id, event_id // {i.READINGS_PER_DOCUMENT}) d
WHERE reason IS NOT NULL GROUP BY reason, text""",
    ),
)
def copy_report(spark, sf_dir):
    """What the copy of the documents left out, in full and with the reason."""
    found = landing.rejected_texts(spark, i.landed(spark, sf_dir, "documents"))
    return found.groupBy("reason", "text").agg(F.count(F.lit(1)).alias("n"))


@query(
    "file_lineage",
    i.over(
        "trips",
        """SELECT count(*) AS row_count, count(*) AS distinct_rows, true AS numbered_without_gap
FROM trips""",
    ),
)
def file_lineage(spark, sf_dir):
    """Every landed row has its file and row number: no pair twice, numbers 1 to n in
    each file."""
    scan = landing.scan_csv(spark, i.landed(spark, sf_dir, "trips"), TRIP_NAMES)
    pairs = (
        bronze_rows(scan, "CSV", i.RESULTS_CLOCK)
        .groupBy("file_name", "file_row_number")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    per_file = pairs.groupBy("file_name").agg(
        F.sum("n").alias("row_count"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.min("file_row_number").alias("low"),
        F.max("file_row_number").alias("high"),
    )
    dense = (F.col("low") == 1) & (F.col("high") == F.col("distinct_rows"))
    return per_file.agg(
        F.sum("row_count").alias("row_count"),
        F.sum("distinct_rows").alias("distinct_rows"),
        F.bool_and(dense).alias("numbered_without_gap"),
    )


@query(
    "file_inventory",
    f"""SELECT 'nation-' || c_nationkey AS prefix,
 CAST(ceil(count(*) / {i.FILE_LINES}) AS BIGINT) AS files, CAST(0 AS BIGINT) AS empty_files,
 CAST(sum(strlen(c_name) + 1) AS BIGINT) AS total_size, CAST(0 AS BIGINT) AS without_time
FROM customer GROUP BY c_nationkey
UNION ALL SELECT 'none-' || n, 1, 1, 0, 0 FROM range({i.EMPTY_FOLDERS}) t(n)""",
)
def file_inventory(spark, sf_dir):
    """Files, empty files and bytes for each prefix; all have a time."""
    files = listing.file_inventory(spark, i.landed(spark, sf_dir, "prefixes"))
    prefix = F.regexp_extract("key", "prefix=([^/]+)/", 1)
    return files.groupBy(prefix.alias("prefix")).agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if("is_empty").alias("empty_files"),
        F.sum("size").alias("total_size"),
        F.count_if(F.col("last_modified").isNull()).alias("without_time"),
    )


_HOST = "regexp_extract(url, '^(https?://[^/]+)', 1)"


@query(
    "latest_files_per_prefix",
    f"""SELECT prefix, url FROM (SELECT url, {_HOST} AS prefix,
 row_number() OVER (PARTITION BY {_HOST} ORDER BY url DESC) AS rn FROM pages) p WHERE rn <= 3""",
)
def latest_files_per_prefix(spark, sf_dir):
    host = F.regexp_extract("url", "^(https?://[^/]+)", 1)
    pages = i.table(spark, sf_dir, "pages").select("url")
    return listing.latest_files(pages, "url", host).select("prefix", "url")


_TABLES = (
    "benchmark conversations customer documents embeddings events labels lineitem nation "
    "orders pages part region supplier"
).split()


@query(
    "catalog_scan",
    "\nUNION ALL ".join(
        f"""SELECT '{t}' AS table_name, (SELECT count(*) FROM (DESCRIBE {t})) AS column_count,
 (SELECT count(*) FROM {t}) AS row_count"""
        for t in _TABLES
    ),
)
def catalog_scan(spark, sf_dir):
    """Registered tables with their columns and the row counts that the catalog holds."""
    database = _registered(spark, sf_dir)
    columns = listing.catalog_columns(spark, database).groupBy("table_name").agg(
        F.count(F.lit(1)).alias("column_count")
    )
    return (
        listing.catalog_tables(spark, database)
        .join(columns, "table_name")
        .select("table_name", "column_count", "row_count")
    )


@query(
    "catalog_columns",
    "\nUNION ALL ".join(
        f"""SELECT '{t}' AS table_name, column_name,
 CAST(row_number() OVER () AS INTEGER) AS position FROM (DESCRIBE {t})"""
        for t in _TABLES
        if t.startswith(("customer", "part"))
    ),
)
def catalog_columns(spark, sf_dir):
    """The columns of the tables whose names match a pattern, in order."""
    found = listing.catalog_columns(spark, _registered(spark, sf_dir), "customer*|part*")
    return found.select("table_name", "column_name", "position")


def _registered(spark, sf_dir) -> str:
    """All tables of a folder in a database of the session catalog."""
    database = f"tables_{zlib.crc32(sf_dir.encode()):08x}"
    listing.register_tables(
        spark, database, {t: f"{sf_dir}/{t}.parquet" for t in _TABLES}, scratch_path(spark, "database")
    )
    return database


# --- sinks -------------------------------------------------------------------------


@query(
    "bronze_append",
    i.over(
        "trips readings",
        """SELECT 'CSV' AS source_format, count(*) AS row_count FROM trips
UNION ALL SELECT 'JSON', count(*) FROM readings""",
    ),
)
def bronze_append(spark, sf_dir):
    path = scratch_path(spark, "bronze")
    csv = landing.scan_csv(spark, i.landed(spark, sf_dir, "packed-trips"), TRIP_NAMES)
    json = landing.scan_json(
        spark, i.landed(spark, sf_dir, "reading-arrays"), strip_outer_array=True
    )
    tables.append_bronze(bronze_rows(csv, "CSV", i.RESULTS_CLOCK), path)
    tables.append_bronze(bronze_rows(json, "JSON", i.RESULTS_CLOCK), path)
    bronze = tables.read_bronze(spark, path)
    return bronze.groupBy("source_format").agg(F.count(F.lit(1)).alias("row_count"))


_APPENDED = "\nUNION ALL ".join(
    f"""SELECT '{run}' AS run_id, '{name}' AS check_name,
 count(*) FILTER (WHERE {condition}) AS issue_count,
 count(*) FILTER (WHERE {condition}) AS violations FROM trips"""
    for run in ("run-1", "run-2")
    for name, condition in (("NON_NULL", NULLS), ("NUM_RANGE", FARE), ("GEO_BOUNDS", GEO))
)


@query("append_results", i.over("trips", _APPENDED))
def append_results(spark, sf_dir):
    """Two runs, the second written twice: results per run and check, each once."""
    root = scratch_path(spark, "results")
    trips = i.trips(spark, sf_dir)
    for run_id in ("run-1", "run-2", "run-2"):
        run = run_checks(
            trips, [null_rule(), range_rule(), geo_rule()], as_of=i.RESULTS_CLOCK, run_id=run_id
        ).pinned()
        tables.append_results(run.result, root)
    audit = tables.read_results(spark, root, "audit_log")
    names = {
        "RULE_NON_NULL": "NON_NULL",
        "RULE_FARE_RANGE": "NUM_RANGE",
        "RULE_GEO_VERIFY": "GEO_BOUNDS",
    }
    found = (
        tables.read_results(spark, root, "violations")
        .replace(names, subset=["rule_name"])
        .groupBy("run_id", F.col("rule_name").alias("check_name"))
        .agg(F.count(F.lit(1)).alias("violations"))
    )
    return (
        audit.select("run_id", "check_name", "issue_count")
        .join(found, ["run_id", "check_name"], "left")
        .select("run_id", "check_name", "issue_count", "violations")
    )


def first_load(trips: DataFrame) -> DataFrame:
    return trips.where(
        F.col("pickup_datetime") < F.lit(i.FIRST_LOAD_BEFORE).cast("timestamp_ntz")
    )


@query("merge_insert_only", i.over("silver", f"SELECT {ALL} FROM silver"))
def merge_insert_only(spark, sf_dir):
    """Early trips first, then all trips, then all trips again as a replay."""
    path = scratch_path(spark, "merged")
    rows = i.silver(spark, sf_dir, lineage=True)
    lineage = ["__source_file", "__row_num"]
    loads = [("load-1", first_load(rows)), ("load-2", rows), ("load-2", rows)]
    for load_id, part in loads:  # of a parquet table, cheap to read again
        tables.merge_insert_only(part, path, load_id, spread_by=lineage, persist_source=False)
    return tables.read_merged(spark, path).select(*TRIP_NAMES)


_EXPORT_TEXT = "strftime(run_timestamp, '%Y-%m-%d %H:%M:%S.%g')"
_ON_DAY = f"CAST(run_timestamp AS DATE) = {TODAY}"


@query(
    "export_audit_json",
    i.over(
        "audit",
        f"""SELECT log_id, {_EXPORT_TEXT} AS run_timestamp, table_name, check_name, status,
 row_count, issue_count, false AS has_details FROM audit WHERE {_ON_DAY}""",
    ),
)
def export_audit_json(spark, sf_dir):
    path = export.export_json(
        i.audit(spark, sf_dir),
        export.AUDIT_KEYS,
        i.RESULTS_DAY,
        scratch_path(spark, "export"),
        "dq_audit_log",
    )
    schema = (
        "log_id bigint, run_timestamp string, table_name string, check_name string, "
        "status string, row_count bigint, issue_count bigint"
    )
    text = spark.read.text(path)
    return text.select(
        F.from_json("value", schema).alias("d"),
        F.array_contains(F.json_object_keys("value"), "details").alias("has_details"),
    ).select("d.*", "has_details")


@query(
    "export_metrics_json",
    i.over(
        "metrics",
        f"""SELECT metric_id, {_EXPORT_TEXT} AS run_timestamp, table_name, metric_name,
 metric_value, threshold, passed FROM metrics WHERE {_ON_DAY}""",
    ),
)
def export_metrics_json(spark, sf_dir):
    path = export.export_json(
        i.metrics(spark, sf_dir),
        export.METRIC_KEYS,
        i.RESULTS_DAY,
        scratch_path(spark, "export"),
        "dq_metrics",
    )
    return spark.read.schema(
        "metric_id bigint, run_timestamp string, table_name string, metric_name string, "
        "metric_value double, threshold double, passed boolean"
    ).json(path)


@query(
    "export_all",
    i.over(
        "audit metrics",
        f"""SELECT true AS ok, 'DQ results exported for {i.RESULTS_DAY}' AS message,
 (SELECT count(*) FROM audit WHERE {_ON_DAY}) AS audit_rows,
 (SELECT count(*) FROM metrics WHERE {_ON_DAY}) AS metric_rows""",
    ),
)
def export_all(spark, sf_dir):
    root = scratch_path(spark, "export")
    status = export.export_all(
        i.audit(spark, sf_dir), i.metrics(spark, sf_dir), i.RESULTS_DAY, root
    )
    metric_rows = spark.read.text(f"{root}/dq_metrics/{i.RESULTS_DAY}").agg(F.count(F.lit(1)))
    return spark.read.text(f"{root}/dq_audit_log/{i.RESULTS_DAY}").agg(
        F.lit(status.ok).alias("ok"),
        F.lit(status.message).alias("message"),
        F.count(F.lit(1)).alias("audit_rows"),
        metric_rows.scalar().alias("metric_rows"),
    )


SECOND_SNAPSHOT_FROM = "1997-07-01 00:00:00"
_SNAPSHOT = f"""
, old_days AS (SELECT CAST(pickup_datetime AS DATE) AS trip_date, count(*) AS total_trips
 FROM silver WHERE pickup_datetime < {FIRST_LOAD} GROUP BY trip_date),
 new_days AS (SELECT CAST(pickup_datetime AS DATE) AS trip_date, count(*) AS total_trips
 FROM silver WHERE pickup_datetime >= TIMESTAMP '{SECOND_SNAPSHOT_FROM}' GROUP BY trip_date)
SELECT coalesce(n.trip_date, o.trip_date) AS trip_date,
 coalesce(n.total_trips, o.total_trips) AS total_trips, n.trip_date IS NOT NULL AS is_new
FROM new_days n FULL JOIN old_days o ON n.trip_date = o.trip_date"""


@query("kpi_snapshot_upsert", i.over("silver", _SNAPSHOT))
def kpi_snapshot_upsert(spark, sf_dir):
    """A snapshot of the early days, then one of all days from some time before their end: days
    in both are updated, earlier ones kept and later ones appended. Every trip counts."""
    root = scratch_path(spark, "snapshot")
    rows = i.silver(spark, sf_dir)
    earlier = trip_marts.daily_kpi(first_load(rows)).select("trip_date", "total_trips")
    since = F.lit(SECOND_SNAPSHOT_FROM).cast("timestamp_ntz")
    later = trip_marts.daily_kpi(rows.where(F.col("pickup_datetime") >= since))
    tables.upsert_snapshot(earlier, root, ["trip_date"], "2024-01-29 00:30:00")
    result = tables.upsert_snapshot(
        later.select("trip_date", "total_trips"), root, ["trip_date"], "2024-01-30 00:30:00"
    )
    is_new = F.col("snapshot_at") == F.lit("2024-01-30 00:30:00").cast("timestamp_ntz")
    return result.select("trip_date", "total_trips", is_new.alias("is_new"))


_TARGETS = ["NYC_Taxi_KPIs", "Pipeline_Health", "OpenAQ_KPIs"]


PUBLISHED = f"""SELECT 'NYC_Taxi_KPIs' AS target,
 least(count(DISTINCT CAST(pickup_datetime AS DATE)), 30) AS row_count FROM silver
UNION ALL SELECT 'Pipeline_Health', 2
UNION ALL SELECT 'OpenAQ_KPIs', count(*) FROM ({PER_LOCATION}) k"""


def published_text(run: str) -> str:
    """Subject and message of a publication as SQL; ``run`` gives the text of its clock."""
    return f"""'✅ KPIs published' AS subject,
 'KPI publish complete.' || chr(10) || chr(10) || '✅ NYC_Taxi_KPIs — rows written' || chr(10)
 || '✅ Pipeline_Health — rows written' || chr(10) || '✅ OpenAQ_KPIs — rows written' || chr(10)
 || chr(10) || 'Time: ' || {run} AS message"""


@query(
    "publish_message",
    i.over(
        "silver readings",
        f"SELECT target, row_count, {published_text(f"'{i.READINGS_CLOCK}'")} FROM ({PUBLISHED}) t",
    ),
)
def publish_kpis(spark, sf_dir):
    """The three KPI frames written as keyed snapshots behind one pointer, and the message."""
    frames, root = kpi_frames(spark, sf_dir, i.READINGS_CLOCK), scratch_path(spark, "kpis")
    written = tables.publish_snapshots(frames, root, i.READINGS_CLOCK)
    return with_text(target_rows(written), publish_message(spark, list(written), i.READINGS_CLOCK))


def kpi_frames(spark, sf_dir, as_of):
    """The published targets, their rows and keys."""
    readings = i.readings(spark, sf_dir)
    days = trip_marts.newest_days(trip_marts.daily_kpi(i.silver(spark, sf_dir)))
    health = observability.health_summary(i.audit(spark, sf_dir), readings, as_of)
    places = air_marts.location_kpi(readings, as_of)
    keys = (["trip_date"], ["dataset"], ["location_id", "parameter", "unit"])
    return dict(zip(_TARGETS, zip((days, health, places), keys)))


def with_text(rows: DataFrame, text: DataFrame) -> DataFrame:
    """Rows with the subject and message of a text of one row."""
    return rows.withColumns({c: text.select(c).scalar() for c in ("subject", "message")})


def target_rows(published: dict[str, DataFrame]) -> DataFrame:
    """Target and number of rows."""
    counted = [
        frame.agg(F.lit(target).alias("target"), F.count(F.lit(1)).alias("row_count"))
        for target, frame in published.items()
    ]
    return reduce(DataFrame.unionByName, counted)

