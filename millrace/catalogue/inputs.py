"""Bridge views: the driver's tables in the shape of trips, readings and results.

The tables hold no faults, so the views plant NULLs and bad values by key. Each view
exists as a DataFrame and as the SQL text the other engine runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions.bands import air_category
from ..functions.times import clock
from ..operators.silver import silver_filter
from ..schemas import TRIP_CONTRACT, TRIP_NAMES
from ..session import scratch_path

READINGS_CLOCK = "2024-02-10 00:00:00"
RESULTS_CLOCK = "2024-01-30 12:00:00"
RESULTS_DAY = "2024-01-30"
FIRST_LOAD_BEFORE = "1998-01-01 00:00:00"  # an earlier load holds trips before this time
READINGS_PER_DOCUMENT = 500
INDENTED = 100  # event ids of one indented document
FILE_LINES, EMPTY_FOLDERS = 100, 3
PACKED_ROWS = 1_000_000  # most rows of a packed file of trips
EVEN_ROWS = 250_000  # rows that a task takes however few others have
_TRIP_TABLE = (
    ", ".join(f"{name} {kind}" for name, kind in TRIP_CONTRACT.items())
    + ", __source_file string, __row_num bigint"
)

# --- DataFrames --------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trips(spark: SparkSession, sf_dir: str, lineage: bool = False) -> DataFrame:
    """The 18 trip columns; ``lineage`` adds the file and row each trip came from.

    Read from a typed table that Spark derives from ``lineitem`` once per application,
    as a trip table would be kept: filters and column lists then reach a parquet scan.
    """
    rows = spark.read.schema(_TRIP_TABLE).parquet(landed(spark, sf_dir, "trip-table"))
    return rows if lineage else rows.select(*TRIP_NAMES)


def _uneven(scan: DataFrame) -> bool:
    """Whether one task gets more than one and a half times its share of a scan, and more than ``EVEN_ROWS``.
    Counts rows by task, without their columns: one row a task is looked at."""
    tasks = scan.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"))
    seen = tasks.agg(F.max("n").alias("most"), F.sum("n").alias("rows")).first()
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return bool(seen.rows) and seen.most > max(EVEN_ROWS, 1.5 * seen.rows / cores)


def trip_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips out of ``lineitem``. The lines are dealt out first where one task would have to
    evaluate far more of them than others: a file may be a single row group."""
    lines = table(spark, sf_dir, "lineitem").select(
        "*",
        F.col("_metadata.file_name").alias("__source_file"),
        F.col("_metadata.row_index").alias("__row_num"),
    )
    if _uneven(table(spark, sf_dir, "lineitem")):
        lines = lines.hint("rebalance", "__row_num")  # by a column: nothing is sorted for it
    seconds = (
        (F.col("l_partkey") % 24) * 3600 + (F.col("l_suppkey") % 60) * 60 + F.col("l_orderkey") % 60
    )
    day = F.to_date("l_shipdate").cast("timestamp_ntz")
    picked_up = F.timestamp_add("SECOND", seconds, day)
    dropped_off = F.timestamp_add("SECOND", seconds + 20 * 60, day)
    price = "CAST(l_extendedprice AS DECIMAL(18,2))"
    columns = [
        F.when(F.col("l_orderkey") % 97 != 0, picked_up).alias("pickup_datetime"),
        F.when(F.col("l_orderkey") % 101 != 0, dropped_off).alias("dropoff_datetime"),
        F.expr("IF(l_partkey % 89 = 0, NULL, CAST(l_linenumber AS BIGINT)) AS passenger_count"),
        F.expr("CAST(l_quantity AS DECIMAL(18,2)) AS trip_distance"),
        F.expr(
            "CASE WHEN l_partkey % 251 = 0 THEN 200D WHEN l_partkey % 83 = 0 THEN NULL "
            "ELSE (l_partkey % 200 - 7500) / 100D END AS pickup_longitude"
        ),
        F.expr(
            "IF(l_suppkey % 53 = 0, 95D, (l_suppkey % 100 + 4000) / 100D) AS pickup_latitude"
        ),
        F.expr("CAST(l_linenumber % 6 AS STRING) AS rate_code"),
        F.expr("IF(l_linestatus = 'F', 'Y', 'N') AS store_and_fwd_flag"),
        F.expr("(l_orderkey % 200 - 7500) / 100D AS dropoff_longitude"),
        F.expr("(l_orderkey % 100 + 4000) / 100D AS dropoff_latitude"),
        F.expr(
            "CASE l_returnflag WHEN 'A' THEN 'CARD' WHEN 'N' THEN 'CASH' ELSE 'DISPUTE' END "
            "AS payment_type"
        ),
        F.expr(
            f"IF(l_partkey % 103 = 0, NULL, CAST({price} * 0.005 - 5 AS DECIMAL(18,2))) "
            "AS fare_amount"
        ),
        F.expr("CAST(0.50 AS DECIMAL(18,2)) AS extra"),
        F.expr("CAST(0.50 AS DECIMAL(18,2)) AS mta_tax"),
        F.expr("CAST(l_discount * 100 AS DECIMAL(18,2)) AS tip_amount"),
        F.expr("CAST(l_tax * 100 AS DECIMAL(18,2)) AS tolls_amount"),
        F.expr("CAST(0.30 AS DECIMAL(18,2)) AS improvement_surcharge"),
        F.expr(f"CAST({price} * 0.006 AS DECIMAL(18,2)) AS total_amount"),
    ]
    return lines.select(*columns, "__source_file", "__row_num")


def silver(spark: SparkSession, sf_dir: str, lineage: bool = False) -> DataFrame:
    return silver_filter(trips(spark, sf_dir, lineage)).withColumn(
        "__silver_loaded_ts", clock(RESULTS_CLOCK)
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.expr("IF(event_id % 7 = 0, NULL, value)")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.expr("IF(user_id % 41 = 0, NULL, user_id % 20) AS location_id"),
        F.col("user_id").alias("sensor_id"),
        F.lit("pm25").alias("parameter"),
        F.lit("ug/m3").alias("unit"),
        value.alias("pm25_value"),
        F.expr("IF(event_id % 11 = 0, NULL, ts) AS reading_time"),
        air_category(value).alias("who_category"),
    )


_RESULT_TABLE = (
    "CASE event_id % 4 WHEN 0 THEN 'silver' WHEN 1 THEN 'OPENAQ_FLATTENED' "
    "WHEN 2 THEN 'bronze' ELSE 'nyc_taxi' END AS table_name"
)


def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS log_id",
        "ts AS run_timestamp",
        _RESULT_TABLE,
        "event_type AS check_name",
        "CASE WHEN value > 50 THEN 'FAIL' ELSE 'PASS' END AS status",
        "(event_id % 10) * 100 AS row_count",
        "CAST(floor(value) AS BIGINT) AS issue_count",
    )


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS metric_id",
        "ts AS run_timestamp",
        _RESULT_TABLE,
        "event_type AS metric_name",
        "value AS metric_value",
        "CAST(60 AS DOUBLE) AS threshold",
        "CASE WHEN event_id % 101 = 0 THEN NULL ELSE value <= 60 END AS passed",
    )


def reading_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings packed into JSON documents, one per sensor and block of event ids: at
    most ``READINGS_PER_DOCUMENT`` readings each, however busy a sensor is."""
    rows = readings(spark, sf_dir).withColumn(
        "block", F.floor(F.col("event_id") / READINGS_PER_DOCUMENT)
    )
    element = F.struct(
        "event_id",
        "location_id",
        "sensor_id",
        "parameter",
        "unit",
        F.col("pm25_value").alias("latest_value"),
        F.col("reading_time").cast("string").alias("latest_time"),
    )
    return rows.groupBy("sensor_id", "block").agg(
        F.to_json(F.struct(F.collect_list(element).alias("results"))).alias("document"),
        F.count(F.lit(1)).alias("readings"),
    )


def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reading_documents(spark, sf_dir).select(
        clock(READINGS_CLOCK).alias("ingest_ts"),
        F.concat(F.lit("sensor_"), F.col("sensor_id").cast("string")).alias("source_file"),
        F.parse_json("document").alias("raw_data"),
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips as bronze rows: the 18 columns inside one variant."""
    return trips(spark, sf_dir, lineage=True).select(
        F.parse_json(F.to_json(F.struct(*TRIP_NAMES))).alias("raw_data"),
        F.col("__source_file").alias("file_name"),
        F.col("__row_num").alias("file_row_number"),
        clock(RESULTS_CLOCK).alias("load_timestamp"),
        F.lit("JSON").alias("source_format"),
    )


# --- landed files, written once per application and input folder ---------------

_landed: dict[tuple, str] = {}


def _stored(spark: SparkSession, path: str) -> tuple[int, int]:
    """Bytes and modification time of a file or folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return (
        fs.getContentSummary(place).getLength(),
        fs.getFileStatus(place).getModificationTime(),
    )


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def landed(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """The path of landed files of one kind, derived from the tables by Spark."""
    origin = _stored(spark, f"{sf_dir}/{_ORIGIN[kind]}.parquet")
    spot = (spark.sparkContext.applicationId, sf_dir, kind, origin)
    if spot not in _landed or not _exists(spark, _landed[spot]):
        path = scratch_path(spark, f"landing-{kind}")
        _WRITERS[kind](spark, sf_dir, path)
        _landed[spot] = path
    return _landed[spot]


def _write_trip_csv(spark: SparkSession, sf_dir: str, path: str) -> None:
    trips(spark, sf_dir).write.option("header", True).csv(path)


def write_packed(trips: DataFrame, path: str) -> None:
    """One delivery of packed trip files. Such a file is read by one task, so its rows are limited."""
    (
        trips.select(*TRIP_NAMES)
        .write.mode("append")
        .option("header", True)
        .option("compression", "gzip")
        .option("zlib.compress.level", "BEST_SPEED")
        .option("maxRecordsPerFile", PACKED_ROWS)
        .csv(path)
    )


def _write_packed_trips(spark: SparkSession, sf_dir: str, path: str) -> None:
    write_packed(trip_bridge(spark, sf_dir), path)


def _write_reading_arrays(spark: SparkSession, sf_dir: str, path: str) -> None:
    arrays = reading_documents(spark, sf_dir).select(
        F.get_json_object("document", "$.results").alias("value")
    )
    arrays.write.text(path)


def _write_documents(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Documents as they arrive: those with a single reading are cut off (no valid JSON)."""
    broken = F.col("readings") == 1
    texts = reading_documents(spark, sf_dir).select(
        F.when(broken, F.lit('{"results":[{bad')).otherwise(F.col("document")).alias("value")
    )
    texts.write.text(path)


def _write_indented(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Indented documents, a file each: an array of the readings of ``INDENTED`` event ids. By
    number, some are JSON lines, some are cut off, and some have an element that is no record."""
    element = F.struct(
        "event_id", "location_id", "sensor_id", F.col("pm25_value").alias("latest_value")
    )
    blocks = (
        readings(spark, sf_dir)
        .groupBy(F.floor(F.col("event_id") / INDENTED).alias("block"))
        .agg(F.collect_list(element).alias("results"))
    )
    document = F.to_json("results", {"pretty": "true"})
    kind = F.col("block") % 5
    text = (
        F.when(kind == 3, F.substring(document, F.lit(1), (F.length(document) / 2).cast("int")))
        .when(kind == 4, F.concat(F.regexp_replace(document, r"\s*\]\s*$", ""), F.lit(",\n  7\n]")))
        .when(F.col("block") % 10 == 0, F.array_join(F.transform("results", lambda r: F.to_json(r)), "\n"))
        .otherwise(document)
    )
    blocks.select(text.alias("value")).write.option("maxRecordsPerFile", 1).text(path)


def _write_prefixes(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Customer names in a folder for each nation, at most ``FILE_LINES`` a file, and folders
    that hold an empty file."""
    names = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("nation-"), F.col("c_nationkey").cast("string")).alias("prefix"),
        F.col("c_name").alias("value"),
    )
    (
        names.repartition("prefix")
        .write.partitionBy("prefix")
        .option("maxRecordsPerFile", FILE_LINES)
        .text(path)
    )
    for n in range(EMPTY_FOLDERS):
        spark.createDataFrame([], "value string").coalesce(1).write.text(f"{path}/prefix=none-{n}")


def _write_metrics(spark: SparkSession, sf_dir: str, path: str) -> None:
    metrics(spark, sf_dir).write.parquet(path)


def _write_trip_table(spark: SparkSession, sf_dir: str, path: str) -> None:
    trip_bridge(spark, sf_dir).write.parquet(path)


_ORIGIN = {
    "trip-table": "lineitem",
    "trips": "lineitem",
    "packed-trips": "lineitem",
    "reading-arrays": "events",
    "documents": "events",
    "indented": "events",
    "prefixes": "customer",
    "metrics": "events",
}
_WRITERS = {
    "trip-table": _write_trip_table,
    "trips": _write_trip_csv,
    "packed-trips": _write_packed_trips,
    "reading-arrays": _write_reading_arrays,
    "documents": _write_documents,
    "indented": _write_indented,
    "prefixes": _write_prefixes,
    "metrics": _write_metrics,
}

# --- bands as SQL: the fixed ladders, in their order ------------------------------


def ladder(bands, test: str, rest: str, missing: str = "") -> str:
    """A CASE of ``(edge, label)`` pairs; ``test`` has a place for the edge."""
    steps = " ".join(f"WHEN {test.format(edge)} THEN '{label}'" for edge, label in bands)
    return f"CASE {missing} {steps} ELSE '{rest}' END"


def air_sql(value: str) -> str:
    missing = f"WHEN {value} IS NULL THEN '{fv.AIR_MISSING}'"
    return ladder(fv.AIR_BANDS, value + " > {}", fv.AIR_LOWEST, missing)


def fare_sql(fare: str) -> str:
    missing = f"WHEN {fare} IS NULL THEN '{fv.FARE_MISSING}'"
    return ladder(fv.FARE_BANDS, fare + " < {}", fv.FARE_HIGHEST, missing)


def freshness_sql(moment: str, now: str) -> str:
    return ladder(fv.FRESHNESS_BANDS, f"{moment} >= {now} - INTERVAL {{}} DAY", fv.FRESHNESS_OLDEST)


def score_sql(score: str) -> str:
    return ladder(fv.SCORE_BANDS, score + " < {}", fv.SCORE_TOP, f"WHEN {score} IS NULL THEN NULL")


# --- the same views as SQL -----------------------------------------------------

_VIEWS = {
    "trips": """
SELECT l_orderkey, l_linenumber,
 CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE p END AS pickup_datetime,
 CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE p + INTERVAL 20 MINUTE END AS dropoff_datetime,
 CASE WHEN l_partkey % 89 = 0 THEN NULL ELSE CAST(l_linenumber AS BIGINT) END AS passenger_count,
 CAST(l_quantity AS DECIMAL(18,2)) AS trip_distance,
 CASE WHEN l_partkey % 251 = 0 THEN CAST(200 AS DOUBLE) WHEN l_partkey % 83 = 0 THEN NULL
  ELSE CAST(-75 + (l_partkey % 200) * 0.01 AS DOUBLE) END AS pickup_longitude,
 CASE WHEN l_suppkey % 53 = 0 THEN CAST(95 AS DOUBLE)
  ELSE CAST(40 + (l_suppkey % 100) * 0.01 AS DOUBLE) END AS pickup_latitude,
 CAST(l_linenumber % 6 AS VARCHAR) AS rate_code,
 CASE WHEN l_linestatus = 'F' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
 CAST(-75 + (l_orderkey % 200) * 0.01 AS DOUBLE) AS dropoff_longitude,
 CAST(40 + (l_orderkey % 100) * 0.01 AS DOUBLE) AS dropoff_latitude,
 CASE l_returnflag WHEN 'A' THEN 'CARD' WHEN 'N' THEN 'CASH' ELSE 'DISPUTE' END AS payment_type,
 CASE WHEN l_partkey % 103 = 0 THEN NULL
  ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 0.005 - 5 AS DECIMAL(18,2)) END AS fare_amount,
 CAST(0.50 AS DECIMAL(18,2)) AS extra, CAST(0.50 AS DECIMAL(18,2)) AS mta_tax,
 CAST(l_discount * 100 AS DECIMAL(18,2)) AS tip_amount,
 CAST(l_tax * 100 AS DECIMAL(18,2)) AS tolls_amount,
 CAST(0.30 AS DECIMAL(18,2)) AS improvement_surcharge,
 CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 0.006 AS DECIMAL(18,2)) AS total_amount
FROM (SELECT *, CAST(CAST(CAST(l_shipdate AS DATE) AS VARCHAR) || ' '
  || lpad(CAST(l_partkey % 24 AS VARCHAR), 2, '0') || ':'
  || lpad(CAST(l_suppkey % 60 AS VARCHAR), 2, '0') || ':'
  || lpad(CAST(l_orderkey % 60 AS VARCHAR), 2, '0') AS TIMESTAMP) AS p FROM lineitem) x""",
    "silver": """
SELECT * FROM trips
WHERE pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL AND passenger_count IS NOT NULL
 AND fare_amount > 0 AND fare_amount < 500
 AND abs(pickup_latitude) <= 90 AND abs(dropoff_latitude) <= 90
 AND abs(pickup_longitude) <= 180 AND abs(dropoff_longitude) <= 180""",
    "bare_readings": """
SELECT event_id, CASE WHEN user_id % 41 = 0 THEN NULL ELSE user_id % 20 END AS location_id,
 user_id AS sensor_id, 'pm25' AS parameter, 'ug/m3' AS unit,
 CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS pm25_value,
 CASE WHEN event_id % 11 = 0 THEN NULL ELSE ts END AS reading_time
FROM events""",
    "readings": """
SELECT *, """ + air_sql("pm25_value") + """ AS who_category
FROM bare_readings""",
    "audit": f"""
SELECT event_id AS log_id, ts AS run_timestamp, {_RESULT_TABLE}, event_type AS check_name,
 CASE WHEN value > 50 THEN 'FAIL' ELSE 'PASS' END AS status,
 (event_id % 10) * 100 AS row_count, CAST(floor(value) AS BIGINT) AS issue_count
FROM events""",
    "metrics": f"""
SELECT event_id AS metric_id, ts AS run_timestamp, {_RESULT_TABLE}, event_type AS metric_name,
 value AS metric_value, CAST(60 AS DOUBLE) AS threshold,
 CASE WHEN event_id % 101 = 0 THEN NULL ELSE value <= 60 END AS passed
FROM events""",
}
_NEEDS = {"silver": ["trips"], "readings": ["bare_readings"]}


def over(views: str, body: str) -> str:
    """``body`` with the named views (blank-separated) in front of it."""
    wanted: list[str] = []
    for name in views.split():
        for part in [*_NEEDS.get(name, []), name]:
            if part not in wanted:
                wanted.append(part)
    return "WITH " + ",\n".join(f"{n} AS ({_VIEWS[n]})" for n in wanted) + "\n" + body


# --- SQL forms of the number rules ----------------------------------------------


def hu(value: str, places: int) -> str:
    """Half-up rounding of a value that is not negative."""
    scale = f"CAST({10**places} AS DOUBLE)"
    return f"(floor(({value}) * {scale} + CAST(0.5 AS DOUBLE)) / {scale})"


def share(part: str, whole: str) -> str:
    return f"(CAST({part} AS DOUBLE) * CAST(100 AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0))"


def failpct(part: str, whole: str) -> str:
    ratio = f"CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0)"
    return f"coalesce({ratio} * CAST(100 AS DOUBLE), 0)"


def mean(column: str) -> str:
    return f"(CAST(sum({column}) AS DOUBLE) / nullif(count({column}), 0))"


def exact(column: str) -> str:
    """The mean from an exact sum, in units of 2 ** -70: the tables' values are whole numbers
    of those, and their sum has 128 bits."""
    unit = "CAST(1180591620717411303424 AS DOUBLE)"
    total = f"CAST(sum(CAST(({column}) * {unit} AS HUGEINT)) AS DOUBLE) / {unit}"
    return f"({total} / nullif(count({column}), 0))"
