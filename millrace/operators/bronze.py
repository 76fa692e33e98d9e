"""Bronze rows: lineage, row numbers, typed view, flattened readings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bands import air_category
from ..functions.times import clock, parsed_time
from ..schemas import BRONZE, READINGS, TRIP_CONTRACT, conform
from ..session import scratch_path

BROADCAST_FILES = 100_000  # most files whose blocks are sent to all executors


def with_row_numbers(scan: DataFrame, counted_first: bool = False) -> DataFrame:
    """1-based row number inside each file, without sorting any file.

    ``scan`` comes straight from :mod:`millrace.sources.landing` (no shuffle between):
    it has ``file_path`` and ``block_start``, and its rows are numbered as they leave the
    scan (or were, as ``scan_position``), so the numbers rise by one inside a file block. One row per block (first id, row
    count) gives every block its offset by running sums over the blocks of a file, and is
    joined back in the same plan, by broadcast where the scan has no more than
    ``BROADCAST_FILES`` files: rows are not shuffled. Nobody can tell that of a micro-batch. For
    it, ``counted_first`` writes the blocks to the scratch folder before: Spark then knows their
    size, and broadcasts them where its check allows.
    A scan that numbers its rows itself (``file_row_number``) is left as it is.
    A row whose block has no offset (the file was split in another way meanwhile) stops the
    job: no row is left out.
    """
    if "file_row_number" in scan.columns:
        return scan.drop("block_start")
    if "scan_position" not in scan.columns:
        scan = scan.withColumn("scan_position", F.monotonically_increasing_id())
    blocks = scan.groupBy("file_path", "block_start").agg(
        F.min("scan_position").alias("first_position"), F.count(F.lit(1)).alias("block_rows")
    )
    before = (
        Window.partitionBy("file_path")
        .orderBy("block_start")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = blocks.withColumn(
        "rows_before", F.coalesce(F.sum("block_rows").over(before), F.lit(0))
    ).drop("block_rows")
    number = F.col("scan_position") - F.col("first_position") + F.col("rows_before") + 1
    if counted_first:
        stage = scratch_path(scan.sparkSession, "blocks")
        offsets.write.parquet(stage)
        offsets = scan.sparkSession.read.schema(offsets.schema).parquet(stage)
    elif 0 < len(scan.inputFiles()) <= BROADCAST_FILES:
        offsets = F.broadcast(offsets)
    lost = F.raise_error(F.concat(F.lit("file block without offset: "), F.col("file_path")))
    return (
        scan.join(offsets, ["file_path", "block_start"], "left")
        .withColumn(
            "file_row_number",
            F.when(number.isNull() | (number < 1), lost.cast("bigint")).otherwise(
                number.cast("bigint")
            ),
        )
        .drop("first_position", "rows_before", "scan_position", "block_start")
    )


def bronze_rows(
    scan: DataFrame,
    source_format: str,
    as_of: dt.datetime | str | None = None,
    counted_first: bool = False,
) -> DataFrame:
    """Landed rows in the bronze shape, with load time and format tag."""
    loaded = F.localtimestamp() if as_of is None else clock(as_of)
    return conform(
        with_row_numbers(scan, counted_first).withColumns(
            {"load_timestamp": loaded, "source_format": F.lit(source_format)}
        ),
        BRONZE,
    )


def typed(payload: Column, name: str, kind: str) -> Column:
    """One key of a payload as a typed column; NULL if absent or not castable, so
    one bad value does not stop a load. (``variant_get`` is the strict form.)"""
    return F.try_variant_get(payload, f"$.{name}", kind).alias(name)


def typed_trips(
    bronze: DataFrame,
    contract: dict[str, str] | None = None,
    whole_number_compat: bool = False,
    at_once: bool = False,
) -> DataFrame:
    """The typed view of trip payloads with payload and lineage columns.

    ``whole_number_compat`` casts money and distance to whole numbers. Keys are taken one by one:
    straight above a scan of stored bronze, Spark reads the wanted ones only and builds no
    payload. For payloads that are made on the way, ``at_once`` takes all in one pass, by a
    generator, so that no filter on the view moves below it and takes keys again. A scan that
    keeps the ``cells`` its payloads are made of is typed from those, by the casts that a payload's
    texts go through: no payload is made unless one is read.
    """
    contract, columns = contract or TRIP_CONTRACT, []
    if "cells" in bronze.columns:
        kept, at_once = bronze.schema["cells"].dataType.fieldNames(), False
        keys = [
            (F.col("cells").getField(name) if name in kept else F.lit(None)).try_cast(kind)
            for name, kind in contract.items()
        ]
        keys = [key.alias(name) for key, name in zip(keys, contract)]
    else:
        keys = [typed(F.col("raw_data"), name, kind) for name, kind in contract.items()]
    if at_once:
        record = "struct<" + ",".join(f"`{name}`:{kind}" for name, kind in contract.items()) + ">"
        taken = [f"__key_{n}" for n in range(len(contract))]
        generated = F.inline(F.array(F.try_variant_get("raw_data", "$", record)))
        bronze = bronze.select("*", generated.alias(*taken))
        keys = [F.col(t).alias(name) for t, name in zip(taken, contract)]
    for column, (name, kind) in zip(keys, contract.items()):
        if whole_number_compat and kind.startswith("decimal"):
            column = F.round(column, 0).cast("decimal(38,0)").alias(name)
        columns.append(column)
    return bronze.select(
        *columns,
        F.col("raw_data").alias("__raw_payload"),
        F.col("file_name").alias("__ingested_file"),
        F.col("file_row_number").alias("__row_num"),
        F.col("load_timestamp").alias("ingest_timestamp"),
    )


def typing_rejects(bronze: DataFrame, contract: dict[str, str] | None = None) -> DataFrame:
    """Per column: values that are present but could not be typed."""
    contract = contract or TRIP_CONTRACT
    payload = F.col("raw_data")
    counts, rows = [], []
    for name, kind in contract.items():
        raw = F.try_variant_get(payload, f"$.{name}", "string")
        lost = raw.isNotNull() & F.try_variant_get(payload, f"$.{name}", kind).isNull()
        counts.append(F.count_if(lost).alias(name))
        rows.append(F.struct(F.lit(name).alias("column_name"), F.col(name).alias("rejected")))
    return bronze.agg(*counts).select(F.inline(F.array(*rows)))


def raw_summary(typed_view: DataFrame) -> DataFrame:
    return typed_view.agg(
        F.count(F.lit(1)).alias("total_raw_records"),
        F.count_distinct("__ingested_file").alias("total_files"),
        F.min("ingest_timestamp").alias("earliest_ingest"),
        F.max("ingest_timestamp").alias("latest_ingest"),
    )


def results_count(document: Column) -> Column:
    """Length of a document's ``results`` array, 0 when there is none."""
    items = F.try_variant_get(document, "$.results", "array<variant>")
    return F.coalesce(F.size(items), F.lit(0)).cast("bigint")


def flatten_readings(documents: DataFrame, json_null_compat: bool = False) -> DataFrame:
    """One row per element of ``raw_data.results``, typed and categorised.

    A missing or empty array gives no row. A JSON ``null`` value counts as missing
    data; ``json_null_compat`` keeps the distinction between an explicit ``null``
    (category of the lowest band) and an absent key.
    """
    items = F.try_variant_get("raw_data", "$.results", "array<variant>")
    element = F.col("element")

    def field(name: str, kind: str) -> Column:
        return F.try_variant_get(element, f"$.{name}", kind)

    value = field("latest_value", "double")
    absent = F.try_variant_get(element, "$.latest_value", "variant").isNull()
    return conform(
        documents.select("ingest_ts", "source_file", F.explode(items).alias("element")).select(
            "ingest_ts",
            "source_file",
            field("location_id", "bigint").alias("location_id"),
            field("sensor_id", "bigint").alias("sensor_id"),
            field("parameter", "string").alias("parameter"),
            field("unit", "string").alias("unit"),
            value.alias("pm25_value"),
            parsed_time(field("latest_time", "string")).alias("reading_time"),
            field("coverage_pct", "double").alias("coverage_pct"),
            air_category(value, absent if json_null_compat else None).alias("who_category"),
        ),
        READINGS,
    )
