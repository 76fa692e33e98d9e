"""File listings and the catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import first_per_key
from .file_source import files


def file_inventory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Key, size and time of the files below ``path``, empty ones included. Each prefix is
    listed by a task of its own, no file is opened, and no name passes through the driver."""
    return files(spark, path, pattern).select(
        F.col("path").alias("key"),
        "size",
        "last_modified",
        (F.col("size") == 0).alias("is_empty"),
    )


def latest_files(
    files: DataFrame, key: str, prefix: Column, keep: int = 3, expected: Sequence[str] = ()
) -> DataFrame:
    """The last ``keep`` files of every prefix, by key order. An expected prefix without
    any file gets one row with a NULL key."""
    latest = first_per_key(
        files.withColumn("prefix", prefix), ["prefix"], [F.col(key).desc()], keep
    )
    if not expected:
        return latest
    wanted = files.sparkSession.createDataFrame([(p,) for p in expected], "prefix string")
    absent = wanted.join(latest, "prefix", "left_anti")
    return latest.unionByName(absent, allowMissingColumns=True)


def register_tables(
    spark: SparkSession, database: str, tables: dict[str, str], location: str
) -> None:
    """Register parquet folders as external tables of a database of the session catalog (kept at
    ``location`` if it is new), and gather their row counts."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{location}'")
    for name, path in tables.items():
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
        place = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE `{database}`.`{name}` USING parquet LOCATION '{place}'")
        spark.sql(f"ANALYZE TABLE `{database}`.`{name}` COMPUTE STATISTICS")


def _row_count(spark: SparkSession, database: str, name: str) -> int | None:
    """The rows that the catalog holds for a table, without reading the table."""
    parts = spark.sql(f"DESCRIBE TABLE EXTENDED `{database}`.`{name}`").where("col_name = 'Statistics'")
    found = parts.select(F.regexp_extract("data_type", r"(\d+) rows", 1)).first()
    return int(found[0]) if found and found[0] else None


def _listed(spark: SparkSession, database: str | None, pattern: str):
    """Schemas and tables; the temporary views of the session where no database is named."""
    schema = database or spark.catalog.currentDatabase()
    found = spark.catalog.listTables(schema, pattern)
    return [(schema, t) for t in found if database is None or not t.isTemporary]


def catalog_tables(spark: SparkSession, database: str | None = None, pattern: str = "*") -> DataFrame:
    """Tables and views by name, with the row counts that the catalog holds (null: not
    gathered). ``pattern`` filters names as the catalog does (``*``, ``|``)."""
    rows = [
        (schema, t.name, t.tableType, None if t.isTemporary else _row_count(spark, schema, t.name))
        for schema, t in _listed(spark, database, pattern)
    ]
    schema = "table_schema string, table_name string, table_type string, row_count bigint"
    return spark.createDataFrame(rows, schema).orderBy("table_schema", "table_name")


def catalog_columns(spark: SparkSession, database: str | None = None, pattern: str = "*") -> DataFrame:
    """The columns of those tables, by table and position."""
    rows = [
        (schema, t.name, c.name, c.dataType, i + 1)
        for schema, t in _listed(spark, database, pattern)
        for i, c in enumerate(spark.catalog.listColumns(t.name if t.isTemporary else f"{schema}.{t.name}"))
    ]
    schema = (
        "table_schema string, table_name string, column_name string, data_type string, position int"
    )
    return spark.createDataFrame(rows, schema).orderBy("table_schema", "table_name", "position")
