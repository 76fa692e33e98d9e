"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession

_fallback: dict[str, str] = {}


def local_session(cpus: int | str = "*", app: str = "millrace", **conf: str) -> SparkSession:
    """A session for tests and the bench. On a cluster the submitter configures Spark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus if cpus != "*" else 8))
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    ``spark.checkpoint.dir`` wins. Only where no cluster set one (unit tests on
    one machine) a fresh temporary folder stands in for it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _fallback:
        _fallback[app] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _fallback[app]


def one_row(spark: SparkSession, **columns: Column) -> DataFrame:
    """A frame of one row of literals that the optimizer can fold away."""
    return spark.sql("SELECT 1").select(*[c.alias(n) for n, c in columns.items()])


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/millrace/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession) -> None:
    """Remove what this application wrote to its scratch folder."""
    root = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)
