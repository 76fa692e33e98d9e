"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Stored tables up to this size are broadcast; larger ones are joined by a shuffle.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back, which cuts its lineage:
    a lost executor loses nothing that was stored."""
    return stored_sized(df, name)[0]


def stored_sized(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """As :func:`stored`, with the bytes written."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    size = files.getContentSummary(folder).getLength()
    return spark.read.schema(df.schema).parquet(path), size


def broadcast_if_small(sized: tuple[DataFrame, int]) -> DataFrame:
    df, size = sized
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def ascii_lower(text: Column) -> Column:
    """A-Z to lower case, every other letter as it is."""
    return F.translate(text, UPPER, LOWER)


def text_key(text: Column) -> Column:
    """128 bits that stand for a text in joins, so that texts themselves need not move."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))


def whole_rows(df: DataFrame) -> Column:
    """All columns as one, whatever their names, so that none clashes with an operator's own."""
    return F.struct("*")
