"""Registered queries: a Spark function, and its SQL twin where one exists."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


CATALOGUE: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles: engines hand decimals to Python in different classes."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if f.dataType.typeName() == "decimal"
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def add(run: Run) -> Run:
        if name in CATALOGUE:
            raise ValueError(f"query {name!r} is registered twice")
        CATALOGUE[name] = Query(lambda spark, sf_dir: plain(run(spark, sf_dir)), sql)
        return run

    return add
