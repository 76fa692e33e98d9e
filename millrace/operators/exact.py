"""Aggregates with sums of doubles that depend on no order.

A sum of doubles depends on the order of its rows, so a recomputed or repartitioned job gives
other bits, and one huge value swallows all others. Here every double is taken as a whole number
times a power of two. Whole numbers are summed for each step of exponents, a group of the first
of two aggregations and a handful of rows for usual data, and the second aggregation puts the
steps of a group together and rounds once. Other aggregates take the same way in two parts, so
the table is still scanned and shuffled once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import TOTAL, exact_total, exponent_step, mantissa


def added(part: Column) -> Column:
    """How counts of parts become one."""
    return F.coalesce(F.sum(part), F.lit(0))


@dataclass(frozen=True)
class Parts:
    """An aggregate over rows, and how its values over parts of the rows become one."""

    over_rows: Column
    merge: Callable[[Column], Column] = added


@dataclass(frozen=True)
class ExactMean:
    """The mean of the non-null values, from an exact sum; NULL without any. A value that is
    not finite makes the mean what IEEE sums make it: infinite, or NaN."""

    value: Column
    then: Callable[[Column], Column] = field(default=lambda mean: mean)


def largest_of(name: Column, by: Column) -> Parts:
    """``max_by(name, by)``."""
    pair = F.struct(F.max(by).alias("by"), F.max_by(name, by).alias("name"))
    return Parts(pair, lambda part: F.max_by(part["name"], part["by"]))


def smallest(value: Column) -> Parts:
    return Parts(F.min(value), F.min)


def largest(value: Column) -> Parts:
    return Parts(F.max(value), F.max)


def distinct(value: Column) -> Parts:
    """``count_distinct`` of a column with few values (a category): each part lists them."""
    listed = F.collect_set(value)
    return Parts(listed, lambda part: F.size(F.array_distinct(F.flatten(F.collect_list(part)))).cast("bigint"))


def aggregate(
    df: DataFrame, keys: Sequence[str], wanted: dict[str, Column | Parts | ExactMean]
) -> DataFrame:
    """``wanted`` per group of ``keys`` (one row without keys). A plain column is a count."""
    means = {n: w for n, w in wanted.items() if isinstance(w, ExactMean)}
    parts = {n: w if isinstance(w, Parts) else Parts(w) for n, w in wanted.items() if n not in means}
    steps, first, second = [], [], []
    for i, (name, mean) in enumerate(means.items()):
        value, step = mean.value.cast("double"), f"__step_{i}"
        exponent = exponent_step(value)
        steps.append(exponent.alias(step))
        whole = mantissa(value, exponent)
        odd = F.when(exponent.isNull(), value)  # not finite
        first += [
            F.sum(whole.cast("decimal(22,0)")).alias(f"__total_{i}"),
            F.count(value).alias(f"__count_{i}"),
            F.sum(odd).alias(f"__special_{i}"),
        ]
        pair = F.struct(F.col(step).alias("step"), F.col(f"__total_{i}").cast(TOTAL).alias("total"))
        second += [
            F.collect_list(F.when(F.col(f"__total_{i}").isNotNull(), pair)).alias(f"__parts_{i}"),
            F.sum(f"__count_{i}").alias(f"__n_{i}"),
            F.sum(f"__special_{i}").alias(f"__odd_{i}"),
        ]
    first += [w.over_rows.alias(f"__part_{n}") for n, w in parts.items()]
    second += [w.merge(F.col(f"__part_{n}")).alias(n) for n, w in parts.items()]
    whole = df.groupBy(*keys, *steps).agg(*first).groupBy(*keys).agg(*second)
    totals = {
        name: F.coalesce(F.col(f"__odd_{i}"), exact_total(f"__parts_{i}"))
        / F.nullif(F.col(f"__n_{i}"), F.lit(0)).cast("double")
        for i, name in enumerate(means)
    }
    whole = whole.select(*keys, *parts, *(t.alias(name) for name, t in totals.items()))
    return whole.select(
        *keys,
        *((means[n].then(F.col(n)) if n in means else F.col(n)).alias(n) for n in wanted),
    )
