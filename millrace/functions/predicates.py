"""Row predicates of the rules."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_null(names: Iterable[str]) -> Column:
    return reduce(or_, [F.col(n).isNull() for n in names])


def outside_open_range(value: Column, low, high) -> Column:
    """Not strictly between the limits. A NULL stays unknown: it is no violation."""
    return ~((value > F.lit(low)) & (value < F.lit(high)))


def outside_bounds(value: Column, bounds: tuple) -> Column:
    """Not within the inclusive bounds. A NULL stays unknown."""
    low, high = bounds
    return ~value.between(F.lit(low), F.lit(high))


def bad_coordinates(latitudes: list[str], longitudes: list[str], lat_bounds, lon_bounds) -> Column:
    """Any coordinate missing or out of bounds."""
    tests = [any_null(latitudes + longitudes)]
    tests += [outside_bounds(F.col(n), lat_bounds) for n in latitudes]
    tests += [outside_bounds(F.col(n), lon_bounds) for n in longitudes]
    return reduce(or_, tests)


def not_listed(value: Column, names: Iterable[str]) -> Column:
    return ~value.isin(list(names))


def like_any(value: Column, patterns: Iterable[str]) -> Column:
    """Case-insensitive LIKE against any of the patterns."""
    return reduce(or_, [value.ilike(p) for p in patterns])
