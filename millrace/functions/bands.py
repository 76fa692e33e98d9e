"""Ordered bands: the first edge that matches gives the label."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fv
from .times import shifted


def band(edges: Iterable[tuple[object, str]], test: Callable[[object], Column], rest: str) -> Column:
    """``test(edge)`` decides whether a row falls into that edge's band."""
    chain = None
    for edge, label in edges:
        chain = F.when(test(edge), label) if chain is None else chain.when(test(edge), label)
    return F.lit(rest) if chain is None else chain.otherwise(rest)


def air_category(value: Column, missing: Column | None = None) -> Column:
    """Air-quality category of a PM2.5 value; ``missing`` says when there is no data."""
    absent = value.isNull() if missing is None else missing
    graded = band(fv.AIR_BANDS, lambda edge: value > F.lit(edge), fv.AIR_LOWEST)
    return F.when(absent, fv.AIR_MISSING).otherwise(graded)


def fare_bucket(fare: Column) -> Column:
    """A missing fare has a band of its own."""
    graded = band(fv.FARE_BANDS, lambda edge: fare < F.lit(edge), fv.FARE_HIGHEST)
    return F.when(fare.isNull(), fv.FARE_MISSING).otherwise(graded)


def freshness_label(moment: Column, as_of: Column) -> Column:
    """Age label; a missing time falls through to the oldest label."""
    return band(
        fv.FRESHNESS_BANDS,
        lambda days: moment >= shifted(as_of, days=-days),
        fv.FRESHNESS_OLDEST,
    )


def score_colour(score: Column) -> Column:
    """Colour of a health score; an unknown score has none."""
    graded = band(fv.SCORE_BANDS, lambda edge: score < F.lit(edge), fv.SCORE_TOP)
    return F.when(score.isNotNull(), graded)


def severity(issues: Column, raised: str = "MEDIUM") -> Column:
    """Raised severity as soon as there is one issue, LOW otherwise."""
    return F.when(issues > 0, raised).otherwise("LOW")


def health_label(status: Column, issues: Column) -> Column:
    return (
        F.when(status == "PASS", fv.HEALTH_PASS)
        .when((status == "FAIL") & (issues > fv.ALERT_ISSUES), fv.HEALTH_CRITICAL)
        .otherwise(fv.HEALTH_WARNING)
    )
