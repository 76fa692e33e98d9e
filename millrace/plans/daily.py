"""The shipped trip and air-quality configuration."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame

from .. import fixed_values as fv
from ..operators import rules
from ..operators.checks import Check, CheckResult, TableChecks, new_run_id, run_checks
from ..operators.schema_check import schema_rule
from ..schemas import TRIP_CONTRACT


def trip_checks(trips: DataFrame, schema_mode: str = "reference") -> list[Check]:
    return [
        rules.null_rule(),
        rules.range_rule(),
        schema_rule(trips, TRIP_CONTRACT, table=fv.TRIPS_TABLE, mode=schema_mode),
        rules.geo_rule(),
    ]


def reading_checks(as_of: dt.datetime | str) -> list[Check]:
    return [
        rules.reading_null_rule(),
        rules.freshness_rule(as_of),
        rules.threshold_rule(),
    ]


@dataclass(frozen=True)
class AllChecks:
    trips: TableChecks
    readings: TableChecks
    message: str = fv.RUN_ALL_MESSAGE

    @property
    def result(self) -> CheckResult:
        return self.trips.result.union(self.readings.result)

    def pinned(self) -> AllChecks:
        """Both tables' counters evaluated once (two rows through the driver)."""
        return AllChecks(self.trips.pinned(), self.readings.pinned(), self.message)


def run_all_checks(
    trips: DataFrame,
    readings: DataFrame,
    *,
    as_of: dt.datetime | str,
    run_id: str | None = None,
    schema_mode: str = "reference",
) -> AllChecks:
    """All seven checks in fixed order: four over trips, three over readings.

    Each table costs one shared aggregate and one violations scan. Call ``pinned()``
    before writing the results, so that the aggregate runs once for all of them.
    """
    run = run_id or new_run_id()
    over_trips = run_checks(trips, trip_checks(trips, schema_mode), as_of=as_of, run_id=run)
    over_readings = run_checks(
        readings, reading_checks(as_of), as_of=as_of, run_id=run, id_offset=50
    )
    return AllChecks(over_trips, over_readings)
