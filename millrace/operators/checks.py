"""Data-quality checks: one shared aggregate per table, one scan for violations.

A :class:`Check` names the counters it needs as aggregate expressions. All checks
of a table are merged into a single aggregation, so a table is scanned once for every
count and exact mean of every check. Audit and metric rows are projections of that one-row frame.
Violations of all rules come from a second scan that tags each bad row with the
rules it breaks; :meth:`TableChecks.scanned_once` gets both from one scan, the counters as
observed metrics of the scan that writes the violations.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property, reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.bands import severity as severity_of
from ..functions.text import json_object
from ..functions.times import clock
from ..schemas import AUDIT, METRICS, VIOLATIONS, conform
from ..session import one_row
from .exact import ExactMean, Parts, aggregate


@dataclass(frozen=True)
class Metric:
    """One metric row. All expressions are over the check's counters."""

    name: str
    value: Column
    threshold: float
    passed: Column
    fail_count: Column | None = None
    total_count: Column | None = None


@dataclass(frozen=True)
class FromCounter:
    """A violation field whose value is a counter of the whole table."""

    name: str
    counter: str


@dataclass(frozen=True)
class Check:
    """A rule over one table.

    ``counters`` are aggregates over the table, shared by name between checks: counts, and
    what :mod:`millrace.operators.exact` puts together from parts.
    ``failed``, ``summary``, ``message``, ``details`` and the metrics are expressions
    over those counters. ``violation`` is a predicate over the table's rows (NULL means
    "no violation"); ``fields`` is what a violation row records. ``table_fields``
    replaces both for a check about the table as a whole. What only some result frames
    need is given as a function and built when such a frame is asked for.
    """

    name: str
    rule: str
    table: str
    counters: dict[str, Column | Parts | ExactMean]
    total: str
    issues: str
    failed: Column
    summary: Callable[[], Column]
    message: Callable[[], Column]
    metrics: Callable[[], Sequence[Metric]]
    violation: Column | None = None
    fields: Callable[[], Sequence[Column | FromCounter]] = tuple
    table_fields: Callable[[], Sequence[Column]] | None = None
    details: Callable[[], Sequence[Column]] | None = None
    severity: str = "MEDIUM"


_TAGGED = "table_name string, rule_name string, violation_details string"


@dataclass(frozen=True)
class CheckResult:
    audit: DataFrame
    metrics: DataFrame
    violations: DataFrame

    def union(self, other: CheckResult) -> CheckResult:
        return CheckResult(
            self.audit.unionByName(other.audit),
            self.metrics.unionByName(other.metrics),
            self.violations.unionByName(other.violations),
        )


def new_run_id() -> str:
    """One id per run, made on the driver: the SQL function would give one per row."""
    return str(uuid.uuid4())


def _first_id(as_of: dt.datetime | str, offset: int) -> int:
    moment = as_of if isinstance(as_of, dt.datetime) else dt.datetime.fromisoformat(str(as_of))
    micros = (moment.replace(tzinfo=None) - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
    return micros * 100 + offset


class TableChecks:
    """All checks of one table in one run."""

    def __init__(
        self,
        table: DataFrame,
        checks: Sequence[Check],
        run_id: str,
        as_of: dt.datetime | str,
        id_offset: int = 0,
    ) -> None:
        self.table, self.checks, self.run_id, self.as_of = table, list(checks), run_id, as_of
        self._id = _first_id(as_of, id_offset)

    @property
    def _by_row(self) -> list[Check]:
        return [c for c in self.checks if c.violation is not None]

    def _counters(self) -> dict[str, Column | Parts | ExactMean]:
        merged: dict[str, Column | Parts | ExactMean] = {}
        for check in self.checks:
            for name, expr in check.counters.items():
                if name in merged and str(merged[name]) != str(expr):
                    raise ValueError(f"counter {name!r} is defined twice, differently")
                merged[name] = expr
        return merged

    @cached_property
    def counts(self) -> DataFrame:
        """One row with every counter of every check."""
        merged = self._counters()
        if all(isinstance(expr, Column) for expr in merged.values()):
            return self.table.agg(*[expr.alias(name) for name, expr in merged.items()])
        return aggregate(self.table, [], merged)

    def pinned(self) -> TableChecks:
        """The same run with its counters evaluated, so that audit, metrics and
        violations do not scan for them again. Exactly one row of counters passes
        through the driver, whatever the size of the table."""
        row = self.counts.collect()[0]
        values = {
            f.name: F.lit(row[f.name]).cast(f.dataType) for f in self.counts.schema.fields
        }
        twin = TableChecks(self.table, self.checks, self.run_id, self.as_of)
        twin._id = self._id
        twin.__dict__["counts"] = one_row(self.table.sparkSession, **values)
        return twin

    def scanned_once(self, stage: str) -> TableChecks:
        """The same run with its counters and its violations out of a single scan: the bad rows
        are written to the folder ``stage`` while Spark observes the counters of all rows on the
        way. For a source that is dear to read twice, such as a batch of landed files. Where
        counters are put together from parts, or no rule is about rows, this is
        :meth:`pinned`."""
        merged = self._counters()
        if not self._by_row or any(not isinstance(expr, Column) for expr in merged.values()):
            return self.pinned()
        seen = Observation()
        watched = self.table.observe(seen, *[expr.alias(name) for name, expr in merged.items()])
        mark = f"@{uuid.uuid4().hex}:"  # stands for a counter until the scan is over
        self._tagged(watched, mark).write.parquet(stage)
        spark = self.table.sparkSession
        values = {name: F.lit(value) for name, value in seen.get.items()}
        twin = TableChecks(self.table, self.checks, self.run_id, self.as_of)
        twin._id = self._id
        twin.__dict__["counts"] = one_row(spark, **values)
        written = spark.read.schema(_TAGGED).parquet(stage)
        details = F.col("violation_details")
        for name, value in seen.get.items():
            details = F.replace(details, F.lit(f'"{mark}{name}"'), F.lit(str(value)))
        twin.__dict__["_written"] = written.withColumn("violation_details", details)
        return twin

    def _rows(self, structs: list[Column]) -> DataFrame:
        return self.counts.select(F.inline(F.array(*structs)))

    @property
    def audit(self) -> DataFrame:
        rows = []
        for position, check in enumerate(self.checks):
            issues = F.col(check.issues).cast("bigint")
            details = json_object(*check.details()) if check.details else F.lit(None)
            rows.append(
                F.struct(
                    F.lit(self._id + position).cast("bigint").alias("log_id"),
                    F.lit(self.run_id).alias("run_id"),
                    clock(self.as_of).alias("run_timestamp"),
                    F.lit(check.table).alias("table_name"),
                    F.lit(check.name).alias("check_name"),
                    F.when(check.failed, "FAIL").otherwise("PASS").alias("status"),
                    F.col(check.total).cast("bigint").alias("row_count"),
                    issues.alias("issue_count"),
                    severity_of(issues, check.severity).alias("severity"),
                    check.summary().alias("summary"),
                    details.cast("string").alias("details"),
                )
            )
        return conform(self._rows(rows), AUDIT)

    @property
    def metrics(self) -> DataFrame:
        rows = []
        for check in self.checks:
            for metric in check.metrics():
                rows.append(
                    F.struct(
                        F.lit(self._id + len(rows)).cast("bigint").alias("metric_id"),
                        F.lit(self.run_id).alias("run_id"),
                        clock(self.as_of).alias("run_timestamp"),
                        F.lit(check.table).alias("table_name"),
                        F.lit(metric.name).alias("metric_name"),
                        metric.value.cast("double").alias("metric_value"),
                        F.lit(float(metric.threshold)).alias("threshold"),
                        metric.passed.cast("boolean").alias("passed"),
                        _or_null(metric.fail_count).cast("bigint").alias("fail_count"),
                        _or_null(metric.total_count).cast("bigint").alias("total_count"),
                    )
                )
        return conform(self._rows(rows), METRICS)

    @property
    def messages(self) -> DataFrame:
        """The status text of each check."""
        rows = [
            F.struct(F.lit(check.name).alias("check_name"), check.message().alias("message"))
            for check in self.checks
        ]
        return self._rows(rows)

    @property
    def violations(self) -> DataFrame:
        frames = []
        if "_written" in self.__dict__:
            frames.append(self.__dict__["_written"])
        elif self._by_row:
            frames.append(self._tagged(self.table))
        for check in self.checks:
            if check.table_fields:
                frames.append(
                    self.counts.where(F.col(check.issues) > 0).select(
                        F.lit(check.table).alias("table_name"),
                        F.lit(check.rule).alias("rule_name"),
                        json_object(*check.table_fields()).alias("violation_details"),
                    )
                )
        found = reduce(DataFrame.unionByName, frames)
        return conform(
            found.withColumns(
                {"run_id": F.lit(self.run_id), "detected_at": clock(self.as_of)}
            ),
            VIOLATIONS,
        )

    def _tagged(self, table: DataFrame, mark: str | None = None) -> DataFrame:
        """A row for each rule that a row breaks; with ``mark``, marks in place of counters."""
        tagged = [
            F.when(
                check.violation,
                F.struct(
                    F.lit(check.table).alias("table_name"),
                    F.lit(check.rule).alias("rule_name"),
                    json_object(*self._fields(check, mark)).alias("violation_details"),
                ),
            )
            for check in self._by_row
        ]
        bad = table.where(reduce(or_, [c.violation for c in self._by_row]))
        return bad.select(F.inline(F.array_compact(F.array(*tagged))))

    def _fields(self, check: Check, mark: str | None) -> list[Column]:
        out = []
        for item in check.fields():
            if isinstance(item, FromCounter) and mark:
                out.append(F.lit(f"{mark}{item.counter}").alias(item.name))
            elif isinstance(item, FromCounter):
                whole = self.counts.select(F.col(item.counter).cast("bigint")).scalar()
                out.append(whole.alias(item.name))
            else:
                out.append(item)
        return out

    @property
    def result(self) -> CheckResult:
        return CheckResult(self.audit, self.metrics, self.violations)


def _or_null(expr: Column | None) -> Column:
    return F.lit(None) if expr is None else expr


def run_checks(
    table: DataFrame,
    checks: Sequence[Check],
    *,
    as_of: dt.datetime | str,
    run_id: str | None = None,
    id_offset: int = 0,
) -> TableChecks:
    """All ``checks`` over ``table``; nothing runs until a result frame is used."""
    return TableChecks(table, checks, run_id or new_run_id(), as_of, id_offset)
