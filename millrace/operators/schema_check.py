"""Schema contract: of a frame's columns, and of the payloads inside a table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as fv
from ..functions.text import counted
from .checks import Check, Metric


@dataclass(frozen=True)
class SchemaDiff:
    columns: int
    missing: list[str]
    unexpected: list[str]
    mismatched: list[str]

    def count(self, mode: str) -> int:
        """``reference``: unexpected columns only; ``contract``: every finding."""
        if mode == "reference":
            return len(self.unexpected)
        if mode == "contract":
            return len(self.unexpected) + len(self.missing) + len(self.mismatched)
        raise ValueError(f"unknown mode {mode!r}")


def compare_schema(schema: T.StructType, contract: dict[str, str]) -> SchemaDiff:
    """Column names compared without case, types by their SQL name."""
    actual = {f.name.lower(): f.dataType.simpleString() for f in schema.fields}
    wanted = {name.lower(): kind for name, kind in contract.items()}
    return SchemaDiff(
        columns=len(schema.fields),
        missing=sorted(set(wanted) - set(actual)),
        unexpected=sorted(set(actual) - set(wanted)),
        mismatched=sorted(n for n in wanted if n in actual and actual[n] != wanted[n]),
    )


def schema_rule(
    df: DataFrame, contract: dict[str, str], *, table: str, mode: str = "reference"
) -> Check:
    """The contract check of ``df``. It only reads metadata; in a run it shares the
    row count with the table's other checks."""
    diff = compare_schema(df.schema, contract)
    found = diff.count(mode)
    issues = F.col("schema_findings")
    return Check(
        name="SCHEMA",
        rule="RULE_SCHEMA",
        table=table,
        counters={
            "rows": F.count(F.lit(1)),
            "schema_findings": F.lit(found).cast("bigint"),
            "schema_columns": F.lit(diff.columns).cast("bigint"),
        },
        total="rows",
        issues="schema_findings",
        failed=issues > 0,
        severity="HIGH",
        summary=lambda: counted(fv.SCHEMA_SUMMARY, issues),
        message=lambda: counted(fv.SCHEMA_MESSAGE, issues),
        metrics=lambda: [
            Metric(
                "RULE_SCHEMA",
                F.when(issues > 0, 100.0).otherwise(0.0),
                0,
                issues == 0,
                issues,
                F.col("schema_columns"),
            )
        ],
        table_fields=lambda: [
            issues.alias("missing_cols"),
            _names("missing", diff.missing),
            _names("unexpected", diff.unexpected),
            _names("mismatched", diff.mismatched),
        ],
    )


def _names(label: str, names: Sequence[str]) -> Column:
    """A list as a field; an empty list is left out of the JSON object."""
    value = F.array(*[F.lit(n) for n in names]) if names else F.lit(None).cast("array<string>")
    return value.alias(label)


def _finding(name: Column, finding: str) -> Column:
    return F.struct(name.alias("column_name"), F.lit(finding).alias("finding"))


def _unexpected(name: Column) -> Column:
    return _finding(name, "unexpected")


def payload_drift(docs: DataFrame, payload: str, contract: dict[str, str]) -> DataFrame:
    """Drift inside semi-structured payloads, counted over all of them.

    Columns: ``column_name, finding, payloads`` with findings ``missing`` (key
    absent), ``mismatch`` (present, not null, not castable to the contract type)
    and ``unexpected`` (key outside the contract). Only non-zero findings.

    One pass over the payloads, each taken apart once. The findings of a payload, few as a rule,
    become rows, which are counted per map task before they are shuffled.
    """
    one_pass = "struct<" + ",".join(f"`{name}`:variant" for name in contract) + ">"

    known = []
    for name, kind in contract.items():
        raw = F.col("keys")[name]
        wrong = ~F.is_variant_null(raw) & F.try_variant_get(raw, "$", kind).isNull()
        missing, mismatch = (_finding(F.lit(name), f) for f in ("missing", "mismatch"))
        known.append(F.when(raw.isNull(), missing).when(wrong, mismatch))
    names = F.coalesce(
        F.map_keys(F.col(payload).try_cast("map<string,variant>")), F.array().cast("array<string>")
    )
    extra = F.array_except(names, F.array(*[F.lit(n) for n in contract]))
    found = F.concat(F.array_compact(F.array(*known)), F.transform("extra", _unexpected))
    taken = F.struct(F.try_variant_get(payload, "$", one_pass).alias("keys"), extra.alias("extra"))
    return (
        docs.select(F.inline(F.array(taken)))
        .select(F.explode(found).alias("found"))
        .groupBy("found.column_name", "found.finding")
        .agg(F.count(F.lit(1)).alias("payloads"))
    )


def payload_schema(docs: DataFrame, payload: str) -> DataFrame:
    """The merged type of all payloads as one text value."""
    return docs.agg(F.schema_of_variant_agg(payload).alias("payload_schema"))
