"""Tolerance-based quality gate: every expectation in one aggregate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill import schemas


class QualityGateError(ValueError):
    """The data broke an expectation; later steps must not run."""


@dataclass(frozen=True)
class Expectation:
    """A named pair of row conditions and the share of rows that must be fine."""

    name: str
    evaluated: Column
    unexpected: Column
    mostly: float = 1.0


def not_null(column: str) -> Expectation:
    """Every row has a value."""
    return Expectation(f"{column} is not null", F.lit(True), F.col(column).isNull())


def between(column: str, low: float, high: float, mostly: float = 1.0) -> Expectation:
    """At least `mostly` of the rows that have a value lie in `[low, high]`; NaN is no value."""
    value = F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))
    return Expectation(f"{column} between {low:g} and {high:g}", value.isNotNull(),
                       ~value.between(low, high), mostly)


def bronze_suite() -> tuple[Expectation, ...]:
    return (
        not_null("tracking_number"),
        between("ping_latency_ms", schemas.LATENCY_LOW, schemas.LATENCY_HIGH, schemas.LATENCY_MOSTLY),
    )


def expectation_counts(suite: Sequence[Expectation]) -> list[Column]:
    """Two counters per expectation, ready for any aggregate."""
    counters = []
    for i, rule in enumerate(suite):
        counters.append(F.count_if(rule.evaluated).alias(f"evaluated_{i}"))
        counters.append(F.count_if(rule.evaluated & rule.unexpected).alias(f"unexpected_{i}"))
    return counters


def report(counts: DataFrame, suite: Sequence[Expectation]) -> DataFrame:
    """One row per expectation out of a one-row frame of its counters."""
    entries = []
    for i, rule in enumerate(suite):
        seen, bad = F.col(f"evaluated_{i}"), F.col(f"unexpected_{i}")
        entries.append(F.struct(
            F.lit(rule.name).alias("expectation"),
            seen.alias("evaluated"),
            bad.alias("unexpected"),
            F.when(seen == 0, True).otherwise((seen - bad) / seen >= rule.mostly).alias("success"),
        ))
    return counts.select(F.inline(F.array(*entries)))


def run_gate(df: DataFrame, suite: Sequence[Expectation] | None = None) -> DataFrame:
    """Evaluate all expectations in one pass. No rows at all is a success."""
    suite = suite or bronze_suite()
    return report(df.agg(*expectation_counts(suite)), suite)


def enforce(gate_report: DataFrame) -> None:
    """Raise unless every expectation holds; the report has one row for each."""
    failed = [row for row in gate_report.collect() if not row["success"]]
    if failed:
        text = "; ".join(f"{row['expectation']}: {row['unexpected']} of {row['evaluated']} rows" for row in failed)
        raise QualityGateError(f"quality gate failed: {text}")


def violations(df: DataFrame, column: str = "ping_latency_ms", low: float = schemas.LATENCY_LOW,
               high: float = schemas.LATENCY_HIGH) -> DataFrame:
    """The rows that count against `between`."""
    rule = between(column, low, high)
    return df.filter(rule.evaluated & rule.unexpected)
