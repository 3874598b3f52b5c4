"""Expectations: count violations, drop violators, or fail before anything is written."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions.rules import Expectation


class ExpectationFailed(RuntimeError):
    """A hard expectation found violating rows."""


def observed_expectations() -> list[Expectation]:
    """Warn-only rules of the observed quality table (fixed values)."""
    return [
        Expectation("batch_id_not_null", F.col("batch_id").isNotNull()),
        Expectation("site_id_not_null", F.col("site_id").isNotNull()),
        Expectation("valid_event_timestamp", F.col("event_timestamp_utc").try_cast("timestamp").isNotNull()),
        Expectation("valid_quality_domain", F.col("result_value").between(0.0, 150.0)),
    ]


def hard_contract() -> Expectation:
    """The reserved schema version that must stop a run (fixed value)."""
    return Expectation("reserved_schema_contract", F.col("schema_version") != "99.0-reserved-failure")


def observe(df: DataFrame, expectations: Sequence[Expectation], name: str) -> tuple[DataFrame, Observation]:
    """Count violations while the frame is being written anyway: no extra pass."""
    observation = Observation(name)
    metrics = [F.count_if(~e.holds).alias(e.name) for e in expectations]
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), *metrics), observation


def report(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """One row per expectation with passed and violated counts, from a single aggregate."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(e.holds).alias(e.name) for e in expectations]
    )
    entries = F.array(
        *[F.struct(F.lit(e.name).alias("expectation"), F.col(e.name).alias("passed")) for e in expectations]
    )
    return counted.select("_rows", F.explode(entries).alias("e")).select(
        "e.expectation", "e.passed", (F.col("_rows") - F.col("e.passed")).alias("violated")
    )


def drop_violations(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [e.holds for e in expectations]))


def require(df: DataFrame, expectation: Expectation, naming: str) -> None:
    """Fail before any write if a row violates; the message names the count and one offender."""
    broken = ~expectation.holds
    found = df.agg(
        F.count_if(broken).alias("n"), F.min(F.when(broken, F.col(naming).cast("string"))).alias("example")
    ).first()
    if found.n:
        raise ExpectationFailed(f"{expectation.name}: {found.n} violating rows, first {naming} {found.example}")


def offenders(df: DataFrame, expectation: Expectation, naming: str) -> DataFrame:
    """Every row that breaks the contract, by name: what is looked up after a run was stopped."""
    broken = df.filter(~expectation.holds)
    return broken.select(F.lit(expectation.name).alias("expectation"), F.col(naming).cast("string").alias("offender"))


def fail_in_plan(df: DataFrame, expectation: Expectation, naming: str) -> DataFrame:
    """The same contract checked as rows stream by: the task that meets a violator raises."""
    message = F.concat(
        F.lit(f"{expectation.name} violated by {naming} "), F.coalesce(F.col(naming).cast("string"), F.lit("NULL"))
    )
    return df.filter(F.when(expectation.holds, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
