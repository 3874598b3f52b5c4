"""Reason-coded routing: every record goes to the trusted table or to quarantine with one reason."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.rules import (
    Expectation,
    Rule,
    any_missing,
    differs,
    flagged,
    missing,
    outside,
    reason_of,
    wrong_unit,
)
from tidemark.operators.duplicates import mark_duplicates

REASON = "quarantine_reason"
DISPOSITION = "disposition"
PARSED = "_event_instant"
REPEATED = "_is_duplicate"
KNOWN = "_known_"

# The unit each quality test and each sensor metric must report.
QUALITY_UNITS = {"assay": "%", "purity": "%", "moisture": "%", "bioburden": "CFU/g"}
TELEMETRY_UNITS = {"temperature_c": "C", "vibration_mm_s": "mm/s"}
TEMPERATURE_RANGE = (-80.0, 80.0)


@dataclass(frozen=True)
class Policy:
    """What routing needs to know about a table, all of it data.

    ``identity`` and ``order`` define duplicates; ``position`` makes the order total.
    ``lookup`` lists the reference columns compared with the row, keyed by ``lookup_key``.
    ``drops`` are silent expectations on accepted rows, kept for the accounting.
    """

    rules: Sequence[Rule]
    identity: Sequence[str]
    order: Sequence[str]
    position: Sequence[str] | None = None
    raw_time: str = "event_timestamp_utc"
    lookup_key: str | None = None
    lookup: Sequence[str] = ()
    drops: Sequence[Expectation] = field(default_factory=tuple)


@dataclass(frozen=True)
class Routed:
    """One evaluated frame and its two halves. Write ``evaluated`` once and split on read at scale."""

    evaluated: DataFrame
    policy: Policy

    @property
    def labelled(self) -> DataFrame:
        """The evaluated frame with ``disposition``: valid, quarantined or dropped. A table
        partitioned by it serves both halves from one write."""
        kept = F.lit(True)
        for expectation in self.policy.drops:
            kept = kept & expectation.holds
        label = F.when(F.col(REASON).isNotNull(), "quarantined").when(kept, "valid").otherwise("dropped")
        return self.evaluated.withColumn(DISPOSITION, label)

    @property
    def valid(self) -> DataFrame:
        """Accepted rows; the parsed event time takes the raw column's name."""
        raw = self.policy.raw_time
        accepted = self.labelled.filter(F.col(DISPOSITION) == "valid").drop(DISPOSITION)
        return accepted.drop(REASON, raw).withColumnRenamed(PARSED, raw)

    @property
    def quarantine(self) -> DataFrame:
        """Rejected rows with the raw event time and the reason."""
        return self.evaluated.filter(F.col(REASON).isNotNull()).drop(PARSED)

    def accounting(self) -> DataFrame:
        """One row: input, valid, quarantined, dropped, and whether they add up."""
        counted = self.labelled.agg(
            F.count(F.lit(1)).alias("input_rows"),
            *[
                F.count_if(F.col(DISPOSITION) == label).alias(f"{label}_rows")
                for label in ("valid", "quarantined", "dropped")
            ],
        )
        parts = F.col("valid_rows") + F.col("quarantined_rows") + F.col("dropped_rows")
        return counted.withColumn("balanced", parts == F.col("input_rows"))


def route(bronze: DataFrame, policy: Policy, known: DataFrame | None = None) -> Routed:
    """Evaluate a policy. ``known`` must hold one row per lookup key.

    Duplicates are ranked over all rows before any other rule decides, so a copy stays a duplicate
    even when the first copy is rejected for another reason.
    """
    evaluated = mark_duplicates(bronze, policy.identity, policy.order, REPEATED, policy.position)
    if policy.lookup_key:
        evaluated = _look_up(evaluated, policy, known)
    evaluated = evaluated.withColumn(PARSED, F.try_to_timestamp(F.col(policy.raw_time)))
    evaluated = evaluated.withColumn(REASON, reason_of(policy.rules))
    return Routed(evaluated.select(*bronze.columns, PARSED, REASON), policy)


def _look_up(df: DataFrame, policy: Policy, known: DataFrame) -> DataFrame:
    key = policy.lookup_key
    names = [key, *policy.lookup]
    reference = known.select(*[F.col(c).alias(KNOWN + c) for c in names])
    return df.join(reference, F.col(key) == F.col(KNOWN + key), "left")


def reason_counts(evaluated: DataFrame, *by: str) -> DataFrame:
    """How many records failed for which reason, per group."""
    rejected = evaluated.filter(F.col(REASON).isNotNull())
    return rejected.groupBy(*by, REASON).agg(F.count(F.lit(1)).alias("records"))


def quality_policy_basic(**overrides) -> Policy:
    """Quality rules of the library: seven reasons, known batches only."""
    settings = {
        "rules": [
            missing("observation_id", "NULL_BUSINESS_KEY"),
            missing(KNOWN + "batch_id", "UNKNOWN_BATCH"),
            missing(PARSED, "MALFORMED_TIMESTAMP"),
            outside("sample_temperature_c", *TEMPERATURE_RANGE, "IMPOSSIBLE_TEMPERATURE"),
            wrong_unit("test_type", "unit", QUALITY_UNITS, "INCONSISTENT_UNIT", True),
            any_missing(("result_value", "spec_lower", "spec_upper"), "INVALID_QUALITY_RESULT"),
            flagged(REPEATED, "DUPLICATE_RECORD"),
        ],
        "identity": ("record_hash",),
        "order": ("source_file", "pipeline_run_id", "ingest_timestamp_utc"),
        "lookup_key": "batch_id",
    }
    return Policy(**{**settings, **overrides})


def quality_policy(**overrides) -> Policy:
    """Quality rules of the published pipeline: key, site and product must match the current batch."""
    settings = {
        "rules": [
            missing("observation_id", "NULL_BUSINESS_KEY"),
            missing("batch_id", "NULL_BATCH_ID"),
            missing("site_id", "NULL_SITE_ID"),
            missing(KNOWN + "batch_id", "UNKNOWN_BATCH"),
            differs("site_id", KNOWN + "site_id", "UNKNOWN_SITE"),
            differs("product_id", KNOWN + "product_id", "UNKNOWN_PRODUCT"),
            missing(PARSED, "MALFORMED_TIMESTAMP"),
            outside("sample_temperature_c", *TEMPERATURE_RANGE, "IMPOSSIBLE_TEMPERATURE"),
            wrong_unit("test_type", "unit", QUALITY_UNITS, "INCONSISTENT_UNIT", True),
            flagged(REPEATED, "DUPLICATE_RECORD"),
        ],
        "identity": ("record_hash",),
        "order": ("source_file", "pipeline_run_id", "ingest_timestamp_utc"),
        "lookup_key": "batch_id",
        "lookup": ("site_id", "product_id"),
        "drops": (
            Expectation("batch_id_not_null", F.col("batch_id").isNotNull()),
            Expectation("site_id_not_null", F.col("site_id").isNotNull()),
        ),
    }
    return Policy(**{**settings, **overrides})


def telemetry_policy_basic(**overrides) -> Policy:
    """Telemetry rules of the library: seven reasons, no reference lookup."""
    settings = {
        "rules": [
            missing("event_id", "NULL_EVENT_ID"),
            missing("batch_id", "NULL_BATCH_ID"),
            missing("site_id", "NULL_SITE_ID"),
            missing(PARSED, "MALFORMED_TIMESTAMP"),
            *_telemetry_value_rules(),
        ],
        "identity": ("event_id",),
        "order": ("source_file", "pipeline_run_id", "ingest_timestamp_utc", "record_hash"),
    }
    return Policy(**{**settings, **overrides})


def telemetry_policy(**overrides) -> Policy:
    """Telemetry rules of the published pipeline: batch and site are checked, order is the message's."""
    settings = {
        "rules": [
            missing("event_id", "NULL_EVENT_ID"),
            missing("batch_id", "NULL_BATCH_ID"),
            missing("site_id", "NULL_SITE_ID"),
            missing(KNOWN + "batch_id", "UNKNOWN_BATCH"),
            differs("site_id", KNOWN + "site_id", "UNKNOWN_SITE"),
            missing(PARSED, "MALFORMED_TIMESTAMP"),
            *_telemetry_value_rules(),
        ],
        "identity": ("event_id",),
        # Message coordinates are unique, so they also serve as the position.
        "order": ("source_file",),
        "position": ("partition", "offset"),
        "lookup_key": "batch_id",
        "lookup": ("site_id",),
        "drops": (
            Expectation("valid_event_id", F.col("event_id").isNotNull()),
            Expectation("valid_temperature_range", F.col("value").between(*TEMPERATURE_RANGE)),
        ),
    }
    return Policy(**{**settings, **overrides})


def _telemetry_value_rules() -> list[Rule]:
    is_temperature = F.col("metric_name") == "temperature_c"
    return [
        outside("value", *TEMPERATURE_RANGE, "IMPOSSIBLE_TEMPERATURE", only=is_temperature),
        wrong_unit("metric_name", "unit", TELEMETRY_UNITS, "INCONSISTENT_UNIT", False),
        flagged(REPEATED, "DUPLICATE_EVENT_ID"),
    ]
