"""Data contracts: every input schema is explicit, none is inferred."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES: dict[str, DataType] = {
    "STRING": StringType(),
    "DOUBLE": DoubleType(),
    "BIGINT": LongType(),
    "INT": IntegerType(),
    "BOOLEAN": BooleanType(),
    "TIMESTAMP": TimestampType(),
}


def contract(columns: str, nullable: bool = True) -> StructType:
    """A schema from 'name TYPE, ...'; unlike DDL parsing it needs no running session."""
    pairs = [column.split() for column in columns.split(",")]
    return StructType([StructField(name, _TYPES[kind], nullable) for name, kind in pairs])


# Column names, order and types below are the fixed contract of the source systems.
# Quality and telemetry stay nullable so that defective records can land.
QUALITY_SOURCE = contract(
    "observation_id STRING, batch_id STRING, site_id STRING, product_id STRING, test_type STRING, "
    "result_value DOUBLE, unit STRING, spec_lower DOUBLE, spec_upper DOUBLE, "
    "sample_temperature_c DOUBLE, event_timestamp STRING, source_system STRING, "
    "schema_version STRING, analyst_shift STRING"
)
TELEMETRY_SOURCE = contract(
    "event_id STRING, sensor_id STRING, batch_id STRING, site_id STRING, metric_name STRING, "
    "value DOUBLE, unit STRING, event_ts STRING, sequence_number BIGINT, firmware_version STRING, "
    "source_system STRING, schema_version STRING"
)
BATCH_MASTER = contract(
    "batch_id STRING, site_id STRING, product_id STRING, "
    "lot_number STRING, manufactured_at STRING, release_status STRING, "
    "effective_at STRING, sequence_number BIGINT, schema_version STRING",
    nullable=False,
)
CHANGE_EVENT = contract(
    "event_id STRING, batch_id STRING, operation STRING, "
    "sequence_number BIGINT, effective_at STRING, release_status STRING, "
    "source_system STRING, schema_version STRING",
    nullable=False,
)
SITE = contract(
    "site_id STRING, site_name STRING, region STRING, active BOOLEAN",
    nullable=False,
)
PRODUCT = contract(
    "product_id STRING, product_name STRING, target_assay_pct DOUBLE, "
    "temperature_limit_c DOUBLE",
    nullable=False,
)
# Kafka's own source layout; the replayed message log is stored the same way.
MESSAGE = contract(
    "key STRING, value STRING, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"
)

LAYERS = ("bronze", "silver", "gold", "governance")
