from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions.rules import Expectation
from tidemark.operators import expectations
from tidemark.operators.duplicates import mark_duplicates
from tidemark.operators.provenance import stamp
from tidemark.operators.routing import (
    REASON,
    quality_policy,
    quality_policy_basic,
    route,
    telemetry_policy,
    telemetry_policy_basic,
)
from tidemark.schemas import QUALITY_SOURCE, TELEMETRY_SOURCE

TIME = "2026-07-01T00:00:00Z"


def observation(key, **changes):
    row = {
        "observation_id": key, "batch_id": "B1", "site_id": "S1", "product_id": "P1", "test_type": "assay",
        "result_value": 99.0, "unit": "%", "spec_lower": 95.0, "spec_upper": 102.0, "sample_temperature_c": 5.0,
        "event_timestamp": TIME, "source_system": "lims", "schema_version": "1.0", "analyst_shift": None,
    }
    return {**row, **changes}


def reading(key, **changes):
    row = {
        "event_id": key, "sensor_id": "T1", "batch_id": "B1", "site_id": "S1", "metric_name": "temperature_c",
        "value": 5.0, "unit": "C", "event_ts": TIME, "sequence_number": 1, "firmware_version": "1",
        "source_system": "plant", "schema_version": "1.0",
    }
    return {**row, **changes}


def frame(spark, rows, schema, raw_time):
    df = spark.createDataFrame([tuple(r[n] for n in schema.fieldNames()) for r in rows], schema)
    return stamp(df, source_file="f1", run_id="r1", ingested_at=TIME, raw_time=raw_time)


def quality(spark, *rows):
    return frame(spark, rows, QUALITY_SOURCE, "event_timestamp")


def telemetry(spark, *rows):
    df = frame(spark, rows, TELEMETRY_SOURCE, "event_ts")
    place = F.monotonically_increasing_id()
    return df.withColumn("partition", F.lit(0)).withColumn("offset", place)


def known(spark, *rows):
    return spark.createDataFrame(list(rows), "batch_id STRING, site_id STRING, product_id STRING")


def reasons(df, key):
    return sorted((r[0] or "", r[1]) for r in df.select(key, REASON).collect())


def test_provenance_keeps_the_source_and_hashes_it(spark):
    row = quality(spark, observation("O1")).first()
    assert row.event_timestamp_utc == TIME and row.source_file == "f1" and row.pipeline_run_id == "r1"
    assert row.ingest_timestamp_utc == datetime(2026, 7, 1)
    assert len(row.record_hash) == 64
    other = frame(spark, [observation("O1")], QUALITY_SOURCE, "event_timestamp")
    moved = stamp(
        other.select(*QUALITY_SOURCE.fieldNames()), source_file="f2", run_id="r2", ingested_at=TIME, raw_time="event_timestamp"
    )
    assert moved.first().record_hash == row.record_hash


def test_basic_quality_routing(spark):
    rows = [
        observation("O1"),
        observation(None),
        observation("O2", batch_id="B9"),
        observation("O3", event_timestamp="2026-99-77T25:61:00Z"),
        observation("O4", sample_temperature_c=145.0),
        observation("O5", unit="degF"),
        observation("O6", spec_upper=None),
        observation("O1"),
    ]
    routed = route(quality(spark, *rows), quality_policy_basic(), known(spark, ("B1", "S1", "P1")).select("batch_id"))
    assert reasons(routed.quarantine, "observation_id") == [
        ("", "NULL_BUSINESS_KEY"), ("O1", "DUPLICATE_RECORD"), ("O2", "UNKNOWN_BATCH"), ("O3", "MALFORMED_TIMESTAMP"),
        ("O4", "IMPOSSIBLE_TEMPERATURE"), ("O5", "INCONSISTENT_UNIT"), ("O6", "INVALID_QUALITY_RESULT"),
    ]
    valid = routed.valid
    assert [r.observation_id for r in valid.collect()] == ["O1"]
    assert dict(valid.dtypes)["event_timestamp_utc"] == "timestamp" and REASON not in valid.columns
    assert dict(routed.quarantine.dtypes)["event_timestamp_utc"] == "string"


def test_null_optional_values_pass_and_unknown_test_fails(spark):
    rows = [observation("O1", sample_temperature_c=None), observation("O2", unit=None), observation("O3", test_type="colour")]
    routed = route(quality(spark, *rows), quality_policy_basic(), known(spark, ("B1", "S1", "P1")))
    assert reasons(routed.quarantine, "observation_id") == [("O3", "INCONSISTENT_UNIT")]


def test_published_quality_rules_check_site_and_product(spark):
    rows = [
        observation("O1", result_value=None), observation("O2", batch_id=None), observation("O3", site_id=None),
        observation("O4", site_id="S2"), observation("O5", product_id="P2"), observation("O6", batch_id="B9"),
    ]
    routed = route(quality(spark, *rows), quality_policy(), known(spark, ("B1", "S1", "P1")))
    assert reasons(routed.quarantine, "observation_id") == [
        ("O2", "NULL_BATCH_ID"), ("O3", "NULL_SITE_ID"), ("O4", "UNKNOWN_SITE"), ("O5", "UNKNOWN_PRODUCT"), ("O6", "UNKNOWN_BATCH"),
    ]
    assert [r.observation_id for r in routed.valid.collect()] == ["O1"]


def test_no_copy_survives_a_rejected_first_copy(spark):
    # Same event id; the first copy by offset has a bad unit, the second is good but still a copy.
    rows = [reading("E1", unit="F"), reading("E1")]
    routed = route(telemetry(spark, *rows).coalesce(1), telemetry_policy(), known(spark, ("B1", "S1", "P1")))
    assert reasons(routed.quarantine, "event_id") == [("E1", "DUPLICATE_EVENT_ID"), ("E1", "INCONSISTENT_UNIT")]
    assert routed.valid.count() == 0


def test_published_telemetry_rules_and_silent_drop(spark):
    rows = [
        reading("E1"), reading(None), reading(None), reading("E2", batch_id=None), reading("E3", site_id=None),
        reading("E4", batch_id="B9"), reading("E5", site_id="S9"), reading("E6", event_ts="never"),
        reading("E7", value=145.0), reading("E8", unit="F"), reading("E9", metric_name="vibration_mm_s", unit="mm/s", value=90.0),
        reading("E10", value=None), reading("E11", unit=None), reading("E12", metric_name="noise", unit="dB"),
        reading("E1"),
    ]
    routed = route(telemetry(spark, *rows), telemetry_policy(), known(spark, ("B1", "S1", "P1")))
    assert reasons(routed.quarantine, "event_id") == sorted(
        [
            ("", "NULL_EVENT_ID"), ("", "NULL_EVENT_ID"), ("E2", "NULL_BATCH_ID"), ("E3", "NULL_SITE_ID"), ("E4", "UNKNOWN_BATCH"),
            ("E5", "UNKNOWN_SITE"), ("E6", "MALFORMED_TIMESTAMP"), ("E7", "IMPOSSIBLE_TEMPERATURE"),
            ("E8", "INCONSISTENT_UNIT"), ("E1", "DUPLICATE_EVENT_ID"),
        ]
    )
    # A vibration of 90 and a NULL value leave through the silent expectation, not through quarantine.
    assert sorted(r.event_id for r in routed.valid.collect()) == ["E1", "E11", "E12"]
    assert routed.accounting().first().asDict() == {
        "input_rows": 15, "valid_rows": 3, "quarantined_rows": 10, "dropped_rows": 2, "balanced": True,
    }


def test_basic_telemetry_routing(spark):
    rows = [reading("E1"), reading(None), reading("E2", value=145.0), reading("E1", value=6.0)]
    routed = route(telemetry(spark, *rows), telemetry_policy_basic())
    assert reasons(routed.quarantine, "event_id") == [
        ("", "NULL_EVENT_ID"), ("E1", "DUPLICATE_EVENT_ID"), ("E2", "IMPOSSIBLE_TEMPERATURE"),
    ]


@pytest.mark.parametrize("position", [None, ["n"]])
def test_duplicates_equal_a_plain_ranking_on_skewed_keys(spark, position):
    rows = spark.range(0, 6000, 1, 16).selectExpr(
        "id AS n", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 5 = 0 THEN NULL ELSE id DIV 2 END AS k", "nullif(id % 4, 3) AS o"
    )
    order = ["o", "n"] if position is None else ["o"]
    marked = mark_duplicates(rows, ["k"], order, "dup", position)
    expected = spark.sql(
        "SELECT *, k IS NOT NULL AND row_number() OVER (PARTITION BY k ORDER BY o, n) > 1 AS dup FROM {rows}", rows=rows
    )
    assert marked.exceptAll(expected).count() == 0 and marked.count() == 6000


def test_full_ties_keep_exactly_one(spark):
    rows = spark.range(0, 300, 1, 8).selectExpr("'same' AS k", "1 AS o")
    marked = mark_duplicates(rows, ["k"], ["o"], "dup")
    assert marked.filter("NOT dup").count() == 1 and marked.count() == 300


def test_expectations(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 500.0)], "id INT, v DOUBLE")
    rule = Expectation("v_in_range", F.col("v").between(0.0, 150.0))
    assert [tuple(r) for r in expectations.report(df, [rule]).collect()] == [("v_in_range", 1, 2)]
    assert [r.id for r in expectations.drop_violations(df, [rule]).collect()] == [1]
    with pytest.raises(expectations.ExpectationFailed, match="2 violating rows, first id 2"):
        expectations.require(df, rule, "id")
    with pytest.raises(Exception, match="v_in_range violated by id"):
        expectations.fail_in_plan(df, rule, "id").collect()
    watched, observation = expectations.observe(df, [rule], "pass")
    watched.write.format("noop").mode("overwrite").save()
    assert observation.get == {"rows": 3, "v_in_range": 2}
