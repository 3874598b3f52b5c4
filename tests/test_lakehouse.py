"""The published data set end to end, against the published numbers."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import content
from tidemark.operators.expectations import ExpectationFailed
from tidemark.operators.history import history_recomputed
from tidemark.operators.routing import REASON
from tidemark.plans import lakehouse
from tidemark.schemas import BATCH_MASTER, CHANGE_EVENT, LAYERS
from tidemark.sources import fixtures, tables
from tidemark.sources.files import read_json_lines

SIZE = fixtures.FixtureSize()


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    """The data set with the published draws: one sequential generator, quality pairs then telemetry."""
    root = str(tmp_path_factory.mktemp("source"))
    numbers = random.Random(SIZE.seed)
    pairs = [(i, numbers.random(), numbers.random()) for i in range(SIZE.quality - 1)]
    singles = [(i, numbers.random()) for i in range(SIZE.telemetry - 1)]
    quality = spark.createDataFrame(pairs, "i BIGINT, result_u DOUBLE, temperature_u DOUBLE")
    telemetry = spark.createDataFrame(singles, "i BIGINT, value_u DOUBLE")
    fixtures.write_fixture(spark, root, SIZE, quality, telemetry)
    return root


@pytest.fixture(scope="module")
def run(spark, source, tmp_path_factory):
    tables.create_layers(spark, LAYERS)
    state = str(tmp_path_factory.mktemp("state"))
    return lakehouse.Run(spark, source, state, "run-clean", "2026-08-12T00:00:00Z")


@pytest.fixture(scope="module")
def receipt(run):
    return lakehouse.run_all(run, SIZE.messages)


@pytest.fixture(scope="module")
def values(receipt):
    return {(r.section, r.name): r.value for r in receipt.collect()}


def test_published_row_counts(values):
    counts = {name: int(v) for (section, name), v in values.items() if section == "row_counts"}
    assert counts == {
        "bronze.batch_quality_raw": 30_000,
        "bronze.batch_change_events": 648,
        "bronze.sensor_telemetry_raw": 20_000,
        "silver.batch_quality_valid": 29_994,
        "silver.quarantined_quality_records": 6,
        "silver.sensor_telemetry_valid": 2_856,
        "silver.quarantined_telemetry": 17_144,
        "silver.batch_master_current": 600,
        "silver.batch_history_scd2": 647,
        "gold.fact_batch_quality": 29_994,
        "gold.fact_cold_chain_excursion": 737,
        "gold.dim_batch_history": 647,
        "gold.dim_site": 12,
        "gold.dim_product": 20,
        "gold.kpi_quality_summary": 3_780,
    }


def test_published_aggregates(values):
    assert values["aggregates", "batches_processed_sum"] == "29994"
    assert values["aggregates", "records_quarantined_sum"] == "4"
    assert float(values["aggregates", "mean_quality_pass_rate"]) == 1.0
    assert values["duplicate_business_keys", "fact_batch_quality"] == "0"
    assert values["duplicate_business_keys", "kpi_quality_summary"] == "0"
    assert values["current_version_violations", "current_version_violations"] == "0"


def test_quarantine_reasons(spark, values):
    def reasons(table):
        return {r[0]: r[1] for r in spark.table(table).groupBy(REASON).count().collect()}

    assert reasons("silver.quarantined_quality_records") == {
        reason: 1
        for reason in (
            "NULL_BUSINESS_KEY", "UNKNOWN_BATCH", "MALFORMED_TIMESTAMP",
            "IMPOSSIBLE_TEMPERATURE", "INCONSISTENT_UNIT", "DUPLICATE_RECORD",
        )
    }
    assert reasons("silver.quarantined_telemetry") == {"UNKNOWN_SITE": 17_142, "NULL_EVENT_ID": 1, "NULL_BATCH_ID": 1}


def test_full_recompute_has_one_more_version(spark, source):
    master = read_json_lines(spark, f"{source}/batch/batch_master", BATCH_MASTER, source_file=False)
    changes = read_json_lines(spark, f"{source}/cdc/batch_change_events", CHANGE_EVENT, source_file=False)
    assert history_recomputed(master, changes).count() == 648


def test_restart_without_input_adds_nothing(spark, run, values):
    lakehouse.bronze_stream(run)
    assert spark.table("bronze.sensor_telemetry_raw").count() == 20_000


def test_masking_view_hides_results(spark, values):
    masked = spark.table("governance.fact_batch_quality_masked")
    assert masked.filter("result_value IS NOT NULL").count() == 0
    assert masked.count() == 29_994


def test_table_comment_and_property(spark, values):
    rows = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED gold.dim_site").collect()}
    assert rows["Comment"].startswith("One synthetic manufacturing site")
    properties = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES gold.dim_site").collect()}
    assert properties["portfolio.tier"] == "gold"


def test_receipt_document(receipt, values, tmp_path):
    document = content.receipt_document(receipt, run_id="run-clean", validation="PASS")
    tables.write_receipt(document, str(tmp_path / "receipt"))
    row = document.select(F.col("sections")["row_counts"]["gold.dim_site"].alias("sites")).first()
    assert row.sites == "12"


def test_incident_stops_and_recovery_matches(spark, run, receipt, values, tmp_path):
    clean = str(tmp_path / "clean")
    receipt.write.parquet(clean)
    lakehouse.bronze_batch(run, incident=True)
    assert spark.table("bronze.batch_quality_raw").count() == 30_001
    with pytest.raises(ExpectationFailed, match="HARD-FAIL-0001"):
        lakehouse.quality_gate(run)

    repaired = lakehouse.Run(spark, run.source, run.state, "run-repaired", "2026-08-12T01:00:00Z")
    lakehouse.bronze_batch(repaired)
    lakehouse.silver_batches(repaired)
    lakehouse.quality_gate(repaired)
    lakehouse.publish_gold(repaired)
    lakehouse.validate(repaired)
    compared = content.compare_receipts(spark.read.parquet(clean), lakehouse.receipt(repaired))
    verdict = content.recovery_verdict(compared).first()
    assert (verdict.entries, verdict.mismatches, verdict.validation) == (27, 0, "PASS")


def test_stage_job_checks_the_landing(spark, source, capsys):
    from tidemark.plans import jobs

    jobs.main(["verify-landing", "--source", source])
    assert '"rows": 30000' in capsys.readouterr().out
