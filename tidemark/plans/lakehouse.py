"""The data product end to end: landed files and messages to validated, described gold tables.

Each stage is a function that reads stored tables and publishes stored tables, so a failed run is
resumed at its stage and nothing is recomputed across stages.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import content, contracts, expectations, gold, history
from tidemark.operators.provenance import change_log, stamp, stamp_change_log
from tidemark.operators.routing import DISPOSITION, PARSED, REASON, Routed, quality_policy, route, telemetry_policy
from tidemark.sources import files, messages, tables
from tidemark.streaming import bronze

POSITION = ("_file", "_row")
# The tables that a run's receipt counts and hashes.
COUNTED = (
    "bronze.batch_quality_raw", "bronze.batch_change_events", "bronze.sensor_telemetry_raw",
    "silver.batch_quality_valid", "silver.sensor_telemetry_valid", "silver.batch_master_current",
    "silver.batch_history_scd2", "silver.quarantined_quality_records", "silver.quarantined_telemetry",
    "gold.fact_batch_quality", "gold.fact_cold_chain_excursion", "gold.dim_batch_history",
    "gold.dim_site", "gold.dim_product", "gold.kpi_quality_summary",
)
HASHED = (
    "silver.batch_quality_valid", "silver.sensor_telemetry_valid", "silver.batch_history_scd2",
    "gold.fact_batch_quality", "gold.fact_cold_chain_excursion", "gold.kpi_quality_summary",
)


@dataclass(frozen=True)
class Run:
    """One run over a source folder. ``state`` holds the stream's messages and checkpoint."""

    spark: SparkSession
    source: str
    state: str
    run_id: str
    ingested_at: str
    table_format: str = "parquet"

    def json(self, name: str, schema, source_file: bool = False) -> DataFrame:
        return files.read_json_lines(self.spark, f"{self.source}/{name}", schema, source_file)

    def publish(
        self, df: DataFrame, table: str, partition_by: tuple[str, ...] = (), rebalance: bool = True
    ) -> None:
        tables.publish(df, table, self.table_format, partition_by, rebalance)


def bronze_batch(run: Run, incident: bool = False) -> None:
    """Quality files and the change log, stamped and otherwise untouched."""
    landed = run.json("quality", schemas.QUALITY_SOURCE, source_file=True).select(
        *schemas.QUALITY_SOURCE.fieldNames(), "source_file"
    )
    if incident:
        failure = run.json("hard_failure/reserved_schema_failure", schemas.QUALITY_SOURCE, source_file=True)
        landed = files.with_extra_files(landed, failure)
    stamped = stamp(
        landed,
        source_file=F.col("source_file"),
        run_id=run.run_id,
        ingested_at=run.ingested_at,
        raw_time="event_timestamp",
    )
    run.publish(stamped, "bronze.batch_quality_raw")

    master = run.json("batch/batch_master", schemas.BATCH_MASTER)
    changes = run.json("cdc/batch_change_events", schemas.CHANGE_EVENT)
    log = stamp_change_log(
        change_log(master, changes), source_file="source/batch-and-cdc", run_id=run.run_id, ingested_at=run.ingested_at
    )
    run.publish(log, "bronze.batch_change_events")


def replay_messages(run: Run, limit: int, topic: str = "quality-telemetry", servers: str | None = None) -> DataFrame:
    """Exactly ``limit`` messages from the source to the brokers, or into the run's message folder if none are named."""
    lines = messages.text_lines(run.spark, f"{run.source}/messages/sensor_messages")
    return messages.replay(lines, limit, topic, f"{run.state}/messages", servers=servers)


def message_stream(
    run: Run, topic: str = "quality-telemetry", servers: str | None = None, jaas: str | None = None, rate: int | None = None
) -> DataFrame:
    """The topic at the brokers, ``rate`` messages a micro-batch; without brokers the run's message folder, ``rate`` files each."""
    if servers:
        return messages.kafka_stream(run.spark, servers, topic, jaas, rate or messages.MESSAGES_PER_TRIGGER)
    return messages.message_file_stream(run.spark, f"{run.state}/messages", rate or 1)


def bronze_stream(run: Run, stream: DataFrame | None = None, origin: str = "eventhubs://quality-telemetry"):
    """Append all available messages to telemetry Bronze; ``message_stream`` reads a broker too."""
    source = stream if stream is not None else message_stream(run)
    parsed = bronze.bronze_messages(source, run.run_id, origin)
    return bronze.append_to_table(
        parsed, "bronze.sensor_telemetry_raw", f"{run.state}/checkpoints/bronze-telemetry", run.table_format
    )


def silver_batches(run: Run) -> None:
    """Current and known batches and the history, all from the stored change log."""
    log = run.spark.table("bronze.batch_change_events")
    run.publish(history.current_state(log), "silver.batch_master_current")
    # Stored, so that the routing joins know its size when they are planned.
    run.publish(history.known_batches(log), "silver.known_batches")
    versions = history.publishable_history(history.history_tracked(log))
    run.publish(versions, "silver.batch_history_scd2")


def stored_rows(spark: SparkSession, table: str) -> DataFrame:
    """A stored table with each row's place, which settles ties between equal copies."""
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    return spark.table(table).select("*", *place)


def quality_gate(run: Run) -> DataFrame:
    """Check the hard contract, then write each evaluated table once; returns expectation counts.

    The trusted and quarantine tables are views that read their partition of the evaluated table.
    """
    spark = run.spark
    observed = spark.table("bronze.batch_quality_raw")
    expectations.require(observed, expectations.hard_contract(), "observation_id")
    known = spark.table("silver.known_batches")

    routed = route(stored_rows(spark, "bronze.batch_quality_raw"), quality_policy(position=POSITION), known)
    _publish_routed(run, routed, "quality", "silver.batch_quality_valid", "silver.quarantined_quality_records")
    _account(run, "quality", "bronze.batch_quality_raw")
    telemetry = route(spark.table("bronze.sensor_telemetry_raw"), telemetry_policy(), known)
    _publish_routed(run, telemetry, "telemetry", "silver.sensor_telemetry_valid", "silver.quarantined_telemetry")
    _account(run, "telemetry", "bronze.sensor_telemetry_raw")
    return expectations.report(observed, expectations.observed_expectations())


def _publish_routed(run: Run, routed: Routed, name: str, valid: str, quarantine: str) -> None:
    evaluated = f"silver.{name}_evaluated"
    # Three dispositions: each task writes at most three files, and the wide rows are not shuffled again.
    run.publish(routed.labelled.drop(*POSITION), evaluated, (DISPOSITION,), rebalance=False)
    raw = routed.policy.raw_time
    columns = [c for c in run.spark.table(evaluated).columns if c not in (DISPOSITION, REASON, PARSED, raw)]
    listed = ", ".join(f"`{c}`" for c in columns)
    run.spark.sql(
        f"CREATE OR REPLACE VIEW {valid} AS SELECT {listed}, `{PARSED}` AS `{raw}` "
        f"FROM {evaluated} WHERE {DISPOSITION} = 'valid'"
    )
    run.spark.sql(
        f"CREATE OR REPLACE VIEW {quarantine} AS SELECT {listed}, `{raw}`, `{REASON}` "
        f"FROM {evaluated} WHERE {DISPOSITION} = 'quarantined'"
    )


def _account(run: Run, name: str, source: str) -> None:
    """Every Bronze row must be valid, quarantined or dropped, once; the counts are published.

    Both counts come from stored tables and a partition column, so neither reads a data column.
    """
    counted = run.spark.table(f"silver.{name}_evaluated").groupBy(DISPOSITION).agg(F.count(F.lit(1)).alias("records"))
    run.publish(counted, f"silver.{name}_accounting")
    routed = run.spark.table(f"silver.{name}_accounting").agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0]
    given = run.spark.table(source).count()
    if routed != given:
        raise contracts.GateFailed(f"{source} has {given} rows but {routed} were routed")


def publish_gold(run: Run) -> None:
    """Facts first, then the KPI from the stored facts, so no fact is computed twice."""
    spark = run.spark
    versions = spark.table("silver.batch_history_scd2")
    quality = gold.batch_quality_fact(spark.table("silver.batch_quality_valid"))
    run.publish(quality, "gold.fact_batch_quality", ("reporting_date",))
    current = versions.filter("is_current").select("batch_id", "product_id", "site_id")
    products = run.json("reference/products", schemas.PRODUCT)
    run.publish(
        gold.excursion_fact(spark.table("silver.sensor_telemetry_valid"), current, products),
        "gold.fact_cold_chain_excursion",
    )
    run.publish(versions, "gold.dim_batch_history")
    run.publish(run.json("reference/sites", schemas.SITE), "gold.dim_site")
    run.publish(products, "gold.dim_product")
    kpi = gold.daily_kpis(
        spark.table("gold.fact_batch_quality"),
        spark.table("silver.quarantined_quality_records"),
        spark.table("gold.fact_cold_chain_excursion"),
    )
    run.publish(kpi, "gold.kpi_quality_summary")
    tables.describe_tables(spark, "gold")
    tables.masking_view(spark, "gold.fact_batch_quality", "governance.fact_batch_quality_masked", ["result_value"])


def gold_frames(spark: SparkSession) -> dict[str, DataFrame]:
    return {name: spark.table(f"gold.{name}") for name in contracts.GOLD_CONTRACTS}


def validate(run: Run) -> DataFrame:
    """The gold checks, enforced."""
    checks = contracts.gold_checks(gold_frames(run.spark))
    contracts.enforce(checks)
    return checks


def receipt(run: Run) -> DataFrame:
    """Counts, content digests, duplicates, version violations and KPI totals of the stored tables."""
    spark, published = run.spark, gold_frames(run.spark)
    duplicates = {
        name: contracts.grain_violations(published[name], contracts.GOLD_CONTRACTS[name].keys)
        for name in ("fact_batch_quality", "kpi_quality_summary")
    }
    return content.run_receipt(
        {name: spark.table(name) for name in COUNTED},
        {name: spark.table(name) for name in HASHED},
        duplicates,
        contracts.current_version_violations(published["dim_batch_history"], ["batch_id"]),
        published["kpi_quality_summary"],
    )


def run_all(run: Run, message_limit: int, incident: bool = False) -> DataFrame:
    """Every stage in order; returns the receipt of a validated run."""
    contracts.preflight(run.spark, schemas.LAYERS)
    bronze_batch(run, incident)
    replay_messages(run, message_limit)
    bronze_stream(run)
    silver_batches(run)
    quality_gate(run)
    publish_gold(run)
    validate(run)
    return receipt(run)
