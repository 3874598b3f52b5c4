"""Tables: reads, full-overwrite publication, JSON receipts, catalog metadata and masking views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.schemas import LAYERS


def create_layers(spark: SparkSession, layers: Sequence[str] = LAYERS, location: str | None = None) -> None:
    for layer in layers:
        place = f" LOCATION '{location.rstrip('/')}/{layer}'" if location else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {layer}{place}")


def read_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.table(table)


def read_table_as_stream(spark: SparkSession, table: str, source_format: str = "parquet", **options: str) -> DataFrame:
    """New rows of a table as a stream: by name where the format supports it, else from its files."""
    if source_format != "parquet":
        return spark.readStream.format(source_format).options(**options).table(table)
    stored = spark.table(table)
    place = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").first().data_type
    return spark.readStream.schema(stored.schema).options(**options).parquet(place)


def publish(
    df: DataFrame,
    table: str,
    source_format: str = "parquet",
    partition_by: Sequence[str] = (),
    rebalance: bool = True,
) -> None:
    """Replace a table with the frame, schema included.

    With partition columns the rows are rebalanced on them first: small partitions share a task and
    a large one is split, so no partition's files depend on the number of upstream tasks. A column
    of a few values needs no such shuffle; switch it off there.
    """
    ready = df.hint("rebalance", *partition_by) if partition_by and rebalance else df
    writer = ready.write.format(source_format).mode("overwrite").option("overwriteSchema", "true")
    # A static overwrite: a full publication must not leave old partitions behind.
    writer = writer.option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def write_receipt(document: DataFrame, path: str) -> None:
    """A one-row document as JSON."""
    document.coalesce(1).write.mode("overwrite").json(path)


# Descriptions of the published tables.
GOLD_COMMENTS = {
    "fact_batch_quality": "One accepted laboratory quality observation per observation_id.",
    "fact_cold_chain_excursion": "One detected cold-chain excursion per batch, sensor and 15-minute window.",
    "dim_batch_history": "SCD Type 2 batch history with exactly one current version.",
    "dim_site": "One synthetic manufacturing site per site_id.",
    "dim_product": "One synthetic regulated product per product_id.",
    "kpi_quality_summary": "Daily site and product quality, quarantine, and throughput KPIs.",
}
GOLD_PROPERTIES = {"portfolio.tier": "gold", "data.classification": "synthetic"}


def describe_tables(
    spark: SparkSession,
    layer: str,
    comments: Mapping[str, str] = GOLD_COMMENTS,
    properties: Mapping[str, str] = GOLD_PROPERTIES,
) -> None:
    """Set table comments and properties."""
    pairs = ", ".join(f"'{_quoted(k)}' = '{_quoted(v)}'" for k, v in properties.items())
    for name, comment in comments.items():
        spark.sql(f"COMMENT ON TABLE {layer}.{name} IS '{_quoted(comment)}'")
        if pairs:
            spark.sql(f"ALTER TABLE {layer}.{name} SET TBLPROPERTIES ({pairs})")


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def masking_view(
    spark: SparkSession, table: str, view: str, masked: Sequence[str], privileged: str = "current_user() = 'admin'"
) -> None:
    """A view that shows masked columns only where the ``privileged`` SQL condition holds."""
    hidden = set(masked)
    parts = [
        f"CASE WHEN {privileged} THEN `{c}` END AS `{c}`" if c in hidden else f"`{c}`"
        for c in spark.table(table).columns
    ]
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {', '.join(parts)} FROM {table}")
