"""Table contracts and the checks they drive. Checks are frames; only a gate raises."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class GateFailed(RuntimeError):
    """One or more named checks did not hold."""


@dataclass(frozen=True)
class TableContract:
    grain: str
    keys: tuple[str, ...]
    upstream: tuple[str, ...]


# Grain, key and lineage of the published tables.
GOLD_CONTRACTS: dict[str, TableContract] = {
    "fact_batch_quality": TableContract(
        "one quality measurement for one batch characteristic at one observation time",
        ("observation_id",),
        ("silver.batch_quality_valid",),
    ),
    "fact_cold_chain_excursion": TableContract(
        "one detected environmental excursion episode per batch and sensor interval",
        ("excursion_id",),
        ("silver.sensor_telemetry_valid", "silver.batch_master_current"),
    ),
    "dim_batch_history": TableContract(
        "one effective SCD Type 2 version of one batch",
        ("batch_id", "effective_start_utc"),
        ("silver.batch_history_scd2",),
    ),
    "dim_site": TableContract("one synthetic manufacturing site", ("site_id",), ("source.reference.sites",)),
    "dim_product": TableContract(
        "one synthetic quality-critical product", ("product_id",), ("source.reference.products",)
    ),
    "kpi_quality_summary": TableContract(
        "one site by product by reporting date",
        ("site_id", "product_id", "reporting_date"),
        ("gold.fact_batch_quality", "gold.fact_cold_chain_excursion"),
    ),
}


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def grain_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def grain_report(tables: Mapping[str, DataFrame], contracts: Mapping[str, TableContract]) -> DataFrame:
    """Number of violating keys per table, in one job."""
    return _union(
        [
            grain_violations(tables[name], contract.keys).agg(
                F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("duplicate_keys")
            )
            for name, contract in contracts.items()
            if name in tables
        ]
    )


def current_version_violations(
    history: DataFrame, keys: Sequence[str], deletes_allowed: bool = False
) -> DataFrame:
    """Keys without exactly one current version; with deletes, keys with more than one."""
    open_versions = history.groupBy(*keys).agg(
        F.sum(F.when(F.col("is_current"), 1).otherwise(0)).alias("current_versions")
    )
    return open_versions.filter("current_versions > 1" if deletes_allowed else "current_versions <> 1")


def check_rows_positive(name: str, df: DataFrame) -> DataFrame:
    # One row is enough to know; a full count is not needed.
    return df.limit(1).agg(
        F.lit(name).alias("check_name"),
        (F.count(F.lit(1)) > 0).alias("ok"),
        F.lit(0).cast("bigint").alias("violations"),
    )


def check_no_rows(name: str, violations: DataFrame) -> DataFrame:
    found = F.count(F.lit(1))
    return violations.agg(F.lit(name).alias("check_name"), (found == 0).alias("ok"), found.alias("violations"))


def gold_checks(gold: Mapping[str, DataFrame]) -> DataFrame:
    """The four invariants that must hold before a run counts as good."""
    quality, kpi = gold["fact_batch_quality"], gold["kpi_quality_summary"]
    keys = {name: GOLD_CONTRACTS[name].keys for name in ("fact_batch_quality", "kpi_quality_summary")}
    return _union(
        [
            check_rows_positive("quality_rows_positive", quality),
            check_no_rows("no_quality_key_duplicates", grain_violations(quality, keys["fact_batch_quality"])),
            check_no_rows(
                "one_current_batch_version", current_version_violations(gold["dim_batch_history"], ["batch_id"])
            ),
            check_no_rows("kpi_grain_unique", grain_violations(kpi, keys["kpi_quality_summary"])),
        ]
    )


def enforce(checks: DataFrame, failure: str = "Gold validation failures") -> None:
    """Raise with the names of the checks that failed. One row per check reaches the driver."""
    failed = sorted(row.check_name for row in checks.filter(~F.col("ok")).select("check_name").collect())
    if failed:
        raise GateFailed(f"{failure}: {failed}")


def lineage(spark: SparkSession, contracts: Mapping[str, TableContract] = GOLD_CONTRACTS) -> DataFrame:
    """Contract lineage as edges (object, upstream)."""
    edges = [(name, parent) for name, contract in contracts.items() for parent in contract.upstream]
    return spark.createDataFrame(edges, "object STRING, upstream STRING")


def missing_layers(spark: SparkSession, required: Sequence[str], catalog: str | None = None) -> DataFrame:
    """Required schemas that the catalog does not have."""
    name = "" if catalog is None else f" IN `{catalog.replace('`', '``')}`"
    present = spark.sql(f"SHOW SCHEMAS{name}").toDF("layer")
    wanted = spark.createDataFrame([(layer,) for layer in required], "layer STRING")
    return wanted.join(present, "layer", "left_anti")


def preflight(spark: SparkSession, required: Sequence[str], catalog: str | None = None) -> None:
    absent = sorted(row.layer for row in missing_layers(spark, required, catalog).collect())
    if absent:
        raise GateFailed(f"missing required schemas: {absent}")


def unresolved_references(
    children: DataFrame, child_key: str, parents: DataFrame, parent_key: str
) -> DataFrame:
    """Child rows whose reference has no parent; a NULL reference is unresolved too."""
    # Distinct parents: repeats of one parent collapse before the shuffle.
    known = parents.select(F.col(parent_key).alias("_parent")).distinct()
    return children.join(known, F.col(child_key) == F.col("_parent"), "left_anti")


def broken_sequences(df: DataFrame, group: Sequence[str], sequence: str, first: int = 1) -> DataFrame:
    """Groups whose sequence is not first, first + 1, ... without gap or repeat.

    Count, minimum and maximum decide together with the number of distinct values; no group is
    sorted or collected.
    """
    stats = df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.countDistinct(sequence).alias("distinct_values"),
        F.min(sequence).alias("first_value"),
        F.max(sequence).alias("last_value"),
    )
    complete = (
        (F.col("distinct_values") == F.col("row_count"))
        & (F.col("first_value") == first)
        & (F.col("last_value") == F.col("row_count") + (first - 1))
    )
    return stats.filter(~F.coalesce(complete, F.lit(False)))


def unexpected_types(changes: DataFrame, type_column: str, expected: DataFrame, expected_column: str) -> DataFrame:
    """Distinct types that occur but are not expected."""
    occurring = changes.filter(F.col(type_column).isNotNull()).select(type_column).distinct()
    return occurring.join(
        expected.select(F.col(expected_column).alias(type_column)).distinct(), type_column, "left_anti"
    )


def inventory_checks(
    changes: DataFrame, change_column: str, type_column: str, expected: DataFrame, expected_column: str
) -> DataFrame:
    """Any deletion stops, and so does any type that is not expected."""
    return _union(
        [
            check_no_rows("no_deletions", changes.filter(F.col(change_column) == "Delete")),
            check_no_rows(
                "no_unexpected_types", unexpected_types(changes, type_column, expected, expected_column)
            ),
        ]
    )


# Fixed values of the artifact registry contract.
ARTIFACT_STATUSES = ("VERIFIED", "DEMONSTRATED", "PRODUCTION_BLUEPRINT")
ARTIFACT_FIELDS = (
    "artifact_id", "claim", "status", "service", "captured_at_utc", "screenshot", "receipt", "code_path",
    "validation", "run_id", "commit_sha", "sha256", "notes", "limitation",
)
VERIFIED_FIELDS = (
    "screenshot", "receipt", "code_path", "validation", "run_id", "commit_sha", "sha256", "captured_at_utc",
)


def registry_violations(artifacts: DataFrame) -> DataFrame:
    """Every broken rule of every artifact as (artifact_id, rule).

    A field that is not a column of the frame is missing on all artifacts. Row rules are one array
    projection; only the uniqueness rule groups.
    """
    absent = [f for f in ARTIFACT_FIELDS if f not in artifacts.columns]
    rows = artifacts.withColumns({f: F.lit(None).cast("string") for f in absent})
    unnamed = _blank("artifact_id")
    status = F.col("status")
    broken = [
        *[F.lit(f"missing field {f}") for f in absent],
        F.when(unnamed, F.lit("invalid artifact_id")),
        F.when(~F.coalesce(status.isin(*ARTIFACT_STATUSES), F.lit(False)), F.lit("invalid status")),
        *[F.when((status == "VERIFIED") & _blank(f), F.lit(f"VERIFIED requires {f}")) for f in VERIFIED_FIELDS],
        F.when(
            (status == "PRODUCTION_BLUEPRINT") & (F.coalesce(F.col("limitation"), F.lit("")) == ""),
            F.lit("PRODUCTION_BLUEPRINT requires limitation"),
        ),
    ]
    by_row = rows.select("artifact_id", F.explode(F.array_compact(F.array(*broken))).alias("rule"))
    repeated = grain_violations(rows.filter(~unnamed), ["artifact_id"]).select(
        "artifact_id", F.lit("duplicate artifact_id").alias("rule")
    )
    return by_row.unionByName(repeated)


def _blank(column: str) -> Column:
    return F.trim(F.coalesce(F.col(column).cast("string"), F.lit(""))) == ""


def registry_from_document(document: DataFrame, artifacts: str = "artifacts") -> DataFrame:
    """Registry rows from documents that hold an array of artifact structs."""
    return document.select(F.explode(artifacts).alias("_a")).select("_a.*")


def build_registry(
    chapters: DataFrame, receipts: DataFrame, key: str, captured: Sequence[str], blueprint: Column
) -> DataFrame:
    """Chapters with their receipt: first non-NULL capture time wins, else PENDING.

    ``receipt_missing`` marks chapters that need a receipt and have none; a gate stops on those.
    """
    joined = chapters.join(receipts.withColumn("_found", F.lit(True)), key, "left")
    return joined.withColumn(
        "captured_at_utc",
        F.coalesce(*[F.col(c).cast("string") for c in captured], F.lit("PENDING")),
    ).withColumn("receipt_missing", F.col("_found").isNull() & ~blueprint).drop("_found")
