"""Content digests of whole tables, run receipts and the comparison of two runs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import canonical_json, digest
from tidemark.operators.provenance import VOLATILE

# Part of the digest's definition, not a setting: 16^9 leaves leave few rows to a leaf at any size.
LEAF_HEX = 9
FAN_HEX = 3
LANES = 12
LANE_HEX = 5


def row_digests(df: DataFrame, exclude: Sequence[str] = VOLATILE, text: Column | None = None) -> DataFrame:
    """One SHA-256 per row over its columns in name order, volatile provenance left out."""
    names = [c for c in df.columns if c not in exclude]
    return df.select(digest(text if text is not None else canonical_json(names)).alias("h"))


def content_digest(
    df: DataFrame,
    exclude: Sequence[str] = VOLATILE,
    text: Column | None = None,
) -> DataFrame:
    """One row (row_count, content_sha256) that does not depend on row order or partitioning.

    Equal rows collapse to (digest, copies) before the shuffle, so copies cannot make a bucket hot,
    and distinct SHA-256 values spread evenly over 16^9 leaves: 15 to a leaf at 10^12 distinct rows.
    Leaf digests are folded 16^3 at a time. Nothing in the definition is to be tuned, so digests taken
    before and after a table has grown compare.
    """
    copies = row_digests(df, exclude, text).groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    level = copies.select(
        F.substring("h", 1, LEAF_HEX).alias("prefix"), F.concat_ws(":", "h", "n").alias("entry"), "n"
    )
    level = fold(level)
    width = LEAF_HEX
    while width > 0:
        width = max(0, width - FAN_HEX)
        level = fold(
            level.select(
                F.substring("prefix", 1, width).alias("prefix"), F.concat_ws(":", "prefix", "entry").alias("entry"), "n"
            )
        )
    total = level.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.max("entry").alias("content_sha256")
    )
    return total.withColumn("content_sha256", F.coalesce("content_sha256", digest(F.lit(""))))


def fold(level: DataFrame) -> DataFrame:
    """One digest per prefix over its entries in order, with their number of rows."""
    entries = F.array_join(F.sort_array(F.collect_list("entry")), "\n")
    return level.groupBy("prefix").agg(digest(entries).alias("entry"), F.sum("n").alias("n"))


def fingerprint(
    df: DataFrame,
    exclude: Sequence[str] = VOLATILE,
    text: Column | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Row count and fingerprint, per group or for all rows, from sums of digest lanes.

    Twelve 20-bit lanes of each row digest are added up and the sums are hashed: one pass, and only
    partial sums are shuffled. Adding is order-free and counts copies. Sums stay below 2^63 up to
    8 * 10^12 rows and overflow raises.
    """
    names = [c for c in df.columns if c not in exclude]
    rows = df.select(*by, digest(text if text is not None else canonical_json(names)).alias("h"))
    lanes = [
        F.sum(F.conv(F.substring("h", 1 + i * LANE_HEX, LANE_HEX), 16, 10).cast("bigint")).alias(f"lane_{i}")
        for i in range(LANES)
    ]
    sums = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"), *lanes)
    written = F.concat_ws(",", *[F.coalesce(F.col(f"lane_{i}"), F.lit(0)) for i in range(LANES)])
    return sums.select(*by, "row_count", digest(written).alias("fingerprint"))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Exact row counts of many tables in one job."""
    counted = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def kpi_aggregates(kpi: DataFrame) -> DataFrame:
    return kpi.agg(
        F.sum("batches_processed").alias("batches_processed_sum"),
        F.sum("records_quarantined").alias("records_quarantined_sum"),
        F.round(F.avg("quality_pass_rate"), 12).alias("mean_quality_pass_rate"),
    )


def run_receipt(
    counted: Mapping[str, DataFrame],
    hashed: Mapping[str, DataFrame],
    duplicate_groups: Mapping[str, DataFrame],
    version_violations: DataFrame | None = None,
    kpi: DataFrame | None = None,
    texts: Mapping[str, Column] | None = None,
) -> DataFrame:
    """What a run produced, as rows (section, name, value): a few dozen, whatever the tables' size.

    ``texts`` gives the row text of a hashed table where its digest is compared with another engine's.
    """
    parts = [
        row_counts(counted).select(
            F.lit("row_counts").alias("section"),
            F.col("table_name").alias("name"),
            F.col("row_count").cast("string").alias("value"),
        )
    ]
    for name, df in hashed.items():
        parts.append(
            content_digest(df, text=(texts or {}).get(name)).select(
                F.lit("content_hashes").alias("section"), F.lit(name).alias("name"), F.col("content_sha256").alias("value")
            )
        )
    for name, df in duplicate_groups.items():
        parts.append(_count_part("duplicate_business_keys", name, df))
    if version_violations is not None:
        parts.append(_count_part("current_version_violations", "current_version_violations", version_violations))
    if kpi is not None:
        totals = kpi_aggregates(kpi)
        entries = F.array(
            *[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in totals.columns]
        )
        parts.append(
            totals.select(F.explode(entries).alias("e")).select(F.lit("aggregates").alias("section"), "e.name", "e.value")
        )
    return reduce(DataFrame.unionByName, parts)


def _count_part(section: str, name: str, df: DataFrame) -> DataFrame:
    return df.agg(
        F.lit(section).alias("section"), F.lit(name).alias("name"), F.count(F.lit(1)).cast("string").alias("value")
    )


def receipt_document(receipt: DataFrame, **facts: str) -> DataFrame:
    """The receipt as one row: run facts and one map per section, ready to be written as JSON."""
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "value"))))
    sections = receipt.groupBy("section").agg(entries.alias("entries"))
    body = sections.agg(F.map_from_entries(F.collect_list(F.struct("section", "entries"))).alias("sections"))
    return body.select(*[F.lit(v).alias(k) for k, v in facts.items()], "sections")


def compare_receipts(clean: DataFrame, recovered: DataFrame) -> DataFrame:
    """Every receipt entry of both runs side by side; an entry on one side only does not match."""
    left = clean.withColumnRenamed("value", "clean_value").withColumn("_in_clean", F.lit(True))
    right = recovered.withColumnRenamed("value", "recovered_value").withColumn("_in_recovered", F.lit(True))
    both = F.col("_in_clean").isNotNull() & F.col("_in_recovered").isNotNull()
    return left.join(right, ["section", "name"], "full_outer").select(
        "section", "name", "clean_value", "recovered_value",
        (both & F.col("clean_value").eqNullSafe(F.col("recovered_value"))).alias("matches"),
    )


def recovery_verdict(comparison: DataFrame) -> DataFrame:
    """One row: PASS when every entry matches."""
    return comparison.agg(
        F.count(F.lit(1)).alias("entries"), F.count_if(~F.col("matches")).alias("mismatches")
    ).withColumn("validation", F.when(F.col("mismatches") == 0, "PASS").otherwise("FAIL"))
