"""Where a record came from and what it was: provenance columns and content hashes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import canonical_json, digest

# Provenance that changes from run to run and therefore stays out of content comparisons.
VOLATILE = ("ingest_timestamp_utc", "pipeline_run_id")


def stamp(
    df: DataFrame,
    *,
    source_file: str | Column,
    run_id: str,
    ingested_at: str | datetime | Column,
    raw_time: str,
    keep_nulls: bool = True,
    hash_text: Column | None = None,
) -> DataFrame:
    """Add source file, ingest time, the untouched event time, run id and record hash.

    Nothing is cleansed. The hash covers the source columns in name order and no provenance, so the
    same record in two files has one hash. A ``source_file`` column of the input is not hashed.
    """
    content = [c for c in df.columns if c != "source_file"]
    body = hash_text if hash_text is not None else canonical_json(content, keep_nulls)
    origin = source_file if isinstance(source_file, Column) else F.lit(source_file)
    return df.withColumns(
        {
            "source_file": origin,
            "ingest_timestamp_utc": _instant(ingested_at),
            "event_timestamp_utc": F.col(raw_time),
            "pipeline_run_id": F.lit(run_id),
            "record_hash": digest(body),
        }
    )


def _instant(value: str | datetime | Column) -> Column:
    if isinstance(value, Column):
        return value
    return F.to_timestamp(F.lit(value)) if isinstance(value, str) else F.lit(value)


def change_log(
    master: DataFrame,
    changes: DataFrame,
    key: str = "batch_id",
    carried: tuple[str, ...] = ("site_id", "product_id", "lot_number", "manufactured_at"),
    tracked: tuple[str, ...] = ("release_status",),
    baseline_source: str = "batch_master_synthetic",
) -> DataFrame:
    """One log of change events: each master row as an INSERT, and the changes completed from it.

    A change to a key the master does not hold has nothing to be completed from and leaves the log.
    """
    common = ("sequence_number", "effective_at")
    baseline = master.select(
        F.concat(F.lit("BASE-"), F.col(key).cast("string")).alias("event_id"),
        key,
        F.lit("INSERT").alias("operation"),
        *common,
        *tracked,
        *carried,
        F.lit(baseline_source).alias("source_system"),
        "schema_version",
    )
    completed = changes.join(master.select(key, *carried), key).select(*baseline.columns)
    return baseline.unionByName(completed)


def stamp_change_log(
    log: DataFrame, *, source_file: str, run_id: str, ingested_at: str | datetime
) -> DataFrame:
    """Provenance for the change log. Its hash leaves NULL fields out, and it keeps its own time column."""
    return stamp(
        log,
        source_file=source_file,
        run_id=run_id,
        ingested_at=ingested_at,
        raw_time="effective_at",
        keep_nulls=False,
    ).drop("event_timestamp_utc")
