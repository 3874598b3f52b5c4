"""KPIs that roll up: stored per-day states that merge to weeks, sites or all, without the facts.

A state row covers one group and one bucket of 32,768 entity numbers: a bitmap of the entities seen (exact distinct
counts survive any merge, where adding up daily counts would not), sums, and a quantile sketch. Everything in it merges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Items a sketch keeps at its top level, and the error of ranks that comes with it (single quantile, 99 %).
SKETCH_K, RANK_ERROR = 1000, 0.004


def daily_state(facts: DataFrame, grain: Sequence[str], entity: Column, passed: Column, measure: Column) -> DataFrame:
    """The state of facts at a grain. ``entity`` is a whole number (a dense one keeps states small); NULL ones are not counted.

    Aggregates with map-side combine: a hot group is split by its buckets, and rows of one bucket combine before the shuffle.
    """
    numbered = facts.select(*grain, entity.cast("bigint").alias("_entity"), passed.cast("boolean").alias("_passed"), measure.cast("double").alias("_measure"))
    numbered = numbered.withColumn("bucket", F.bitmap_bucket_number("_entity"))
    return numbered.groupBy(*grain, "bucket").agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_entity")).alias("entities"),
        F.count(F.lit(1)).alias("records"),
        F.count("_passed").alias("judged"),
        F.count_if("_passed").alias("passed"),
        F.count("_measure").alias("measured"),
        F.kll_sketch_agg_double("_measure", SKETCH_K).alias("sketch"),
    )


def merged(state: DataFrame, grain: Sequence[str]) -> DataFrame:
    """The state at a coarser grain, of which ``grain``'s columns are already part of ``state``."""
    return state.groupBy(*grain, "bucket").agg(
        F.bitmap_or_agg("entities").alias("entities"),
        *[F.sum(c).alias(c) for c in ("records", "judged", "passed", "measured")],
        F.kll_merge_agg_double("sketch").alias("sketch"),
    )


def read_kpis(state: DataFrame, grain: Sequence[str], quantile: float = 0.95) -> DataFrame:
    """KPIs of a state at its own or a coarser grain: exact counts and rate, and a quantile within ``RANK_ERROR`` of its rank."""
    per_bucket = merged(state, grain).withColumn("entities", F.when(F.col("bucket").isNotNull(), F.bitmap_count("entities")))
    whole = per_bucket.groupBy(*grain).agg(
        F.coalesce(F.sum("entities"), F.lit(0)).alias("entities"),
        *[F.sum(c).alias(c) for c in ("records", "judged", "passed", "measured")],
        F.kll_merge_agg_double("sketch").alias("sketch"),
    )
    at = F.when(F.col("measured") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(quantile)))
    return whole.select(*grain, "entities", "records", F.try_divide("passed", "judged").alias("pass_rate"), at.alias("quantile"))
