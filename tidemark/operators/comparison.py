"""Equivalent plans for a skewed join, and their timed comparison."""

from __future__ import annotations

import statistics
import time
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.content import fingerprint
from tidemark.operators.hotkeys import HotKeys
from tidemark.operators.joins import aggregate_before_join, broadcast_if_small, salted_shuffle_hash_join
from tidemark.operators.selection import nearest_rank

DIMENSION = ("product_line", "distribution_class")
MEASURES = ("record_count", "measure_units_total", "first_reporting_date", "last_reporting_date")


def _measures() -> list:
    return [
        F.count("record_id").alias("record_count"),
        F.sum("measure_units").alias("measure_units_total"),
        F.min("reporting_date").alias("first_reporting_date"),
        F.max("reporting_date").alias("last_reporting_date"),
    ]


def skewed_join_plans(
    facts: DataFrame, dimension: DataFrame, salts: int = 64, partitions: int | None = 64
) -> dict[str, DataFrame]:
    """Three plans with equal results: shuffle hash, broadcast, and aggregation before the join."""
    grouping = ("join_key", *DIMENSION)
    shuffled = salted_shuffle_hash_join(facts, dimension, ["join_key"], F.col("record_id"), salts, partitions)
    broadcasted = facts.join(broadcast_if_small(dimension), "join_key")
    early = aggregate_before_join(facts, dimension, ["join_key"], _measures())
    return {
        "shuffle_hash": shuffled.groupBy(*grouping).agg(*_measures()),
        "broadcast": broadcasted.groupBy(*grouping).agg(*_measures()),
        "aggregate_first": early.select(*grouping, *MEASURES),
    }


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the length of a block, restored afterwards."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


STATIC_PLANS = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}


def compare_plans(
    spark: SparkSession,
    plans: Mapping[str, Callable[[], DataFrame]],
    baseline: str,
    iterations: int = 3,
    static: bool = True,
) -> dict[str, object]:
    """Run each plan ``iterations`` times after a warm-up, interleaved, and compare.

    Timing writes to the no-op sink, so whole results are computed and nothing reaches the driver.
    Results are compared by fingerprint, every column included.
    """
    if iterations < 3:
        raise ValueError("at least three executions per plan are needed for a median")
    seconds: dict[str, list[float]] = {name: [] for name in plans}
    prints, shapes = set(), {}
    with settings(spark, STATIC_PLANS if static else {}):
        for name, plan in plans.items():
            query = plan()
            prints.add(tuple(fingerprint(query, exclude=()).first()))
            shapes[name] = plan_shape(query)
        for _ in range(iterations):
            for name, plan in plans.items():
                query = plan()
                started = time.perf_counter()
                query.write.format("noop").mode("overwrite").save()
                seconds[name].append(round(time.perf_counter() - started, 6))
    medians = {name: statistics.median(runs) for name, runs in seconds.items()}
    base = medians[baseline]
    return {
        "runs": seconds,
        "median_seconds": medians,
        "change_percent": {n: round((m - base) / base * 100.0, 3) for n, m in medians.items() if n != baseline},
        "join_strategy": shapes,
        "results_match": len(prints) == 1,
    }


def plan_shape(query: DataFrame) -> str:
    """BROADCAST or SHUFFLE from the physical plan, where the runtime shows it."""
    try:
        text = query._jdf.queryExecution().executedPlan().toString()
    except Exception:  # Spark Connect has no JVM handle
        return "NOT_EXPOSED"
    return "BROADCAST" if "BroadcastHashJoin" in text else "SHUFFLE"


def duration_statistics(metrics: DataFrame, group: str, duration: str, hot: HotKeys | None = None) -> DataFrame:
    """Maximum and nearest-rank 75th percentile of durations per group, both exact."""
    longest = metrics.groupBy(group).agg(F.max(duration).alias("maximum_duration"))
    ranked = nearest_rank(metrics, group, duration, 0.75, hot).select(F.col(group).alias("_group"), F.col(duration).alias("p75_duration"))
    return longest.join(ranked, F.col(group).eqNullSafe(F.col("_group")), "left").drop("_group")


def run_medians(runs: DataFrame, mode: str, seconds: str) -> DataFrame:
    """Median wall time per mode, and the upper of the two middle runs as charts show it.

    Exact; meant for run receipts, a handful of rows per mode.
    """
    ordered = F.sort_array(F.collect_list(seconds))
    return runs.groupBy(mode).agg(
        F.median(seconds).alias("median_seconds"),
        F.element_at(ordered, F.floor(F.count(seconds) / 2).cast("int") + 1).alias("upper_middle_seconds"),
    )
