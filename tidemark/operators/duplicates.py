"""Duplicate marking without a hot window group.

``row_number`` over a key puts every copy of a record into one task. Two exact plans avoid that:

* with a row position, an aggregate with map-side combine finds the keys that occur more than once and
  each one's smallest position; rows are compared with it by a left join. Only keys and positions are
  shuffled for the aggregate. Where few keys repeat, adaptive execution can broadcast them and the wide
  rows stay in place; else the join shuffles, and its skew handling splits the rows of a hot key, which
  meet a single row;
* without one, two ``row_number`` passes: first inside (key, input slice), then over the slice
  winners, while losers are spread.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def mark_duplicates(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    flag: str = "_is_duplicate",
    position: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``flag``: TRUE on every row of a key but the first in ``order_by``.

    Rows with a NULL key are never compared. ``position`` names columns that tell any two rows of a
    key apart; without it full ties are settled by an arbitrary single winner.
    """
    if position:
        return _by_first(df, list(keys), list(order_by), list(position), flag)
    return _by_two_ranks(df, list(keys), list(order_by), flag)


def _has_key(keys: Sequence[str]) -> Column:
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    return present


def _by_first(df: DataFrame, keys: list[str], order: list[str], position: list[str], flag: str) -> DataFrame:
    place = F.struct(*order, *position)
    firsts = df.filter(_has_key(keys)).groupBy(*keys).agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_copies"))
    repeated = firsts.filter("_copies > 1").drop("_copies")
    late = F.col("_first").isNotNull() & (place != F.col("_first"))
    return df.join(repeated, keys, "left").withColumn(flag, late).select(*df.columns, flag)


def _by_two_ranks(df: DataFrame, keys: list[str], order: list[str], flag: str) -> DataFrame:
    # Salt by input partition: copies from different tasks meet only as winners, one per task.
    salted = df.withColumn("_salt", F.spark_partition_id())
    # NULL keys would share one group; the key's own absence spreads them by content.
    scatter = F.when(~_has_key(keys), F.xxhash64(*df.columns))
    salted = salted.withColumn("_scatter", scatter)
    inner = Window.partitionBy(*keys, "_scatter", "_salt").orderBy(*order)
    ranked = salted.withColumn("_inner", F.row_number().over(inner)).withColumn(
        "_lost", F.when(F.col("_inner") > 1, F.col("_salt"))
    )
    outer = Window.partitionBy(*keys, "_scatter", "_lost").orderBy(*order)
    late = (F.col("_inner") > 1) | (F.row_number().over(outer) > 1)
    return ranked.withColumn(flag, _has_key(keys) & late).select(*df.columns, flag)


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """One row per key, the smallest by ``order_by``: an aggregate, so copies collapse before the shuffle."""
    others = [c for c in df.columns if c not in keys]
    ordering = F.struct(*order_by)
    best = F.min_by(F.struct(*others), ordering).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*").select(*df.columns)


def keep_last(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """One row per key, the largest by ``order_by``."""
    others = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*others), F.struct(*order_by)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*").select(*df.columns)
