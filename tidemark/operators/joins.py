"""Join helpers: broadcast behind a size check, a salted shuffle-hash join, and one that treats heavy hitters apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64 * 1024 * 1024
SALT = "_salt"
# Keys that a sketch can name, and counters it keeps: any key with more than about 1/3000 of the rows is among them.
MOST_HEAVY, COUNTERS = 256, 4096


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a frame has few rows and few bytes as text; at most ``max_rows`` + 1 rows are looked at."""
    width = F.length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))).cast("long")
    n, size = df.limit(max_rows + 1).select(width.alias("w")).agg(F.count(F.lit(1)), F.coalesce(F.sum("w"), F.lit(0))).first()
    return n <= max_rows and size <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only after counting rows and bytes of a stored dimension.

    Beyond a limit the frame is joined by sort and merge: left to its estimates, Spark would still broadcast many rows
    that compress to a small file. Meant for stored tables, where the count is a cheap job; derived frames are left to AQE.
    """
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df.hint("merge")


def heavy_hitters(facts: DataFrame, on: Sequence[str], share: float = 0.001) -> list[int]:
    """Hashes of the join keys that hold at least ``share`` of the rows, from one pass of a frequent-items sketch.

    At most ``MOST_HEAVY`` numbers come back. The sketch may count a key too high, and two keys may share a hash: then one
    more key counts as heavy, which costs a little and changes no result.
    """
    if not 1 / MOST_HEAVY >= share >= 4 / 3 / COUNTERS:
        raise ValueError(f"share must lie between {4 / 3 / COUNTERS:.5f} and {1 / MOST_HEAVY:.5f}")
    named = facts.select(F.xxhash64(*on).alias("_name"))
    top, rows = named.agg(F.expr(f"approx_top_k(_name, {MOST_HEAVY}, {COUNTERS})"), F.count(F.lit(1))).first()
    return [item["item"] for item in top or [] if item["count"] >= share * rows]


def heavy_hitter_join(
    facts: DataFrame,
    dimension: DataFrame,
    on: Sequence[str],
    spread: Column,
    salts: int,
    share: float = 0.001,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Inner join whose heavy keys take a path of their own; rows of all other keys are shuffled once and copied nowhere.

    The dimension's rows of heavy keys are broadcast if they are small, so that the facts of those keys stay where they
    are. Else those facts are salted and only those dimension rows are repeated, once per salt. NULL keys match nothing.
    """
    heavy = heavy_hitters(facts, on, share)
    is_heavy = F.xxhash64(*on).isin(heavy) if heavy else F.lit(False)
    light = facts.filter(~is_heavy).join(dimension.filter(~is_heavy).hint("shuffle_hash"), list(on))
    if not heavy:
        return light
    few = dimension.filter(is_heavy)
    if is_small(few, max_rows, max_bytes):
        hot = facts.filter(is_heavy).join(F.broadcast(few), list(on))
    else:
        hot = salted_shuffle_hash_join(facts.filter(is_heavy), few, on, spread, salts)
    return light.unionByName(hot)


def salted_shuffle_hash_join(
    facts: DataFrame,
    dimension: DataFrame,
    on: Sequence[str],
    spread: Column,
    salts: int,
    partitions: int | None = None,
) -> DataFrame:
    """Inner shuffle-hash join in which every key is split over ``salts`` reducers.

    ``spread`` is any deterministic value that varies inside a key. The dimension is repeated once
    per salt, so it should be the much smaller side; no reducer gets more than 1/salts of a hot key.
    """
    keys = [*on, SALT]
    left = facts.withColumn(SALT, F.pmod(F.hash(spread), F.lit(salts)))
    right = dimension.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    if partitions:
        left = left.repartition(partitions, *keys)
    return left.join(right.hint("shuffle_hash"), keys).drop(SALT)


def aggregate_before_join(
    facts: DataFrame, dimension: DataFrame, on: Sequence[str], aggregates: Sequence[Column]
) -> DataFrame:
    """Collapse the facts to one row per join key, then join: only partial sums are shuffled.

    Same rows as join-then-group when the dimension has one row per key and its columns join the
    grouping, because every fact row of a key then carries the same dimension values.
    """
    return facts.groupBy(*on).agg(*aggregates).join(dimension, list(on))
