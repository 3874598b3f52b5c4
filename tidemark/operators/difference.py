"""Where two tables differ: digest trees that are compared from the root down, opening only what differs.

A tree is two stored tables. Leaves hold every distinct row's digest (32 bytes), its number of copies and its key, in the order
of the digests, so a reader that wants some prefixes skips most files and row groups by their statistics. Nodes hold, for each
prefix of 0, 3, 6 and 9 hexadecimal digits, the number of rows and sums over four parts of the digests, each as often as it
has copies. They add up from level to level and before every shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import canonical_json, digest
from tidemark.operators.content import FAN_HEX
from tidemark.operators.provenance import VOLATILE

TOP, PREFIX = "_top", "_prefix"
WIDTHS = (0, 3, 6, 9)
# Parts of a digest that are summed: three bytes each, behind those of the prefix, so that sums stay below 2^63 up to 5 * 10^11 rows.
PARTS, PART_BYTES, SKIPPED = 4, 3, 5


def write_tree(
    df: DataFrame, path: str, keys: Sequence[str], exclude: Sequence[str] = VOLATILE, text: Column | None = None
) -> None:
    """Store the digest tree of a table; ``keys`` tell which row a leaf is. Copies of a row are one leaf."""
    names = [c for c in df.columns if c not in exclude]
    hashed = df.select(*keys, F.unhex(digest(text if text is not None else canonical_json(names))).alias("h"))
    leaves = hashed.groupBy("h", *keys).agg(F.count(F.lit(1)).alias("n"))
    leaves = leaves.repartitionByRange("h").sortWithinPartitions("h").withColumn(TOP, F.substring(_prefix(), 1, FAN_HEX))
    leaves.write.mode("overwrite").parquet(f"{path}/leaves")
    # Rows in the order of their digests are added up to few nodes before they are shuffled.
    stored = df.sparkSession.read.parquet(f"{path}/leaves")
    part = [F.conv(F.hex(F.substring("h", SKIPPED + PART_BYTES * i + 1, PART_BYTES)), 16, 10).cast("long") for i in range(PARTS)]
    level = stored.select(_prefix(), "n", *[(p * F.col("n")).alias(f"s{i}") for i, p in enumerate(part)])
    for width in reversed(WIDTHS):
        nodes = level.groupBy(F.substring(PREFIX, 1, width).alias("prefix")).agg(F.sum("n").alias("n"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(PARTS)])
        nodes.write.mode("overwrite").parquet(f"{path}/nodes/width={width}")
        level = df.sparkSession.read.parquet(f"{path}/nodes/width={width}").drop("width").withColumnRenamed("prefix", PREFIX)


def _prefix() -> Column:
    return F.lower(F.substring(F.hex(F.substring("h", 1, SKIPPED)), 1, WIDTHS[-1])).alias(PREFIX)


def _nodes(spark: SparkSession, path: str, width: int) -> DataFrame:
    entry = F.struct("n", *[f"s{i}" for i in range(PARTS)]).alias("entry")
    return spark.read.parquet(f"{path}/nodes/width={width}").select("prefix", entry)


def differing_prefixes(spark: SparkSession, left: str, right: str) -> DataFrame:
    """Prefixes of the leaves that differ between two stored trees, found level by level from the root."""
    differing = None
    for width in WIDTHS:
        sides = [_nodes(spark, path, width) for path in (left, right)]
        if differing is not None:
            above = differing.select(F.col("prefix").alias("_above"))
            inside = F.substring("prefix", 1, width - FAN_HEX) == F.col("_above")
            sides = [side.join(above, inside, "left_semi") for side in sides]
        both = sides[0].withColumnRenamed("entry", "_left").join(sides[1].withColumnRenamed("entry", "_right"), "prefix", "full_outer")
        differing = both.filter(~F.col("_left").eqNullSafe(F.col("_right"))).select("prefix")
    return differing


def row_differences(spark: SparkSession, left: str, right: str, keys: Sequence[str]) -> DataFrame:
    """Per key of a row that only one tree has, or has in another number of copies: ``change`` and both numbers of rows.

    ``change`` is lost (the key has rows on the left only), added (on the right only) or changed. Equal trees are told
    by their roots. The first level's differing prefixes, 4,096 at most, go into the scans of the leaves as literals.
    """
    prefixes = differing_prefixes(spark, left, right)
    tops = [r[0] for r in prefixes.select(F.substring("prefix", 1, FAN_HEX).alias(TOP)).distinct().collect()]
    wanted = prefixes.select(F.col("prefix").alias("_wanted"))

    def leaves(path: str, side: str) -> DataFrame:
        kept = spark.read.parquet(f"{path}/leaves").filter(F.col(TOP).isin(tops))
        kept = kept.withColumn(PREFIX, _prefix()).join(wanted, F.col(PREFIX) == F.col("_wanted"), "left_semi")
        return kept.select(*[F.col(k).alias(f"_{side}_{k}") for k in keys], F.col("h").alias(f"_{side}_h"), F.col("n").alias(f"_{side}_n"))

    pairs = ("l", "r")
    same = [F.col("_l_h") == F.col("_r_h"), *[F.col(f"_l_{k}").eqNullSafe(F.col(f"_r_{k}")) for k in keys]]
    both = leaves(left, "l").join(leaves(right, "r"), same, "full_outer")
    counts = [F.coalesce(F.col(f"_{s}_n"), F.lit(0)) for s in pairs]
    named = [F.when(F.col("_l_h").isNull(), F.col(f"_r_{k}")).otherwise(F.col(f"_l_{k}")).alias(k) for k in keys]
    odd = both.filter(counts[0] != counts[1]).select(*named, counts[0].alias("left_rows"), counts[1].alias("right_rows"))
    per_key = odd.groupBy(*keys).agg(F.sum("left_rows").alias("left_rows"), F.sum("right_rows").alias("right_rows"))
    change = F.when(F.col("right_rows") == 0, "lost").when(F.col("left_rows") == 0, "added").otherwise("changed")
    return per_key.select(*keys, change.alias("change"), "left_rows", "right_rows")
