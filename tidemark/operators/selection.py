"""Cutting ordered values into ranges of about equal numbers, and picking the value at a rank without sorting them all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.hotkeys import NAME, HotKeys, hot_names, name_rows

CUTS = "_cuts"
# Sampled values per range: a range's size is off by about a quarter of itself, twice that at times.
SAMPLED = 16
# Up to 2^21 cuts of one key are searched: with a million rows a range, 2 * 10^12 rows of one key.
LARGEST_SEARCH = 20


def quantile_cuts(named: DataFrame, keys: Sequence[str], order: Sequence[str], hot: HotKeys) -> DataFrame:
    """One row per hot key: its hash and the values (structs of ``order``) at which its ranges start, the first left out.

    A sample by hash is the quantile sketch. It follows from the values alone and holds each once, so copies and the
    order of the input don't move a cut, and every evaluation finds the same ones. Per key about
    rows / slice_rows * SAMPLED values meet in one task, and rows / slice_rows are kept.
    """
    names = hot_names(named, hot)
    one_in = max(1, hot.slice_rows // SAMPLED)
    step = max(1, hot.slice_rows // one_in)
    drawn = named.filter(F.pmod(F.xxhash64(*keys, *order), F.lit(one_in)) == 0)
    values = drawn.join(names, NAME).select(NAME, F.struct(*order).alias("_at")).distinct()
    sampled = values.groupBy(NAME).agg(F.sort_array(F.collect_list("_at")).alias("_all"))
    last = F.floor((F.size("_all") - 1) / step).cast("int")
    every = F.transform(F.sequence(F.lit(1), last), lambda i: F.element_at("_all", i * step + 1))
    sampled = sampled.select(NAME, F.when(last > 0, every).otherwise(F.slice("_all", 1, 0)).alias(CUTS))
    return names.join(sampled, NAME, "left")


def range_of(order: Sequence[str]) -> Column:
    """How many of a row's cuts are not after it: binary search by falling powers of two. Without cuts 0."""
    value, cuts = F.struct(*order), F.col(CUTS)

    def step(low: Column, power: Column) -> Column:
        further = low + power
        return F.when((further <= F.size(cuts)) & (F.get(cuts, further - 1) <= value), further).otherwise(low)

    powers = F.array(*[F.lit(1 << p) for p in range(LARGEST_SEARCH, -1, -1)])
    return F.when(F.col(CUTS).isNotNull(), F.aggregate(powers, F.lit(0), step)).otherwise(F.lit(0))


def nearest_rank(df: DataFrame, group: str, value: str, quantile: float, hot: HotKeys | None = None) -> DataFrame:
    """Per group the value at rank ceil(quantile * n), exact; a group without values is left out.

    Rows are counted per group and range; running counts over the ranges tell which one holds the rank, and only that
    one's values are opened, counted and summed up. No task gets a group's values: at most a group's ranges, and the
    different values of one range, about ``slice_rows``. Values without an order (NULL, NaN) are not ranked.
    """
    hot = hot or HotKeys()
    kept = df.select(F.col(group).alias("_group"), F.col(value).alias("_value")).filter(F.col("_value").isNotNull())
    if df.schema[value].dataType.simpleString() in ("float", "double"):
        kept = kept.filter(~F.isnan("_value"))
    named = name_rows(kept, ["_group"])
    cuts = quantile_cuts(named, ["_group"], ["_value"], hot)
    placed = named.join(F.broadcast(cuts), NAME, "left").select("_group", "_value", range_of(["_value"]).alias("_range"))
    ranges = placed.groupBy("_group", "_range").agg(F.count(F.lit(1)).alias("_n"))
    along = Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = ranges.withColumn("_upto", F.sum("_n").over(along)).withColumn("_all", F.sum("_n").over(Window.partitionBy("_group")))
    # The quantile as a decimal: ceil of a product of doubles may be one too many.
    rank = F.greatest(F.ceil(F.lit(str(quantile)).cast("decimal(18,15)") * F.col("_all").cast("decimal(20,0)")).cast("long"), F.lit(1).cast("long"))
    counted = counted.withColumn("_rank", rank)
    holds = (F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_n") < F.col("_rank"))
    wanted = counted.filter(holds).select(
        F.col("_group").alias("_g"), F.col("_range").alias("_r"), (F.col("_rank") - F.col("_upto") + F.col("_n")).alias("_inner")
    )
    opened = placed.join(wanted, F.col("_group").eqNullSafe(F.col("_g")) & (F.col("_range") == F.col("_r")))
    values = opened.groupBy("_group", "_value", "_inner").agg(F.count(F.lit(1)).alias("_n"))
    inside = Window.partitionBy("_group").orderBy("_value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = values.withColumn("_upto", F.sum("_n").over(inside))
    here = (F.col("_upto") >= F.col("_inner")) & (F.col("_upto") - F.col("_n") < F.col("_inner"))
    return summed.filter(here).select(F.col("_group").alias(group), F.col("_value").alias(value))
