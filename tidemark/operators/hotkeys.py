"""Which keys hold so many rows that they must not meet in one task."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NAME = "_name"


@dataclass(frozen=True)
class HotKeys:
    """A key is hot from ``rows`` rows on; fewer rows fit a task.

    At most all rows / ``rows`` keys can be hot, 10^5 of 10^11 rows, which bounds what is broadcast.
    Where rows have a unique position, one in ``one_in`` is counted instead of all. A hot key's timeline is
    cut into slices of about ``slice_rows`` rows.
    """

    rows: int = 1_000_000
    one_in: int = 1000
    slice_rows: int = 1_000_000


def name_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add a hash of the key. A collision makes one more key hot and decides nothing else."""
    return df.withColumn(NAME, F.xxhash64(*keys))


def hot_names(named: DataFrame, hot: HotKeys, position: Sequence[str] = ()) -> DataFrame:
    """The hot keys' hashes, ready to be broadcast.

    Counts and samples follow from the rows' values alone, so every evaluation finds the same keys.
    Only hashes and counts are shuffled, after a map-side count.
    """
    counted, enough = named, hot.rows
    if position:
        counted = named.filter(F.pmod(F.xxhash64(*position), F.lit(hot.one_in)) == 0)
        enough = max(1, hot.rows // hot.one_in)
    sizes = counted.groupBy(NAME).agg(F.count(F.lit(1)).alias("_rows"))
    return F.broadcast(sizes.filter(F.col("_rows") >= enough).select(NAME))
