"""Connected components by alternating stars; links stay distributed and are written each round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


# Links of a file, unless that gives fewer files than twice the cores.
FILE_LINKS = 100_000


def _in_few_files(links: DataFrame, rows: int) -> DataFrame:
    """Rounds write small tables again and again: not a file for each shuffle partition, which holds a few links then."""
    return links.coalesce(max(2 * links.sparkSession.sparkContext.defaultParallelism, rows // FILE_LINKS))


def _star(links: DataFrame, smaller: bool) -> DataFrame:
    """Tie every node's neighbours to its smallest neighbour: the larger ones, or itself and the smaller ones.

    A hub's links are joined with one row per node, so a hot node is a skewed join that Spark can split.
    """
    both = links if smaller else links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select(F.col("a").alias("n"), F.least("m", "a").alias("m"))
    tied = both.join(least, F.col("a") == F.col("n"))
    if smaller:
        out = tied.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select(F.col("n").alias("a"), F.col("m").alias("b")))
    else:
        out = tied.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.filter(F.col("a") > F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, root of every node in ``links`` (columns a, b): root is the smallest reachable node.

    Loops and repeated links don't matter; no links give no rows. The state checked between rounds is
    two numbers.
    """
    a, b = links.columns
    pairs = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter(F.col("a") > F.col("b"))
    pairs = stored(pairs.distinct(), "links")
    rows, seen = pairs.count(), None
    while True:
        pairs = stored(_in_few_files(_star(_star(pairs, smaller=False), smaller=True), rows), "links")
        state = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                _in_few_files(pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct(), state[0])
            )
        rows, seen = state[0], tuple(state)
