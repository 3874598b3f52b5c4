"""Lineage over contract edges: what a product depends on, directly or not, how far away, and where edges go in circles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.contracts import GateFailed
from tidemark.operators.joins import broadcast_if_small
from tidemark.session import workdir


def closure(edges: DataFrame, product: str, source: str, most_depth: int = 1000) -> DataFrame:
    """Every (product, ancestor, depth) that edges lead to, at the least depth.

    Rounds follow the newest pairs only: those of a source become those of its products. Each round's pairs are a stored
    table, so lineage stays short and lost executors cost one round. Pairs that were reached before are not looked for in
    every round, which would read all pairs each time, but when as many rows were added as there were at the last look:
    all looks together read about twice what there is, and a pair that is followed again meanwhile only repeats greater
    depths. Edges in circles end too; a node that reaches itself is its own ancestor. Edges with a NULL end lead nowhere.
    """
    spark = edges.sparkSession
    path = workdir(spark, "lineage")
    steps = edges.select(F.col(product).alias("_from"), F.col(source).alias("_to")).dropna().distinct()
    steps.write.parquet(f"{path}/edges")
    steps = spark.read.parquet(f"{path}/edges")
    on_steps = broadcast_if_small(steps)
    reached = steps.select(F.col("_from").alias("product"), F.col("_to").alias("ancestor"))
    looked_at = added = 0
    for depth in range(1, most_depth + 1):
        reached.withColumn("depth", F.lit(depth)).write.parquet(f"{path}/rounds/{depth}")
        newest = spark.read.parquet(f"{path}/rounds/{depth}")
        n = newest.count()
        pairs = spark.read.parquet(*[f"{path}/rounds/{d}" for d in range(1, depth + 1)])
        if not n:
            pairs.groupBy("product", "ancestor").agg(F.min("depth").alias("depth")).write.parquet(f"{path}/pairs")
            return spark.read.parquet(f"{path}/pairs")
        added += n
        further = newest.join(on_steps, F.col("product") == F.col("_to")).select(F.col("_from").alias("product"), "ancestor").distinct()
        # The last round holds nothing but new pairs, since pairs there are an error.
        if added >= looked_at or depth + 1 >= most_depth:
            looked_at, added = looked_at + added, 0
            further = further.join(pairs.select("product", "ancestor"), ["product", "ancestor"], "left_anti")
        reached = further
    raise GateFailed(f"lineage is deeper than {most_depth}")


def sources_of(pairs: DataFrame) -> DataFrame:
    """Per product: how many ancestors and sources (ancestors without ancestors) it has, its depth, whether it depends on itself."""
    roots = pairs.select("ancestor").distinct().join(pairs.select(F.col("product").alias("ancestor")).distinct(), "ancestor", "left_anti")
    marked = pairs.join(roots.withColumn("_root", F.lit(1)), "ancestor", "left")
    return marked.groupBy("product").agg(
        F.count(F.lit(1)).alias("ancestors"),
        F.count("_root").alias("sources"),
        F.max("depth").alias("depth"),
        F.bool_or(F.col("product") == F.col("ancestor")).alias("in_a_circle"),
    )
