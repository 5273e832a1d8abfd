"""Connected components of links between 64-bit nodes, as a distributed union-find."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.operators.sizing import shared_dir


def _stars(near: DataFrame, small: bool) -> DataFrame:
    """One step: every node's neighbours (the larger ones, or the smaller ones) move to its smallest neighbour.

    The smallest neighbour is a plain minimum, combined before the shuffle, and
    comes back by a join, so a node with very many neighbours is split like any
    skewed join key.
    """
    if small:
        near = near.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    else:
        near = near.union(near.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = near.groupBy("a").agg(F.least("a", F.min("b")).alias("low"))
    joined = near.join(low, "a")
    moved = joined.select(F.col("b").alias("a"), F.col("low").alias("b"))
    if small:
        moved = moved.union(low.select("a", F.col("low").alias("b")))
    else:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        moved = moved.union(low.select("a", F.col("low").alias("b")))
    return moved.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` of every node that has a link; ``root`` is the smallest node of its component.

    ``links`` has two BIGINT columns ``a``, ``b``; repeats, loops and nulls are
    ignored. Large-star and small-star steps alternate until every link points
    to a root: the union-find forest, flattened in parallel. Each round is
    checkpointed in the shared folder. No links give no rows.
    """
    shared_dir(links.sparkSession)
    forest = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    forest = forest.where("a <> b").distinct().checkpoint()
    while True:
        forest = _stars(_stars(forest, small=False), small=True).checkpoint()
        inner = forest.select("a").join(forest.select(F.col("b").alias("a")), "a", "left_semi")
        several = forest.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a")
        if inner.union(several).isEmpty():
            break
    nodes = forest.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(forest.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
