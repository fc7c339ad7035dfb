"""Connected components of an edge table, by rounds of joins and folds."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accessgrid.llm.common import drop_table, written


def _to_smallest(edges: DataFrame, larger_only: bool) -> DataFrame:
    """One star round: every node's neighbours move to the smallest node among them and itself.

    With larger_only the node's larger neighbours move (large star), else its smaller ones and the
    node itself (small star).  The smallest is folded before the shuffle, so a node with most of the
    edges is one row by then; the join back may be split by the optimizer.
    """
    if larger_only:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    met = both.join(least, "u")
    if larger_only:
        return met.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
    moved = met.select(F.col("v").alias("u"), F.col("low").alias("v")).union(least.select("u", F.col("low").alias("v")))
    return moved.filter(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): each node of the edges (u, v) with the smallest node of its component.

    Large and small stars take turns until nothing moves; the rounds grow with the logarithm of the
    longest path.  Each round is a table in the shared folder, so lineage stays short.  Null ends and
    loops are no edges.
    """
    now = written(edges.select("u", "v").filter(F.col("u") != F.col("v")).distinct())
    before = None
    while True:
        after = written(_to_smallest(_to_smallest(now, True), False))
        state = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        drop_table(now)
        now = after
        if state == before:
            break
        before = state
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
