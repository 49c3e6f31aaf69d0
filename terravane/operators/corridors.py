"""Corridor candidates: nodes gathered around seeds, as a walk in order would gather them, without the walk.

In the walk each node in order that no earlier seed has taken becomes a seed and takes all later free nodes within
the gap. So a node is a seed when no earlier seed lies within the gap, and every other node belongs to the earliest
seed within it. A node decides as soon as no earlier undecided node within the gap is left. Nodes meet in cells so
small that two nodes of one cell always lie within the gap: in each only the earliest undecided node can become a seed,
so it alone looks around, into the 24 cells within reach, and work stays in proportion to the nodes however dense they lie.

Rounds are as many as the longest chain of seeds that wait for one another: few for nodes in random order, as many
as there are seeds for nodes in order along a line. Every round is written to the shared folder.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..sources.tables import saved


def _reach(x: Column, y: Column) -> Column:
    near = [(i, j) for i in range(-2, 3) for j in range(-2, 3) if abs(i) + abs(j) < 4]
    return F.explode(F.array(*(F.struct((x + i).alias("cx"), (y + j).alias("cy")) for i, j in near)))


def seeds(nodes: DataFrame, gap: float) -> DataFrame:
    """node and seed for each of nodes (node, x, y; distinct, in the order of node); a seed is its own.

    Nodes without a place are seeds of their own.
    """
    if gap <= 0:
        raise ValueError("the gap has to be positive")
    cell = gap / math.sqrt(2.0) * (1 - 1e-9)
    placed = nodes.where("x is not null and y is not null").select("node", "x", "y", F.floor(F.col("x") / cell).alias("cx"), F.floor(F.col("y") / cell).alias("cy"))
    left, chosen = saved(placed), None
    while not left.isEmpty():
        first = left.groupBy("cx", "cy").agg(F.min(F.struct("node", "x", "y")).alias("f")).select("cx", "cy", F.col("f.node").alias("cand"), F.col("f.x").alias("fx"), F.col("f.y").alias("fy"))
        around = first.select("cand", "fx", "fy", _reach(F.col("cx"), F.col("cy")).alias("c")).select("cand", "fx", "fy", "c.*")
        near = geo.planar(F.col("x"), F.col("y"), F.col("fx"), F.col("fy")) <= gap
        waits = around.join(left, ["cx", "cy"]).where((F.col("node") < F.col("cand")) & near).select("cand").distinct()
        fresh = saved(first.join(waits, "cand", "left_anti"))
        chosen = fresh if chosen is None else saved(chosen.unionByName(fresh))
        spread = fresh.select("fx", "fy", _reach(F.col("cx"), F.col("cy")).alias("c")).select("fx", "fy", "c.*")
        taken = left.join(spread, ["cx", "cy"]).where(near).select("node").distinct()
        left = saved(left.join(taken, "node", "left_anti"))
    alone = nodes.where("x is null or y is null").select("node", F.col("node").alias("seed"))
    if chosen is None:
        return alone
    spread = chosen.select("cand", "fx", "fy", _reach(F.col("cx"), F.col("cy")).alias("c")).select("cand", "fx", "fy", "c.*")
    near = geo.planar(F.col("x"), F.col("y"), F.col("fx"), F.col("fy")) <= gap
    own = placed.join(spread, ["cx", "cy"]).where(near).groupBy("node").agg(F.min("cand").alias("seed"))
    return own.unionByName(alone)


def candidates(nodes: DataFrame, gap: float = 0.01, least: int = 2) -> DataFrame:
    """seed, n_nodes, centre and mean and greatest score and risk of each group of at least `least` of nodes (node, x, y, score, risk)."""
    zero = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    g = nodes.join(seeds(nodes, gap), "node").groupBy("seed").agg(
        F.count(F.lit(1)).alias("n_nodes"), F.round(F.avg("x"), 6).alias("centre_x"), F.round(F.avg("y"), 6).alias("centre_y"),
        F.round(F.avg(zero("score")), 4).alias("mean_score"), F.round(F.max(zero("score")), 4).alias("max_score"), F.round(F.avg(zero("risk")), 2).alias("mean_risk"), F.round(F.max(zero("risk")), 2).alias("max_risk"),
    )
    return g.where(F.col("n_nodes") >= least)
