"""Graph operators: components, chains, propagation, bounded paths, degrees and roots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import saved


def components(edges: DataFrame) -> DataFrame:
    """node and root, the least node it can reach, for every node of edges (u, v).

    Each round every node takes the least label among its own, its neighbours' and its label's label (pointer
    jumping), so rounds grow with the logarithm of a chain's length. Rounds are checkpointed to the shared folder.
    """
    both = saved(edges.select("u", "v").union(edges.select("v", "u")).distinct())
    now = saved(both.groupBy(F.col("u").alias("node")).agg(F.least(F.col("u"), F.min("v")).alias("root")))
    while True:
        near = both.join(now.select(F.col("node").alias("v"), F.col("root").alias("r")), "v").groupBy(F.col("u").alias("node")).agg(F.min("r").alias("r"))
        step = now.join(near, "node").select("node", F.least("root", "r").alias("root"), F.col("root").alias("old"))
        # A root that learns of a lesser one hands it to all that point to it.
        told = step.groupBy(F.col("old").alias("was")).agg(F.min("root").alias("best"))
        hooked = step.join(told, step["old"] == told["was"]).select("node", F.least("root", "best").alias("root"), "old")
        jump = hooked.select(F.col("node").alias("up"), F.col("root").alias("higher"))
        nxt = saved(hooked.join(jump, hooked["root"] == jump["up"], "left").select("node", F.least("root", F.coalesce("higher", "root")).alias("root"), "old"))
        if nxt.where("root <> old").isEmpty():
            return nxt.select("node", "root")
        now = nxt.select("node", "root")


def members(roots: DataFrame) -> DataFrame:
    """root and size of every component (node, root), with its members in order."""
    return roots.groupBy("root").agg(F.count(F.lit(1)).alias("n_nodes"), F.array_sort(F.collect_list("node")).alias("nodes"))


def chains(edges: DataFrame) -> DataFrame:
    """root and size of every component, with its members in order."""
    return members(components(edges))


def propagate(nodes: DataFrame, edges: DataFrame, decay: float = 0.5, rounds: int = 1) -> DataFrame:
    """Scores (id, score) passed along directed edges (u, v, weight): each round a node keeps the greater of its own
    score and decay * weight * its best neighbour's."""
    now = nodes
    for _ in range(rounds):
        got = edges.join(now.select(F.col("id").alias("u"), F.col("score").alias("s")), "u").groupBy(F.col("v").alias("id")).agg(F.max(F.col("s") * F.col("weight") * decay).alias("gain"))
        now = saved(now.join(got, "id", "left").select("id", F.greatest("score", F.coalesce("gain", F.lit(0.0))).alias("score")))
    return now


def simple_paths(edges: DataFrame, sources: DataFrame, targets: DataFrame, most: int = 6) -> DataFrame:
    """All paths (array of nodes) without a repeated node from sources (id) to targets (id), of at most `most` edges."""
    front = sources.select(F.array("id").alias("path"), F.col("id").alias("end"))
    out = None
    for _ in range(most):
        front = saved(front.join(edges.select(F.col("u").alias("end"), F.col("v").alias("next")), "end").where(~F.array_contains("path", F.col("next"))).select(F.concat("path", F.array("next")).alias("path"), F.col("next").alias("end")))
        done = front.join(targets.select(F.col("id").alias("end")), "end", "left_semi").select("path")
        out = done if out is None else out.unionByName(done)
        if front.isEmpty():
            break
    return out


def degrees(edges: DataFrame, repeated: bool = True) -> DataFrame:
    """node, out-degree and in-degree over distinct edges; repeated=False says that no edge comes twice, so that none has to be held."""
    both = edges.select("u", "v").distinct() if repeated else edges
    ends = both.select(F.col("u").alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i")).union(both.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("o").alias("n_out"), F.sum("i").alias("n_in"))


def cardinalities(edges: DataFrame) -> DataFrame:
    """left and its relation to the right side of a bipartite edge table (left, right): 1:1, 1:N, N:1 or N:N."""
    e = edges.select("left", "right").distinct()
    right = e.groupBy("right").agg(F.count(F.lit(1)).alias("n_left"))
    g = e.join(right, "right").groupBy("left").agg(F.count(F.lit(1)).alias("n_right"), F.max("n_left").alias("n_left"))
    kind = F.when((F.col("n_right") == 1) & (F.col("n_left") == 1), "1:1").when(F.col("n_left") == 1, "1:N").when(F.col("n_right") == 1, "N:1").otherwise("N:N")
    return g.select("left", kind.alias("cardinality"))


def orphans(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges that cite a node which does not exist, with the missing node; nodes has a column id."""
    ends = edges.select("edge_id", F.explode(F.array("u", "v")).alias("id"))
    return ends.join(nodes.select("id"), "id", "left_anti").select("edge_id", F.col("id").alias("missing")).distinct()
