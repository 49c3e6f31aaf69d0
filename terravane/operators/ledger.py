"""Ledgers of lineage and of relationships: faults of a lineage, its levels, and the best state of a path.

A record with one parent finds its root by pointer jumping, in as many rounds as the logarithm of the longest chain. With
several parents levels are peeled one by one, so rounds are as many as the longest chain. What neither way reaches lies
on a cycle or behind one. Paths are never listed: a state travels along the edges, and only states that none seen
before at the same place is as good as go on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import saved

# States of a derived geometry and the states that its children may have.
DERIVATIONS = {
    "SOURCE_NATIVE": ("FULL", "CANONICALIZED_FULL", "SIMPLIFIED", "DELIVERY_MINIMIZED", "MVT"),
    "FULL": ("FULL", "CANONICALIZED_FULL", "SIMPLIFIED", "DELIVERY_MINIMIZED", "MVT"),
    "CANONICALIZED_FULL": ("FULL", "CANONICALIZED_FULL", "SIMPLIFIED", "DELIVERY_MINIMIZED", "MVT"),
    "SIMPLIFIED": ("SIMPLIFIED", "DELIVERY_MINIMIZED", "MVT"),
    "DELIVERY_MINIMIZED": ("SIMPLIFIED", "DELIVERY_MINIMIZED", "MVT"),
    "MVT": ("MVT",),
}


def ancestry(records: DataFrame) -> DataFrame:
    """id, root and depth of each record of records (id, parent; distinct ids); both are null on a cycle and behind one.

    A parent that is not among the records ends a chain as if there were none. A lost executor costs one round.
    """
    known = records.select(F.col("id").alias("parent"))
    linked = records.select("id", "parent").join(known, "parent", "left_semi").select("id", F.col("parent").alias("up"), F.lit(1).cast("long").alias("depth"))
    roots = records.select("id").join(linked, "id", "left_anti").select("id", F.lit(None).cast(dict(records.dtypes)["id"]).alias("up"), F.lit(0).cast("long").alias("depth"))
    # up is an ancestor `depth` steps away; at a root it stays. `done` says that up is a root.
    now = saved(roots.select("id", F.col("id").alias("up"), "depth", F.lit(True).alias("done")).unionByName(linked.withColumn("done", F.lit(False))))
    left = now.where("not done").count()
    steps = 1
    while left and steps <= 2 * left:
        far = now.select(F.col("id").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("more"), F.col("done").alias("done2"))
        open_rows = now.where("not done").join(far, "up").select("id", F.col("up2").alias("up"), (F.col("depth") + F.col("more")).alias("depth"), F.col("done2").alias("done"))
        now = saved(now.where("done").unionByName(open_rows))
        steps *= 2
        still = now.where("not done").count()
        # Every chain of open rows that ends does so within twice the rows that were open at the start.
        if not still:
            break
    return now.select("id", F.when(F.col("done"), F.col("up")).alias("root"), F.when(F.col("done"), F.col("depth")).alias("depth"))


def lineage_faults(records: DataFrame) -> DataFrame:
    """id, fault and other for every fault of a lineage of geometries (id, parent, state, origin); no row if it is sound.

    A record may have several faults; each is named once. Repeated ids are faults of their own, and of those the least
    (parent, state, origin) stands for the id in what follows. Cycles name every record on them or behind them.
    """
    blank = lambda c: F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == ""
    fault = lambda df, name, other=None: df.select("id", F.lit(name).alias("fault"), (F.lit(None) if other is None else F.col(other)).cast("string").alias("other"))
    named = records.where(~blank("id"))
    rows = named.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("parent", "state", "origin")).alias("r")).select("id", "n", "r.*")
    rows = saved(rows.withColumn("has", ~blank("parent")))
    known = F.col("state").isin(*DERIVATIONS)
    native = F.col("state") == "SOURCE_NATIVE"
    out = [
        fault(records.where(blank("id")), "EMPTY_ID"),
        fault(rows.where("n > 1"), "DUPLICATE_ID"),
        fault(rows.where(F.col("state") == "UNRESOLVED"), "UNRESOLVED_LINEAGE"),
        fault(rows.where(~F.coalesce(known | (F.col("state") == "UNRESOLVED"), F.lit(False))), "INVALID_STATE", "state"),
        fault(rows.where(native & F.col("has")), "SOURCE_NATIVE_HAS_PARENT", "parent"),
        fault(rows.where(known & ~native & ~F.col("has")), "MISSING_PARENT"),
        fault(rows.where(known & ~F.coalesce(F.col("origin") == F.when(native, "SOURCE_NATIVE").otherwise("DERIVED"), F.lit(False))), "ORIGIN_CONFLICT", "origin"),
        fault(rows.where(F.col("has") & (F.col("parent") == F.col("id"))), "SELF_EDGE"),
    ]
    linked = rows.where(F.col("has") & (F.col("parent") != F.col("id"))).select("id", "parent", "state")
    above = rows.select(F.col("id").alias("parent"), F.col("state").alias("above"))
    met = saved(linked.join(above.withColumn("there", F.lit(True)), "parent", "left"))
    out.append(fault(met.where("there is null"), "PARENT_NOT_FOUND", "parent"))
    allowed = F.coalesce(*(F.when(F.col("above") == k, F.col("state").isin(*v)) for k, v in DERIVATIONS.items()))
    bad = met.where(known & ~F.coalesce(allowed, F.lit(True)))
    out.append(fault(bad.where(F.col("above") == "MVT"), "MVT_AUTHORITY_REVERSAL", "parent"))
    out.append(fault(bad.where(F.col("above") != "MVT"), "LOSSY_AUTHORITY_REVERSAL", "parent"))
    lost = ancestry(rows.select("id", F.when(F.col("has") & (F.col("parent") != F.col("id")), F.col("parent")).alias("parent"))).where("depth is null")
    out.append(fault(lost, "LINEAGE_CYCLE"))
    every = out[0]
    for df in out[1:]:
        every = every.unionByName(df)
    return every.distinct()


def levels(nodes: DataFrame, parents: DataFrame) -> DataFrame:
    """id and level of each of nodes (id), given parents (id, parent), several to a node.

    Level 0 has no parent; any other is one more than the greatest of its parents'. Null on a cycle and behind one, and
    where a parent is not among the nodes or lies behind such a one. Each round takes off one level.
    """
    links = saved(parents.select("id", "parent").where("parent is not null").distinct().join(nodes.select("id").distinct().hint("merge"), "id", "left_semi"))
    waits = saved(links.groupBy("id").agg(F.count(F.lit(1)).alias("n")))
    done = front = saved(nodes.select("id").distinct().join(waits.hint("merge"), "id", "left_anti").withColumn("level", F.lit(0).cast("long")))
    k = 0
    while not front.isEmpty():
        k += 1
        # Merged by sorting: small fronts would all be broadcast, round by round, through the driver.
        off = links.join(front.select(F.col("id").alias("parent")).hint("merge"), "parent").groupBy("id").agg(F.count(F.lit(1)).alias("gone"))
        waits = saved(waits.join(off.hint("merge"), "id", "left").select("id", (F.col("n") - F.coalesce("gone", F.lit(0))).alias("n")))
        front = saved(waits.where("n = 0").select("id", F.lit(k).cast("long").alias("level")))
        waits = waits.where("n > 0")
        done = done.unionByName(front)
        done = saved(done) if k % 20 == 0 else done
    return nodes.select("id").distinct().join(done.hint("merge"), "id", "left")


# States of a path from the best to the worst, and the class of an edge that makes a path no better.
PATH_STATES = ("VERIFIED", "MIXED_KINDS", "HYPOTHETICAL", "UNRESOLVED", "CONTRADICTED")
_EDGE_STATES = {"VERIFIED": 0, "HYPOTHESIZED": 2, "CONTEXT": 2, "UNRESOLVED": 3, "CONTRADICTED": 4}


def _meet(rank: Column, kind: Column, rank2: Column, kind2: Column) -> tuple[Column, Column]:
    """State and kind of a path of this state that goes on over an edge of that one; only verified paths have a kind."""
    worst = F.greatest(rank, rank2)
    differ = (worst == 0) & kind.isNotNull() & kind2.isNotNull() & (kind != kind2)
    merged = F.when(differ, F.lit(1)).otherwise(worst)
    return merged, F.when(merged == 0, F.coalesce(kind, kind2))


def path_states(pairs: DataFrame, edges: DataFrame, most_hops: int = 6) -> DataFrame:
    """pairs (start, goal) with state, the best one of all paths of at most most_hops edges, NO_PATH without any.

    edges have u, v, class (VERIFIED, HYPOTHESIZED, CONTEXT, UNRESOLVED or CONTRADICTED; another one counts as
    HYPOTHESIZED) and kind, null where a verified edge joins two names of one feature. They lead both ways. A path of
    verified edges of several kinds is MIXED_KINDS. A path never comes back to where it was, so that from a place to
    itself there is none; elsewhere that changes nothing, since a detour makes no path better.
    """
    if most_hops < 1:
        raise ValueError("a path has at least one edge")
    rank = F.coalesce(*(F.when(F.col("class") == k, v) for k, v in _EDGE_STATES.items()), F.lit(2))
    one = edges.where("u is not null and v is not null and u <> v").select("u", "v", rank.alias("rank2"), F.when(rank == 0, F.col("kind")).alias("kind2"))
    both = saved(one.unionByName(one.select(F.col("v").alias("u"), F.col("u").alias("v"), "rank2", "kind2")).distinct())
    here = pairs.select("start").where("start is not null").distinct()
    front = here.select("start", F.col("start").alias("at"), F.lit(0).alias("rank"), F.lit(None).cast(dict(edges.dtypes)["kind"]).alias("kind"))
    seen = None
    for _ in range(most_hops):
        state, kind = _meet(F.col("rank"), F.col("kind"), F.col("rank2"), F.col("kind2"))
        moved = front.join(both, front["at"] == both["u"]).where("v <> start").select("start", F.col("v").alias("at"), state.alias("rank"), kind.alias("kind")).distinct()
        fresh = moved if seen is None else moved.unionByName(seen)
        # Of what is known of a place only the best goes on: a verified path without a kind beats all, one with a kind
        # all of lesser states; verified paths of different kinds stand side by side.
        best = fresh.groupBy("start", "at").agg(F.min("rank").alias("top"), F.bool_or((F.col("rank") == 0) & F.col("kind").isNull()).alias("plain"))
        fresh = fresh.join(best, ["start", "at"]).where((F.col("rank") == F.col("top")) & (~F.col("plain") | F.col("kind").isNull())).select("start", "at", "rank", "kind").distinct()
        after = saved(fresh)
        front = after if seen is None else saved(after.exceptAll(seen))
        seen = after
        if front.isEmpty():
            break
    found = seen.groupBy("start", F.col("at").alias("goal")).agg(F.min("rank").alias("rank"))
    name = F.coalesce(*(F.when(F.col("rank") == k, s) for k, s in enumerate(PATH_STATES)), F.lit("NO_PATH"))
    return pairs.join(found, ["start", "goal"], "left").withColumn("state", name).drop("rank")


def path_state(edges: DataFrame, key: str = "path") -> DataFrame:
    """The state of each given path: edges (path, class, kind) in any order; with n_edges, n_weak (not verified) and kind."""
    rank = F.coalesce(*(F.when(F.col("class") == k, v) for k, v in _EDGE_STATES.items()), F.lit(2))
    g = edges.groupBy(key).agg(F.count(F.lit(1)).alias("n_edges"), F.count_if(rank > 0).alias("n_weak"), F.max(rank).alias("rank"), F.min("kind").alias("low"), F.max("kind").alias("high"))
    mixed = (F.col("rank") == 0) & F.coalesce(F.col("low") != F.col("high"), F.lit(False))
    state = F.when(mixed, "MIXED_KINDS").otherwise(F.coalesce(*(F.when(F.col("rank") == k, s) for k, s in enumerate(PATH_STATES))))
    return g.select(key, state.alias("state"), F.when((F.col("rank") == 0) & ~mixed, F.col("low")).alias("kind"), "n_edges", "n_weak")
