"""One-to-one matching of detections and labels, and the scores that follow from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import saved


def near_pairs(detections: DataFrame, labels: DataFrame, cell: float, by_class: bool = True) -> DataFrame:
    """d, l and distance of detections (d, class, x, y) within the radius of labels (l, class, x, y, radius).

    They meet in cells: a label goes to every cell its circle can touch, a detection to its own, so no pair comes twice.
    cell should be about the usual radius. Rows without coordinates are in no pair.
    """
    at = lambda c: F.floor(c / F.lit(cell))
    span = lambda c: F.sequence(at(F.col(c) - F.col("radius")), at(F.col(c) + F.col("radius")))
    left = detections.where("x is not null and y is not null").select("d", F.col("class").alias("dc"), F.col("x").alias("dx"), F.col("y").alias("dy"), at(F.col("x")).alias("cx"), at(F.col("y")).alias("cy"))
    right = labels.where("x is not null and y is not null and radius >= 0").select("l", F.col("class").alias("lc"), "x", "y", "radius", F.explode(span("x")).alias("cx"), span("y").alias("cys")).withColumn("cy", F.explode("cys")).drop("cys")
    distance = F.sqrt((F.col("dx") - F.col("x")) * (F.col("dx") - F.col("x")) + (F.col("dy") - F.col("y")) * (F.col("dy") - F.col("y")))
    met = left.join(right, ["cx", "cy"]).withColumn("distance", distance).where("distance <= radius")
    return (met.where("dc = lc") if by_class else met).select("d", "l", "distance")


def one_to_one(pairs: DataFrame, most_rounds: int = 10_000) -> DataFrame:
    """The pairs that a walk by (distance, d, l) takes when each d and each l may be taken once.

    A pair that comes first for both of its ends is taken by that walk whatever else happens, so each round takes all
    of those at once, and drops every pair that shares an end with one. Rounds are written to the shared folder; their
    number is the length of the longest chain of pairs that wait for one another. Repeated pairs count once, a null id
    is in no pair.
    """
    key = lambda other: F.struct("distance", F.col(other).alias("o"))
    left = saved(pairs.where("d is not null and l is not null").groupBy("d", "l").agg(F.min("distance").alias("distance")))
    taken = None
    for _ in range(most_rounds):
        best_d = left.groupBy("d").agg(F.min(key("l")).alias("bd"))
        best_l = left.groupBy("l").agg(F.min(key("d")).alias("bl"))
        now = saved(left.join(best_d, "d").join(best_l, "l").where((F.col("bd.o") == F.col("l")) & (F.col("bl.o") == F.col("d"))).select("d", "l", "distance"))
        if now.isEmpty():
            return taken if taken is not None else now
        taken = now if taken is None else taken.unionByName(now)
        left = saved(left.join(now.select("d"), "d", "left_anti").join(now.select("l"), "l", "left_anti"))
    raise RuntimeError("the matching has not come to rest")


def _ranked(rows: DataFrame, name: str) -> DataFrame:
    """rows with group (the least id of equal rows) and k, the place by id among these, from 0."""
    equal = Window.partitionBy(*(c for c in rows.columns if c != name)).orderBy(name)
    return saved(rows.withColumns({"group": F.first(name).over(equal), "k": (F.row_number().over(equal) - 1).cast("long")}))


def matched(detections: DataFrame, labels: DataFrame, cell: float, by_class: bool = True, most_rounds: int = 10_000) -> DataFrame:
    """d, l and distance of the pairs that one_to_one takes of near_pairs, without a row for every pair.

    Detections that differ in nothing but d form a group, labels likewise. A walk takes a group's members by id, so pairs of
    groups and how many of each are gone say all. In a round two groups that come first for one another match as many
    members as both have left; where another group is as far away, only those before its next member. That takes at
    least what a round of one_to_one takes. Groups, and pairs of them, are as many as there are different rows. Ids
    that stand for several places are matched pair by pair.
    """
    d = detections.where("d is not null and x is not null and y is not null").select("d", "class", "x", "y").distinct()
    lab = labels.where("l is not null and x is not null and y is not null and radius >= 0").select("l", "class", "x", "y", "radius").distinct()
    members_d, members_l = _ranked(d, "d"), _ranked(lab, "l")
    if any(not m.groupBy(c).count().where("count > 1").isEmpty() for m, c in ((members_d, "d"), (members_l, "l"))):
        return one_to_one(near_pairs(detections, labels, cell, by_class), most_rounds)
    met = near_pairs(members_d.where("k = 0"), members_l.where("k = 0"), cell, by_class).select(F.col("d").alias("gd"), F.col("l").alias("gl"), "distance")
    members_d = members_d.select(F.col("group").alias("gd"), "k", "d")
    members_l = members_l.select(F.col("group").alias("gl"), "k", "l")
    size = lambda m, g, n: m.groupBy(g).agg(F.count(F.lit(1)).alias(n))
    none = F.lit(0).cast("long")
    left = saved(met.join(size(members_d, "gd", "nd"), "gd").join(size(members_l, "gl", "nl"), "gl").withColumns({"at_d": none, "at_l": none}))
    runs = left.select("gd", "gl", "distance", "at_d", "at_l", F.col("nd").alias("n")).where("false")
    for _ in range(most_rounds):
        if left.isEmpty():
            n = F.explode(F.sequence(none, F.col("n") - 1))
            each = runs.select("gd", "gl", "distance", "at_d", "at_l", n.alias("i"))
            each = each.join(members_d.withColumnRenamed("k", "kd"), (F.col("kd") == F.col("at_d") + F.col("i")) & (members_d["gd"] == each["gd"])).select(each["gl"], "distance", "at_l", "i", "d")
            return each.join(members_l.withColumnRenamed("k", "kl"), (F.col("kl") == F.col("at_l") + F.col("i")) & (members_l["gl"] == each["gl"])).select("d", "l", "distance")
        now = left.join(members_d.select("gd", F.col("k").alias("at_d"), "d"), ["gd", "at_d"]).join(members_l.select("gl", F.col("k").alias("at_l"), "l"), ["gl", "at_l"])
        of_d, of_l = Window.partitionBy("gd").orderBy("distance", "l"), Window.partitionBy("gl").orderBy("distance", "d")
        # The next member of the next group, if that is as far away.
        rival = lambda c, w: F.when(F.lead("distance").over(w) == F.col("distance"), F.lead(c).over(w))
        told = now.withColumns({"first_d": F.row_number().over(of_d), "until_l": rival("l", of_d)}).withColumns({"first_l": F.row_number().over(of_l), "until_d": rival("d", of_l)})
        first = saved(told.where("first_d = 1 and first_l = 1").drop("d", "l"))
        before = lambda m, c: first.where(f"until_{c} is not null").join(m, f"g{c}").where(F.col("k").between(F.col(f"at_{c}"), F.col(f"n{c}")) & (F.col(c) < F.col(f"until_{c}"))).groupBy(f"g{c}").agg(F.count(F.lit(1)).alias(f"most_{c}"))
        n = F.least(F.col("nd") - F.col("at_d"), F.col("nl") - F.col("at_l"), "most_d", "most_l")
        taken = saved(first.join(before(members_d, "d"), "gd", "left").join(before(members_l, "l"), "gl", "left").select("gd", "gl", "distance", "at_d", "at_l", n.alias("n")))
        runs = runs.unionByName(taken)
        gone = left.join(taken.select("gd", F.col("n").alias("gone_d")), "gd", "left").join(taken.select("gl", F.col("n").alias("gone_l")), "gl", "left")
        gone = gone.withColumns({"at_d": F.col("at_d") + F.coalesce("gone_d", none), "at_l": F.col("at_l") + F.coalesce("gone_l", none)})
        left = saved(gone.where("at_d < nd and at_l < nl").select(*left.columns))
    raise RuntimeError("the matching has not come to rest")


def scores(detections: DataFrame, labels: DataFrame, matched: DataFrame) -> DataFrame:
    """For each class its true_positive, false_positive and false_negative counts, and precision and recall.

    A share without a denominator is null.
    """
    d = detections.select("d", "class").join(matched.select("d", F.lit(1).alias("hit")), "d", "left")
    lab = labels.select("l", "class").join(matched.select("l", F.lit(1).alias("hit")), "l", "left")
    none = F.lit(0).cast("long")
    rows = d.select("class", F.coalesce("hit", F.lit(0)).cast("long").alias("tp"), F.when(F.col("hit").isNull(), 1).otherwise(0).cast("long").alias("fp"), none.alias("fn"))
    rows = rows.unionByName(lab.select("class", none.alias("tp"), none.alias("fp"), F.when(F.col("hit").isNull(), 1).otherwise(0).cast("long").alias("fn")))
    g = rows.groupBy("class").agg(F.sum("tp").alias("true_positive"), F.sum("fp").alias("false_positive"), F.sum("fn").alias("false_negative"))
    share = lambda c: F.try_divide(F.col("true_positive").cast("double"), (F.col("true_positive") + F.col(c)).cast("double"))
    return g.withColumns({"precision": share("false_positive"), "recall": share("false_negative")})


def box_overlaps(before: DataFrame, after: DataFrame, least: float, cell: float) -> DataFrame:
    """b, a and distance = 1 - overlap of boxes (id, x0, y0, x1, y1) that share at least this part of the smaller.

    Ready for one_to_one, which pairs the best overlap first. Boxes meet in the cells they cover; a pair is told where
    the lower left corner of the intersection lies, so it comes once.
    """
    at = lambda c: F.floor(F.col(c) / F.lit(cell))

    def dealt(df: DataFrame, p: str) -> DataFrame:
        s = df.select(*(F.col(c).alias(p + c) for c in ("id", "x0", "y0", "x1", "y1")))
        return s.withColumn("cx", F.explode(F.sequence(at(p + "x0"), at(p + "x1")))).withColumn("cy", F.explode(F.sequence(at(p + "y0"), at(p + "y1"))))

    lo = lambda c: F.greatest("b" + c, "a" + c)
    hi = lambda c: F.least("b" + c, "a" + c)
    size = lambda p: (F.col(p + "x1") - F.col(p + "x0")) * (F.col(p + "y1") - F.col(p + "y0"))
    met = dealt(before, "b").join(dealt(after, "a"), ["cx", "cy"])
    once = (F.floor(lo("x0") / F.lit(cell)) == F.col("cx")) & (F.floor(lo("y0") / F.lit(cell)) == F.col("cy"))
    w, h = hi("x1") - lo("x0"), hi("y1") - lo("y0")
    part: Column = F.try_divide(w * h, F.least(size("b"), size("a")))
    return met.where(once & (w >= 0) & (h >= 0)).withColumn("part", part).where(F.col("part") >= least).select(F.col("bid").alias("d"), F.col("aid").alias("l"), (1.0 - F.col("part")).alias("distance"))
