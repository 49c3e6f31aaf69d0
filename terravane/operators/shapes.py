"""Joins of polygons with polygons by six predicates.

Pairs are found by the cells of their boxes. Both outlines of a pair are cut where they meet, and beside the middle of
each piece, a little to its left and right, one point is taken. Every part of the plane that the two outlines make has
such a piece on its border, so that the points tell whether the pair shares an area and whether one has an area of its
own. Points are tested by rays, against edges of the same band of latitude only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import saved
from . import copies

#: What is nearer than this, in the unit of the coordinates, counts as the same place.
NEAR = 1e-7
PREDICATES = ("intersects", "contains", "within", "touches", "crosses", "overlaps")
_EDGE = ["ax", "ay", "bx", "by"]


def _edges(df: DataFrame, name: str) -> DataFrame:
    real = " and ".join(f"{c} is not null" for c in ("polygon_id", *_EDGE))
    return df.where(f"{real} and (ax <> bx or ay <> by)").select(F.col("polygon_id").alias(name), *(F.col(c).cast("double").alias(c) for c in _EDGE)).distinct()


def _cells(x0: Column, y0: Column, x1: Column, y1: Column, cell: float) -> Column:
    span = lambda a, b: F.sequence(F.floor((a - NEAR) / cell), F.floor((b + NEAR) / cell))
    return F.explode(F.flatten(F.transform(span(x0, x1), lambda x: F.transform(span(y0, y1), lambda y: F.struct(x.alias("cx"), y.alias("cy"))))))


def _boxes(edges: DataFrame, name: str, tag: str, cell: float) -> DataFrame:
    b = edges.groupBy(name).agg(F.min(F.least("ax", "bx")).alias(f"x0{tag}"), F.min(F.least("ay", "by")).alias(f"y0{tag}"), F.max(F.greatest("ax", "bx")).alias(f"x1{tag}"), F.max(F.greatest("ay", "by")).alias(f"y1{tag}"))
    return b.select("*", _cells(*(F.col(c + tag) for c in ("x0", "y0", "x1", "y1")), cell).alias("c")).select(*b.columns, "c.*")


def _pairs(a: DataFrame, b: DataFrame, cell: float) -> DataFrame:
    """Pairs whose boxes meet, each in the one cell where the overlap of the boxes begins."""
    met = _boxes(a, "id", "", cell).join(_boxes(b, "other_id", "_b", cell), ["cx", "cy"])
    meets = f"x0 <= x1_b + {NEAR} and x0_b <= x1 + {NEAR} and y0 <= y1_b + {NEAR} and y0_b <= y1 + {NEAR}"
    # Boxes that only come near may begin in a cell that one of them does not reach; the lesser end is taken for those.
    begin = lambda c: F.floor(F.least(F.greatest(f"{c}0", f"{c}0_b"), f"{c}1", f"{c}1_b") / cell)
    return met.where(meets).where((begin("x") == F.col("cx")) & (begin("y") == F.col("cy"))).select("id", "other_id")


def _cuts(a: DataFrame, b: DataFrame, cell: float) -> DataFrame:
    """id, other_id, side, edge and where (0 to 1) an edge of one outline meets the other outline."""
    spread = lambda df: df.select("*", _cells(F.least("ax", "bx"), F.least("ay", "by"), F.greatest("ax", "bx"), F.greatest("ay", "by"), cell).alias("c")).select(*df.columns, "c.*")
    p, q = spread(a), spread(b).withColumnsRenamed({"ax": "px", "ay": "py", "bx": "qx", "by": "qy"})
    met = p.join(q, ["cx", "cy"]).drop("cx", "cy").distinct()
    ex, ey, fx, fy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay"), F.col("qx") - F.col("px"), F.col("qy") - F.col("py")
    long_a, long_b = F.sqrt(ex * ex + ey * ey), F.sqrt(fx * fx + fy * fy)
    turn = ex * fy - ey * fx
    along = lambda x, y: ((F.col(x) - F.col("ax")) * ex + (F.col(y) - F.col("ay")) * ey) / (long_a * long_a)
    along_b = lambda x, y: ((F.col(x) - F.col("px")) * fx + (F.col(y) - F.col("py")) * fy) / (long_b * long_b)
    off = lambda x, y: F.abs((F.col(x) - F.col("ax")) * ey - (F.col(y) - F.col("ay")) * ex) / long_a <= NEAR
    off_b = lambda x, y: F.abs((F.col(x) - F.col("px")) * fy - (F.col(y) - F.col("py")) * fx) / long_b <= NEAR
    dx, dy = F.col("px") - F.col("ax"), F.col("py") - F.col("ay")
    skew = F.abs(turn) > 1e-12 * long_a * long_b
    t, u = F.try_divide(dx * fy - dy * fx, turn), F.try_divide(dx * ey - dy * ex, turn)
    within = lambda v, long: v.between(-NEAR / long, NEAR / long + 1)
    crossing = skew & within(t, long_a) & within(u, long_b)
    # Ends of one edge on the other: where edges lie on a line, or touch at a flat angle.
    on_a = [F.when(off(x, y) & within(along(x, y), long_a), along(x, y)) for x, y in (("px", "py"), ("qx", "qy"))]
    on_b = [F.when(off_b(x, y) & within(along_b(x, y), long_b), along_b(x, y)) for x, y in (("ax", "ay"), ("bx", "by"))]
    at_a, at_b = F.array_compact(F.array(F.when(crossing, t), *on_a)), F.array_compact(F.array(F.when(crossing, u), *on_b))
    found = met.select("id", "other_id", *_EDGE, "px", "py", "qx", "qy", at_a.alias("at_a"), at_b.alias("at_b")).where("size(at_a) + size(at_b) > 0")
    one = found.select("id", "other_id", F.lit(0).alias("side"), *_EDGE, F.explode_outer("at_a").alias("at"))
    two = found.select("id", "other_id", F.lit(1).alias("side"), *(F.col(c).alias(n) for c, n in zip(("px", "py", "qx", "qy"), _EDGE, strict=True)), F.explode_outer("at_b").alias("at"))
    return one.unionByName(two)


def _relations(a: DataFrame, b: DataFrame, cell: float) -> DataFrame:
    pairs = saved(_pairs(a, b, cell))
    cuts = saved(_cuts(a, b, cell).join(pairs, ["id", "other_id"], "left_semi"))
    sided = lambda df, key, side: pairs.join(df, key).select("id", "other_id", F.lit(side).alias("side"), *_EDGE)
    outlines = saved(sided(a, "id", 0).unionByName(sided(b, "other_id", 1)))
    key = ["id", "other_id", "side", *_EDGE]
    every = outlines.withColumn("at", F.lit(None).cast("double")).unionByName(cuts.select(*key, "at"))
    whole = every.groupBy(*key).agg(F.collect_set("at").alias("ats"))
    ends = F.array_sort(F.array_union(F.transform("ats", lambda v: F.least(F.greatest(v, F.lit(0.0)), F.lit(1.0))), F.array(F.lit(0.0), F.lit(1.0))))
    pieces = whole.select(*key, ends.alias("e")).select(*key, F.explode(F.zip_with(F.slice("e", 1, F.size("e") - 1), F.slice("e", 2, F.size("e") - 1), lambda s, t: F.struct(((s + t) / 2).alias("m"), (t - s).alias("w")))).alias("p"))
    ex, ey = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    long = F.sqrt(ex * ex + ey * ey)
    x, y = F.col("ax") + F.col("p.m") * ex, F.col("ay") + F.col("p.m") * ey
    beside = F.explode(F.array(*(F.struct((x - s * NEAR * ey / long).alias("x"), (y + s * NEAR * ex / long).alias("y")) for s in (1, -1))))
    tested = pieces.where(F.col("p.w") * long > 4 * NEAR).select("id", "other_id", beside.alias("t")).select("id", "other_id", "t.x", "t.y").distinct()
    # Rays go to the right; only edges that reach the band of the point's latitude can be hit.
    bands = outlines.select("*", F.explode(F.sequence(F.floor(F.least("ay", "by") / cell), F.floor(F.greatest("ay", "by") / cell))).alias("band"))
    met = tested.withColumn("band", F.floor(F.col("y") / cell)).join(bands, ["id", "other_id", "band"])
    hit = ((F.col("ay") > F.col("y")) != (F.col("by") > F.col("y"))) & (F.col("x") < F.col("ax") + F.try_divide((F.col("y") - F.col("ay")) * (F.col("bx") - F.col("ax")), F.col("by") - F.col("ay")))
    inside = met.groupBy("id", "other_id", "x", "y").agg(*((F.count_if(hit & (F.col("side") == s)) % 2 == 1).alias(n) for s, n in ((0, "i"), (1, "j"))))
    areas = inside.groupBy("id", "other_id").agg(F.bool_or(F.expr("i and j")).alias("both"), F.bool_or(F.expr("i and not j")).alias("left_only"), F.bool_or(F.expr("j and not i")).alias("right_only"))
    meet = cuts.select("id", "other_id").distinct().withColumn("meet", F.lit(True))
    r = areas.join(meet, ["id", "other_id"], "left").where("both or meet")
    return r.select("id", "other_id", F.lit(True).alias("intersects"), F.expr("both and not right_only").alias("contains"), F.expr("both and not left_only").alias("within"), F.expr("not both").alias("touches"), F.lit(False).alias("crosses"), F.expr("both and left_only and right_only").alias("overlaps"))


def relations(left: DataFrame, right: DataFrame, cell: float = 0.25) -> DataFrame:
    """id, other_id and the six predicates as booleans for all pairs of polygons that share a point.

    left and right have polygon_id, ax, ay, bx, by: a row for each edge of closed rings, holes and several parts
    included (see `joins.boxes_as_edges`). contains and within hold both for equal polygons; crosses is never true
    between areas. cell should be about the size of a usual polygon: an edge goes to every cell of its box. Rows with
    nulls, edges without length and repeated rows count as absent; other columns are ignored. Parts thinner than about
    2e-7 are not seen. Equal outlines are compared once.
    """
    a, b = _edges(left, "id"), _edges(right, "other_id")
    one, same = copies.one_of_each(a, "id", saved(copies.outlines(a, "id", _EDGE)))
    two, same_b = copies.one_of_each(b, "other_id", saved(copies.outlines(b, "other_id", _EDGE)))
    pairs = saved(_relations(one, two, cell).withColumnsRenamed({"id": "a", "other_id": "b"}))
    return copies.spelled_pairs(pairs, same.withColumnRenamed("stands", "a"), same_b.withColumnRenamed("stands", "b"), "a", "b").select("id", "other_id", *PREDICATES)


def joined(left: DataFrame, right: DataFrame, predicate: str = "intersects", cell: float = 0.25) -> DataFrame:
    """id and other_id of all pairs for which one of PREDICATES holds; another name raises ValueError."""
    if predicate not in PREDICATES:
        raise ValueError(f"unsupported predicate: {predicate!r} (one of {', '.join(PREDICATES)})")
    return relations(left, right, cell).where(predicate).select("id", "other_id")
