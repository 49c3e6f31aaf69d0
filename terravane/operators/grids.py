"""Exact shares of lines and polygons in the cells of a square grid, sets of cells, and scores of groups and sites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Measures up to this are none. It lies above what sums of signed areas lose by cancelling at coordinates of 1e6.
EPSILON = 1e-6


def _cells_between(lo: Column, hi: Column, size: float, last: int) -> Column:
    """Indices of the closed cells that meet a closed interval, within 0 to last; an end on an edge meets both cells."""
    a = F.greatest(F.lit(0), (F.ceil(lo / size) - 1).cast("long"))
    b = F.least(F.lit(last), F.floor(hi / size).cast("long"))
    return F.when(a <= b, F.sequence(a, b)).otherwise(F.array().cast("array<bigint>"))


def _span(p: str, d: str, cell: str, size: float) -> tuple[Column, Column]:
    """The part of a segment p + t d, t from 0 to 1, that lies over a cell; the whole if it doesn't move there."""
    ta, tb = (F.col(cell) * size - F.col(p)) / F.col(d), ((F.col(cell) + 1) * size - F.col(p)) / F.col(d)
    still = F.col(d) == 0
    return F.when(still, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(ta, tb))), F.when(still, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(ta, tb)))


def lines_in_cells(segments: DataFrame, size: float, cols: int, rows: int, key: str = "line_id") -> DataFrame:
    """key, col, row and length of what lines have in each cell, from their segments (key, x1, y1, x2, y2).

    What runs on an edge belongs to the cells on both sides. Lengths up to EPSILON, null coordinates and what lies off
    the grid are left out. A segment is cut by rows first and by columns then, so its work is that of the cells it meets.
    """
    s = segments.select(key, "x1", "y1", (F.col("x2") - F.col("x1")).alias("dx"), (F.col("y2") - F.col("y1")).alias("dy")).where("x1 is not null and y1 is not null and dx is not null and dy is not null")
    y2 = F.col("y1") + F.col("dy")
    s = s.withColumn("row", F.explode(_cells_between(F.least("y1", y2), F.greatest("y1", y2), size, rows - 1)))
    lo, hi = _span("y1", "dy", "row", size)
    s = s.withColumns({"lo": lo, "hi": hi}).where("lo <= hi")
    xa, xb = F.col("x1") + F.col("lo") * F.col("dx"), F.col("x1") + F.col("hi") * F.col("dx")
    s = s.withColumn("col", F.explode(_cells_between(F.least(xa, xb), F.greatest(xa, xb), size, cols - 1)))
    lo, hi = _span("x1", "dx", "col", size)
    part = F.greatest(F.lit(0.0), F.least(F.col("hi"), hi) - F.greatest(F.col("lo"), lo))
    length = part * F.sqrt(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy"))
    return s.select(key, "col", "row", length.alias("length")).groupBy(key, "col", "row").agg(F.sum("length").alias("length")).where(F.col("length") > EPSILON)


def polygons_in_cells(edges: DataFrame, size: float, cols: int, rows: int, key: str = "polygon_id") -> DataFrame:
    """key, col, row, area and share of the cell for polygons given as edges (key, ring, x1, y1, x2, y2); ring 0 is outer.

    The area that a ring has in a cell is the sum, over its edges, of the signed area between the cell's lower side and
    the edge, clamped to the cell. So edges need neither clipping nor collecting: each is cut by columns, tells every row
    from the ring's lowest to its own, and the sums are ordinary aggregates. Orders of rings don't matter; holes count less.
    """
    e = edges.where("x1 is not null and y1 is not null and x2 is not null and y2 is not null and x1 <> x2")
    low = edges.groupBy(key, "ring").agg(F.min(F.least("y1", "y2")).alias("low"))
    e = e.join(low, [key, "ring"]).withColumn("col", F.explode(_cells_between(F.least("x1", "x2"), F.greatest("x1", "x2"), size, cols - 1)))
    grade = (F.col("y2") - F.col("y1")) / (F.col("x2") - F.col("x1"))
    clip = lambda x: F.least(F.greatest(x, F.col("col") * size), (F.col("col") + 1) * size)
    e = e.withColumns({"xa": clip(F.col("x1")), "xb": clip(F.col("x2")), "grade": grade})
    e = e.where("xa <> xb").withColumns({"ya": F.col("y1") + (F.col("xa") - F.col("x1")) * F.col("grade"), "yb": F.col("y1") + (F.col("xb") - F.col("x1")) * F.col("grade")})
    e = e.withColumn("row", F.explode(_cells_between(F.col("low"), F.greatest("ya", "yb"), size, rows - 1)))
    above = lambda y: F.greatest(F.lit(0.0), F.least(F.lit(float(size)), F.col(y) - F.col("row") * size))
    beyond = lambda y: F.greatest(F.lit(0.0), F.col(y) - (F.col("row") + 1) * size)
    swept = lambda y: above(y) * above(y) / 2.0 + size * beyond(y)
    mean = F.when(F.abs(F.col("yb") - F.col("ya")) < 1e-9, above("ya")).otherwise((swept("yb") - swept("ya")) / (F.col("yb") - F.col("ya")))
    rings = e.withColumn("part", (F.col("xb") - F.col("xa")) * mean).groupBy(key, "ring", "col", "row").agg(F.abs(F.sum("part")).alias("area"))
    total = rings.groupBy(key, "col", "row").agg(F.sum(F.when(F.col("ring") == 0, F.col("area")).otherwise(-F.col("area"))).alias("area"))
    return total.where(F.col("area") > EPSILON).withColumn("share", F.col("area") / float(size * size))


def edge_of_set(cells: DataFrame, key: str = "set_id") -> DataFrame:
    """The distinct cells (key, row, col) with interior: whether their four neighbours are in the same set."""
    own = cells.select(key, "row", "col").distinct()
    steps = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in ((0, 0), (1, 0), (-1, 0), (0, 1), (0, -1))))
    told = own.withColumn("s", F.explode(steps)).select(key, (F.col("row") + F.col("s.i")).alias("row"), (F.col("col") + F.col("s.j")).alias("col"), ((F.col("s.i") == 0) & (F.col("s.j") == 0)).alias("own"))
    return told.groupBy(key, "row", "col").agg(F.bool_or("own").alias("own"), F.count(F.lit(1)).alias("n")).where("own").select(key, "row", "col", (F.col("n") == 5).alias("interior"))


def widen_set(cells: DataFrame, by_rows: int, by_cols: int, rows: int, cols: int, key: str = "set_id") -> DataFrame:
    """The distinct cells within so many rows and columns of a set's cells, on the grid."""
    near = lambda c, by, n: F.sequence(F.greatest(F.lit(0), F.col(c) - by), F.least(F.lit(n - 1), F.col(c) + by))
    inside = cells.where(F.col("row").between(0, rows - 1) & F.col("col").between(0, cols - 1))
    return inside.select(key, F.explode(near("row", by_rows, rows)).alias("row"), near("col", by_cols, cols).alias("cs")).select(key, "row", F.explode("cs").alias("col")).distinct()


# What the best tier of a group adds to its score.
TIER_POINTS = {"T1": 15, "T2": 10, "T3": 5, "T4": 1}


def group_scores(nodes: DataFrame, key: str = "cluster") -> DataFrame:
    """Coherence of each group of nodes (key, role, domain, function, tier, contradictions), 0 to 100.

    Size, roles, domains and functions add up to 25, 30, 18 and 12, the best tier up to 15; each of at most three
    contradictions takes 10. Lone nodes stay below 30, groups of one role or domain below 70, those without a good tier
    below 85. Empty texts are no values.
    """
    # Sets go through one shuffle with the other figures; several counts of distinct values would send each row once for every one.
    kinds = lambda c: F.size(F.collect_set(F.nullif(F.col(c), F.lit("")))).cast("long")
    points = F.coalesce(*(F.when(F.col("tier") == t, v) for t, v in TIER_POINTS.items()), F.lit(0))
    g = nodes.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), kinds("role").alias("n_roles"), kinds("domain").alias("n_domains"), kinds("function").alias("n_functions"), F.max(points).alias("best"),
        F.sum(F.coalesce("contradictions", F.lit(0))).alias("against"), F.bool_or(F.coalesce(F.col("tier").isin("T1", "T2"), F.lit(False))).alias("good"),
    )
    up = lambda c, top, each: F.least(F.col(c), F.lit(top)) * each
    raw = up("n", 5, 5.0) + up("n_roles", 4, 7.5) + up("n_domains", 3, 6.0) + up("n_functions", 3, 4.0) + F.col("best") - up("against", 3, 10.0)
    one = F.when(F.col("n") < 2, F.least(raw, F.lit(29.0))).otherwise(raw)
    two = F.when((one > 70) & ((F.col("n_roles") < 2) | (F.col("n_domains") < 2)), 69.0).otherwise(one)
    three = F.when((two > 85) & ~F.col("good"), 84.0).otherwise(two)
    return g.select(key, "n", "n_roles", "n_domains", "n_functions", F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.round(three, 2))).alias("score"))


def site_confidence(observations: DataFrame, rules: DataFrame) -> DataFrame:
    """site, score and class from confirmed factors of observations (site, factor, status), by rules (factor, delta).

    Every site comes back; one without a confirmed factor of the rules has 0. Repeated factors count each time.
    """
    j = observations.select("site", F.trim("factor").alias("factor"), F.trim("status").alias("status")).join(rules.select("factor", "delta"), "factor", "left")
    g = j.groupBy("site").agg(F.coalesce(F.sum(F.when(F.col("status") == "confirmed", F.col("delta"))), F.lit(0)).cast("long").alias("score"))
    s = F.col("score")
    return g.withColumn("class", F.when(s <= 3, "low-interest / likely ordinary").when(s <= 7, "monitor / contextual infrastructure").when(s <= 11, "high-interest utility node").otherwise("anomalous infrastructure candidate requiring deeper validation"))


def nearby_report(events: DataFrame, features: DataFrame, limit: int = 10) -> DataFrame:
    """The features with most events: name, n_events and mean_distance of events (feature_id, distance)."""
    g = events.join(features.select("feature_id", "name"), "feature_id").groupBy("name").agg(F.count(F.lit(1)).alias("n_events"), F.avg("distance").alias("mean_distance"))
    return g.orderBy(F.desc("n_events"), "name").limit(limit)


def tile_bounds(x: Column, y: Column, zoom: int) -> dict[str, Column]:
    """west, south, east and north of a web map tile in degrees."""
    n = float(1 << zoom)
    lat = lambda r: F.degrees(F.atan(F.sinh(F.pi() * (1.0 - 2.0 * r / n))))
    return {"west": x / n * 360.0 - 180.0, "south": lat(y + 1), "east": (x + 1) / n * 360.0 - 180.0, "north": lat(y)}
