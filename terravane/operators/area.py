"""Area queries over layers: select, identify, search, summarise, page, and bind to grids.

A layer has id, lon, lat and properties as columns. Rows without a place, or without a readable time where a time is
asked for, are counted and not silently dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.texts import fold, time_key


def circle(lon: float, lat: float, metres: float) -> Column:
    """Within a radius; a box comparison comes first and can reach the scan."""
    import math

    dlat = math.degrees(metres / geo.EARTH_M) * 1.001
    dlon = dlat / max(0.01, math.cos(math.radians(min(89.0, abs(lat) + dlat))))
    box = geo.in_box(F.col("lon"), F.col("lat"), (lon - dlon, lat - dlat, lon + dlon, lat + dlat))
    return box & (geo.haversine(F.col("lon"), F.col("lat"), F.lit(lon), F.lit(lat)) <= metres)


def polygon(rings: Sequence[Sequence[tuple[float, float]]]) -> Column:
    """Inside rings (outer, then holes), boundary included, with the box of the outer ring first."""
    xs, ys = [p[0] for p in rings[0]], [p[1] for p in rings[0]]
    return geo.in_box(F.col("lon"), F.col("lat"), (min(xs), min(ys), max(xs), max(ys))) & geo.in_polygon(F.col("lon"), F.col("lat"), rings)


def box(bounds: Sequence[float]) -> Column:
    return geo.in_box(F.col("lon"), F.col("lat"), bounds)


def select(layer: DataFrame, area: Column, time_col: str | None = None, start: str | None = None, end: str | None = None, limit: int = 500) -> tuple[DataFrame, DataFrame]:
    """(rows, ledger): the first rows by id in the area and time, and one row with matched, returned and excluded."""
    placed = F.col("lon").isNotNull() & F.col("lat").isNotNull()
    timed = time_col is not None and (start or end)
    ok = F.lit(True)
    if timed:
        key = time_key(F.col(time_col).cast("string"))
        ok = (key >= time_key(F.lit(start)) if start else F.lit(True)) & (key <= time_key(F.lit(end), upper=True) if end else F.lit(True))
        ok = F.when(key.isNotNull(), ok)
    usable = placed & ok.isNotNull() if timed else placed
    hit = usable & F.coalesce(ok, F.lit(False)) & area
    ledger = layer.agg(F.count_if(hit).alias("matched"), F.count_if(~usable).alias("excluded"))
    ledger = ledger.select("matched", F.least("matched", F.lit(limit)).cast("long").alias("returned"), "excluded", (F.col("matched") > limit).alias("truncated"))
    return layer.where(hit).orderBy("id").limit(limit), ledger


def identify(layer: DataFrame, lon: float, lat: float, metres: float, limit: int = 10) -> DataFrame:
    """The nearest rows within a tolerance."""
    d = geo.haversine(F.col("lon"), F.col("lat"), F.lit(lon), F.lit(lat))
    return layer.where(circle(lon, lat, metres)).withColumn("distance_m", d).orderBy("distance_m", "id").limit(limit)


def search(layer: DataFrame, query: str, fields: list[str], limit: int = 20) -> DataFrame:
    """id, rank, field and value of rows whose fields match: 0 equal, 1 prefix, 2 prefix of a word, 3 inside."""
    needle = fold(F.lit(query))

    def best(i: int, name: str) -> Column:
        hay = fold(F.col(name))
        rank = F.when(hay == needle, 0).when(F.startswith(hay, needle), 1).when(F.contains(F.concat(F.lit(" "), hay), F.concat(F.lit(" "), needle)), 2).when(F.contains(hay, needle), 3)
        return F.when(rank.isNotNull(), F.struct(rank.alias("rank"), F.lit(i).alias("at"), F.lit(name).alias("field"), F.col(name).alias("value")))

    hits = [best(i, f) for i, f in enumerate(fields)]
    found = layer.select("id", (F.least(*hits) if len(hits) > 1 else hits[0]).alias("m")).where("m is not null")
    return found.select("id", "m.rank", "m.field", "m.value").orderBy("rank", "id").limit(limit)


def summarize(layer: DataFrame, fields: list[str]) -> DataFrame:
    """field, value, n; an empty or missing value counts as (missing)."""
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.coalesce(F.nullif(F.col(f).cast("string"), F.lit("")), F.lit("(missing)")).alias("value")) for f in fields)))
    return layer.select(each.alias("v")).groupBy("v.field", "v.value").agg(F.count(F.lit(1)).alias("n"))


def page(layer: DataFrame, after, size: int, key: str = "id") -> DataFrame:
    """The next rows after a key; what a cursor returns."""
    return (layer if after is None else layer.where(F.col(key) > after)).orderBy(key).limit(size)


def grid_cells(layer: DataFrame, west: float, north: float, step: float, rows: int, cols: int) -> DataFrame:
    """id, cell_id (R{row}_C{col}) by floor division from the north-west corner; null off the canvas."""
    r, c = F.floor((F.lit(north) - F.col("lat")) / step), F.floor((F.col("lon") - west) / step)
    on = r.between(0, rows - 1) & c.between(0, cols - 1)
    return layer.select("id", F.when(on, F.concat(F.lit("R"), r.cast("string"), F.lit("_C"), c.cast("string"))).alias("cell_id"))


def bind_exact(points: DataFrame, size: int, cols: int, rows: int, x0: int = 0, y0: int = 0) -> DataFrame:
    """id, col, row of every cell that a point (x, y as decimals) touches: one inside, two on an edge, four on a corner."""
    dx, dy = (F.col("x") - F.lit(x0)) / F.lit(size), (F.col("y") - F.lit(y0)) / F.lit(size)
    whole = lambda v: F.floor(v).cast("long")
    ends = lambda v: F.when(v == F.floor(v), F.array(whole(v) - 1, whole(v))).otherwise(F.array(whole(v)))
    each = points.select("id", F.explode(ends(dx)).alias("col"), ends(dy).alias("rs")).select("id", "col", F.explode("rs").alias("row"))
    return each.where((F.col("col") >= 0) & (F.col("col") < cols) & (F.col("row") >= 0) & (F.col("row") < rows))


def coarser(cells: DataFrame, factor: int) -> DataFrame:
    """The parent cells of cells (col, row), with how many of them each has."""
    return cells.groupBy(F.floor(F.col("col") / factor).alias("col"), F.floor(F.col("row") / factor).alias("row")).agg(F.count(F.lit(1)).alias("n_children"))


def neighbours(cells: DataFrame, cols: int, rows: int) -> DataFrame:
    """The up to eight cells around each cell (col, row) on the canvas."""
    steps = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1) if (i, j) != (0, 0))))
    n = cells.select("col", "row", steps.alias("s")).select("col", "row", (F.col("col") + F.col("s.i")).alias("n_col"), (F.col("row") + F.col("s.j")).alias("n_row"))
    return n.where((F.col("n_col") >= 0) & (F.col("n_col") < cols) & (F.col("n_row") >= 0) & (F.col("n_row") < rows))


def roll_up(layer: DataFrame, value: str, places: int = 2) -> DataFrame:
    """Rows and the sum of a value by coordinates rounded down to a number of decimals."""
    scale = 10**places
    at = lambda c: F.floor(F.col(c) * scale).cast("long")
    return layer.where("lon is not null and lat is not null").groupBy(at("lon").alias("lon_cell"), at("lat").alias("lat_cell")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(value).cast("decimal(28,2)")).cast("double").alias("total"))


def rank(rows: DataFrame, score: Column, key: str = "id", by: list[str] | None = None) -> DataFrame:
    """Rows with a rank by descending score within groups; ties by key."""
    w = Window.partitionBy(*(by or [])).orderBy(F.desc("rank_score"), key)
    return rows.withColumn("rank_score", score).withColumn("rank", F.row_number().over(w))


def nearest_vectors(vectors: DataFrame, query: list[float], k: int = 10) -> DataFrame:
    """The k vectors (vec_id, embedding) with the greatest cosine to a query, score rounded to four decimals."""
    q = F.array(*(F.lit(float(x)) for x in query))
    v = F.transform("embedding", lambda x: x.cast("double"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    cos = F.try_divide(dot(v, q), F.sqrt(dot(v, v)) * F.sqrt(dot(q, q)))
    return vectors.select("vec_id", F.round(cos, 4).alias("score")).orderBy(F.desc("score"), "vec_id").limit(k)
