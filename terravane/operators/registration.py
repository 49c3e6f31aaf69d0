"""Fits of images to the ground from control points, many images at a time, and heights on a common datum.

A fit is a handful of sums: the normal equations of each image come from one grouped aggregation, and are solved as
column expressions. Trimmed refits and the search for a consensus repeat that over all images at once; points never leave
the executors, and an image with very many points is summed like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from ..sources.tables import saved

_XY = ("sx", "sy", "n", "sxx", "sxy", "syy")


def affine(points: DataFrame, key: str = "image") -> DataFrame:
    """key, n and the coefficients ax, bx, cx, ay, by, cy of lon = ax * px + bx * py + cx and lat likewise, by least squares.

    points: key, px, py, lon, lat; rows with a null count as absent. Coefficients are null where fewer than three points or points on
    one line leave the fit open.
    """
    p = points.where("px is not null and py is not null and lon is not null and lat is not null")
    mean = p.groupBy(key).agg(F.count(F.lit(1)).alias("n"), *(F.avg(c).alias(f"m_{c}") for c in ("px", "py", "lon", "lat")))
    # Centred sums keep their digits; the means come from a pass of their own, a row an image.
    d = lambda c: F.col(c) - F.col(f"m_{c}")
    c = p.join(mean, key)
    s = c.groupBy(key).agg(*(F.first(x).alias(x) for x in ("n", "m_px", "m_py", "m_lon", "m_lat")), *(F.sum(d(a) * d(b)).alias(f"{a}_{b}") for a, b in (("px", "px"), ("px", "py"), ("py", "py"), ("px", "lon"), ("py", "lon"), ("px", "lat"), ("py", "lat"))))
    det = F.col("px_px") * F.col("py_py") - F.col("px_py") * F.col("px_py")
    sound = (F.col("n") >= 3) & (det > 1e-12 * F.col("px_px") * F.col("py_py")) & (F.col("px_px") > 0) & (F.col("py_py") > 0)
    out = [key, "n"]
    for t in ("lon", "lat"):
        a = (F.col(f"px_{t}") * F.col("py_py") - F.col(f"py_{t}") * F.col("px_py")) / det
        b = (F.col(f"py_{t}") * F.col("px_px") - F.col(f"px_{t}") * F.col("px_py")) / det
        x = "x" if t == "lon" else "y"
        out += [F.when(sound, a).alias(f"a{x}"), F.when(sound, b).alias(f"b{x}"), F.when(sound, F.col(f"m_{t}") - a * F.col("m_px") - b * F.col("m_py")).alias(f"c{x}")]
    return s.select(*out)


def residuals(points: DataFrame, fits: DataFrame, key: str = "image") -> DataFrame:
    """points with fit_lon, fit_lat and error_m under their image's fit; null where there is none."""
    f = fits.select(key, "ax", "bx", "cx", "ay", "by", "cy")
    j = points.join(f, key, "left")
    at = lambda x: F.col(f"a{x}") * F.col("px") + F.col(f"b{x}") * F.col("py") + F.col(f"c{x}")
    j = j.withColumns({"fit_lon": at("x"), "fit_lat": at("y")})
    known = F.col("fit_lon").isNotNull() & F.col("fit_lat").isNotNull() & F.col("lon").isNotNull() & F.col("lat").isNotNull()
    return j.withColumn("error_m", F.when(known, geo.haversine(F.col("lon"), F.col("lat"), F.col("fit_lon"), F.col("fit_lat")))).drop("ax", "bx", "cx", "ay", "by", "cy")


def registered(points: DataFrame, least_points: int = 3, most_rmse: float = 25.0, most_error: float = 50.0, key: str = "image") -> DataFrame:
    """Each image's fit with rmse_m, max_error_m and whether it is certified: enough points and both errors within bounds."""
    fits = saved(affine(points, key))
    e = residuals(points, fits, key).groupBy(key).agg(F.sqrt(F.avg(F.col("error_m") * F.col("error_m"))).alias("rmse_m"), F.max("error_m").alias("max_error_m"))
    ok = (F.col("n") >= least_points) & (F.col("rmse_m") <= most_rmse) & (F.col("max_error_m") <= most_error)
    return fits.join(e, key).withColumn("certified", F.coalesce(ok, F.lit(False)))


def trimmed(points: DataFrame, keep: float = 0.85, rounds: int = 5, key: str = "image", id_col: str = "label") -> tuple[DataFrame, DataFrame]:
    """Fits over the share `keep` of each image's points that fit best, refitted `rounds` times; and the points that were kept.

    Ties go by id_col. At least three points stay. All images move on together.
    """
    if not 0 < keep <= 1:
        raise ValueError("the kept share lies between 0 and 1")
    kept = points
    for _ in range(rounds):
        fits = affine(kept, key)
        order = Window.partitionBy(key).orderBy(F.asc_nulls_last("error_m"), id_col)
        all_of = Window.partitionBy(key)
        ranked = residuals(points, fits, key).withColumns({"__k": F.row_number().over(order), "__n": F.count("error_m").over(all_of)})
        kept = saved(ranked.where(F.col("__k") <= F.greatest(F.lit(3), F.floor(F.col("__n") * F.lit(keep) + 1e-9))).select(*points.columns))
    return affine(kept, key), kept


def consensus(points: DataFrame, within_m: float, tries: int = 50, seed: int = 7, key: str = "image", id_col: str = "label") -> tuple[DataFrame, DataFrame]:
    """Fits over the points that agree with the best of `tries` seeded triples of each image; and those points.

    A try takes the three points with the least hashes of (seed, try, id); the fit with most points within `within_m`
    metres wins, then the one with the least sum of squares, then the first. Images without a sound triple have no fit.
    The triples are a bounded sample; every point is held against every one of them.
    """
    p = points.where("px is not null and py is not null and lon is not null and lat is not null")
    every = p.select("*", F.explode(F.sequence(F.lit(0), F.lit(tries - 1))).alias("__try"))
    luck = F.xxhash64(F.lit(seed), F.col("__try"), F.col(id_col).cast("string"))
    order = Window.partitionBy(key, "__try").orderBy(luck, id_col)
    # Spark keeps only the first ranks of each task before it shuffles.
    triples = every.withColumn("__k", F.row_number().over(order)).where("__k <= 3").drop("__k")
    both = F.concat_ws("\u0000", F.col(key).cast("string"), F.col("__try").cast("string"))
    fits = saved(affine(triples.withColumn("__both", both), "__both").where("ax is not null"))
    of = triples.select(key, "__try", both.alias("__both")).distinct()
    tried = of.join(fits.drop("n"), "__both").drop("__both")
    met = p.join(tried, key)
    at = lambda x: F.col(f"a{x}") * F.col("px") + F.col(f"b{x}") * F.col("py") + F.col(f"c{x}")
    error = geo.haversine(F.col("lon"), F.col("lat"), at("x"), at("y"))
    score = met.withColumn("e", error).groupBy(key, "__try").agg(F.count_if(F.col("e") <= within_m).alias("hits"), F.sum(F.when(F.col("e") <= within_m, F.col("e") * F.col("e"))).alias("sq"))
    best = saved(score.groupBy(key).agg(F.min(F.struct((-F.col("hits")).alias("h"), F.coalesce("sq", F.lit(0.0)).alias("sq"), F.col("__try").alias("t"))).alias("b")).select(key, F.col("b.t").alias("__try")))
    chosen = tried.join(best, [key, "__try"]).drop("__try")
    agreed = saved(residuals(p, chosen, key).where(F.col("error_m") <= within_m).select(*points.columns))
    return affine(agreed, key), agreed


# Heights


def combined_uncertainty(*parts: Column) -> Column:
    """Root of the sum of squares of independent uncertainties; null where one of them is unknown."""
    total = parts[0] * parts[0]
    for p in parts[1:]:
        total = total + p * p
    return F.sqrt(total)


def on_common_datum(values: DataFrame, transforms: DataFrame, target: str, assumed: tuple[str, ...] = ()) -> DataFrame:
    """values (id, value, positive, datum, lon, lat, uncertainty) as elevations, positive up, on the target datum.

    transforms: source, target, offset, authority, uncertainty and a box (west, south, east, north; all null: everywhere) in which it
    holds. state: SAME_REFERENCE, TRANSFORMED, or why a value is refused: UNKNOWN_DATUM (datum or sign unknown),
    NOT_A_NUMBER, ASSUMED_DATUM, NO_TRANSFORM, or AMBIGUOUS where several apply. Refused values are null.
    """
    up = F.when(F.col("positive") == "down", -F.col("value")).when(F.col("positive") == "up", F.col("value"))
    own = values.withColumn("up", up)
    box = (F.col("west").isNull() & F.col("south").isNull() & F.col("east").isNull() & F.col("north").isNull()) | F.coalesce(F.col("lon").between(F.col("west"), F.col("east")) & F.col("lat").between(F.col("south"), F.col("north")), F.lit(False))
    t = transforms.where(F.col("target") == target).select(F.col("source").alias("datum"), "offset", "authority", F.col("uncertainty").alias("unsure"), "west", "south", "east", "north")
    met = own.where(F.col("datum") != target).select("id", "datum", "lon", "lat").join(t, "datum").where(box)
    one = met.groupBy("id").agg(F.count(F.lit(1)).alias("n_fit"), F.min(F.struct("offset", "authority", "unsure")).alias("t"))
    j = own.join(one, "id", "left")
    finite = F.coalesce(F.abs("value") < float("inf"), F.lit(False))
    guess = F.col("datum").isin(*assumed) if assumed else F.lit(False)
    same = F.col("datum") == target
    state = (
        F.when(F.col("datum").isNull() | F.col("up").isNull() & F.col("value").isNotNull(), "UNKNOWN_DATUM").when(~finite | F.isnan("value"), "NOT_A_NUMBER").when(guess, "ASSUMED_DATUM")
        .when(same, "SAME_REFERENCE").when(F.col("n_fit").isNull(), "NO_TRANSFORM").when(F.col("n_fit") > 1, "AMBIGUOUS").otherwise("TRANSFORMED")
    )
    j = j.withColumn("state", state)
    moved = F.col("state") == "TRANSFORMED"
    elevation = F.when(F.col("state") == "SAME_REFERENCE", F.col("up")).when(moved, F.col("up") + F.col("t.offset"))
    unsure = F.when(F.col("state") == "SAME_REFERENCE", F.col("uncertainty")).when(moved, combined_uncertainty(F.col("uncertainty"), F.col("t.unsure")))
    return j.select("id", elevation.alias("elevation"), unsure.alias("uncertainty"), "state", F.when(moved, F.col("t.authority")).alias("authority"))
