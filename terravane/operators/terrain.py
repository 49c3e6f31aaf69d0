"""Surface derivatives of rasters in long form (row, col, value), with defined results at borders and beside gaps.

A raster has a shape (rows, columns). Beyond its border the nearest cell repeats for the derivatives and for roughness;
relief and the annulus index look only at cells that exist. A null, NaN or absent cell is a gap. Every cell that is
given comes back; what can't be said of it is null.

The cells travel once, to the tiles in whose halo they lie, and all measures of a call are computed together there.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Shape = tuple[int, int]
Measure = Callable[[np.ndarray, Callable[[np.ndarray], np.ndarray]], dict[str, np.ndarray]]


def on_tiles(cells: DataFrame, shape: Shape, halo: int, names: list[str], measure: Measure, tile: int = 256) -> DataFrame:
    """row, col and the named measures. measure gets a padded tile, NaN where nothing is, and a function that repeats
    the raster's border cells outwards in an array of that form."""
    last = [(n - 1) // tile for n in shape]

    def near(c: str, top: int) -> F.Column:
        return F.sequence(F.greatest(F.lit(0), F.floor((F.col(c) - halo) / tile)), F.least(F.lit(top), F.floor((F.col(c) + halo) / tile)))

    inside = cells.where(F.col("row").between(0, shape[0] - 1) & F.col("col").between(0, shape[1] - 1))
    dealt = inside.select("row", "col", "value", F.explode(near("row", last[0])).alias("tr"), near("col", last[1]).alias("tcs")).select("row", "col", "value", "tr", F.explode("tcs").alias("tc"))

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        r0, c0 = int(key[0]) * tile - halo, int(key[1]) * tile - halo
        size = tile + 2 * halo
        a = np.full((size, size), np.nan)
        r, c = part["row"].to_numpy() - r0, part["col"].to_numpy() - c0
        a[r, c] = part["value"].to_numpy(dtype=float, na_value=np.nan)
        rows = np.clip(np.arange(size) + r0, 0, shape[0] - 1) - r0
        cols = np.clip(np.arange(size) + c0, 0, shape[1] - 1) - c0
        found = measure(a, lambda x: x[np.ix_(rows, cols)])
        own = (r >= halo) & (r < tile + halo) & (c >= halo) & (c < tile + halo)
        out = {"row": r[own] + r0, "col": c[own] + c0}
        for n in names:
            v = found[n][r[own], c[own]]
            out[n] = pd.arrays.FloatingArray(np.where(np.isfinite(v), v, 0.0), ~np.isfinite(v))
        return pd.DataFrame(out)

    fields = ", ".join(["row long", "col long", *(f"{n} double" for n in names)])
    return dealt.groupBy("tr", "tc").applyInPandas(run, fields)


def _around(a: np.ndarray, reach: int = 1) -> np.ndarray:
    """All windows of an array, in the array's own shape."""
    return np.lib.stride_tricks.sliding_window_view(np.pad(a, reach, mode="edge"), (2 * reach + 1,) * 2)


def weighted(a: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted sum of each cell's nine, scaled up by the weight that gaps take away.

    A gap and the four cells that share a side with one have no result.
    """
    have = np.isfinite(a)
    total = np.einsum("ijkl,kl->ij", _around(np.where(have, a, 0.0)), weights)
    seen = np.einsum("ijkl,kl->ij", _around(have.astype(float)), np.abs(weights))
    beside = ~_around(have)
    gap = beside[..., 1, :].any(-1) | beside[..., :, 1].any(-1)
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(gap | (seen <= 0), np.nan, total * (np.abs(weights).sum() / seen))


def gradients(a: np.ndarray, dx: float, dy: float) -> tuple[np.ndarray, np.ndarray]:
    """Horn's derivatives to the east and along growing rows."""
    smooth, step = np.array([1.0, 2.0, 1.0]), np.array([-1.0, 0.0, 1.0])
    return weighted(a, np.outer(smooth, step) / (8 * dx)), weighted(a, np.outer(step, smooth) / (8 * dy))


def slope(cells: DataFrame, shape: Shape, dx: float, dy: float, azimuth: float = 315.0, altitude: float = 45.0, tile: int = 256) -> DataFrame:
    """slope in degrees, both derivatives, the ratio of true to flat area, and the shade under a light from azimuth."""
    sun, up = np.radians(450.0 - azimuth), np.radians(altitude)

    def measure(a: np.ndarray, border: Callable) -> dict[str, np.ndarray]:
        east, south = gradients(border(a), dx, dy)
        steep = np.arctan(np.hypot(east, south))
        shade = np.sin(up) * np.cos(steep) + np.cos(up) * np.sin(steep) * np.cos(sun - np.arctan2(south, -east))
        return {"slope": np.degrees(steep), "dz_dx": east, "dz_dy": south, "area_ratio": np.sqrt(1 + east**2 + south**2), "shade": np.clip(shade, 0.0, 1.0)}

    return on_tiles(cells, shape, 1, ["slope", "dz_dx", "dz_dy", "area_ratio", "shade"], measure, tile)


def curvatures(cells: DataFrame, shape: Shape, dx: float, dy: float, tile: int = 256) -> DataFrame:
    """profile (along the steepest descent), plan (across it) and general curvature; flat cells have 0 for the first two."""
    bend, mid, diag = np.array([1.0, -2.0, 1.0]), np.array([0.0, 1.0, 0.0]), np.array([-1.0, 0.0, 1.0])

    def measure(a: np.ndarray, border: Callable) -> dict[str, np.ndarray]:
        z = border(a)
        gx, gy = gradients(z, dx, dy)
        xx, yy = weighted(z, np.outer(mid, bend) / dx**2), weighted(z, np.outer(bend, mid) / dy**2)
        xy = weighted(z, np.outer(diag, diag) / (4 * dx * dy))
        p = gx**2 + gy**2
        flat = p == 0
        s = np.where(flat, 1.0, p)
        along = -(xx * gx**2 + 2 * xy * gx * gy + yy * gy**2) / (s * (1 + p) ** 1.5)
        across = -(xx * gy**2 - 2 * xy * gx * gy + yy * gx**2) / s**1.5
        return {"profile": np.where(flat, 0.0, along), "plan": np.where(flat, 0.0, across), "general": -(xx + yy)}

    return on_tiles(cells, shape, 1, ["profile", "plan", "general"], measure, tile)


def roughness(cells: DataFrame, shape: Shape, window: int = 3, tile: int = 256) -> DataFrame:
    """Standard deviation in a square window: of a population on a raster without gaps, of a sample on one with gaps.

    A window with a single value has 0. Whether there are gaps is asked once, by counting values.
    """
    if window < 3 or window % 2 == 0:
        raise ValueError("the window is an odd number from 3 on")
    gaps = cells.where(F.col("value").isNotNull() & ~F.isnan(F.col("value").cast("double"))).count() < shape[0] * shape[1]
    reach = window // 2

    def measure(a: np.ndarray, border: Callable) -> dict[str, np.ndarray]:
        z, (high, wide) = np.pad(border(a), reach, mode="edge"), a.shape
        views = [z[i : i + high, j : j + wide] for i in range(window) for j in range(window)]
        n = sum(np.isfinite(v).astype(float) for v in views)
        with np.errstate(invalid="ignore", divide="ignore"):
            mean = sum(np.nan_to_num(v) for v in views) / n
            off = sum(np.where(np.isfinite(v), v - mean, 0.0) ** 2 for v in views)
            spread = np.sqrt(off / (n - 1 if gaps else n))
        return {"roughness": np.where(np.isfinite(a), np.where(n > 1, spread, 0.0), np.nan)}

    return on_tiles(cells, shape, reach, ["roughness"], measure, tile)


def ruggedness(cells: DataFrame, shape: Shape, dx: float, dy: float, window: int = 3, tile: int = 256) -> DataFrame:
    """How much the surface's unit normals disperse in a window, 0 to 1; null where one of them is unknown."""
    if window < 3 or window % 2 == 0:
        raise ValueError("the window is an odd number from 3 on")
    reach = window // 2

    def measure(a: np.ndarray, border: Callable) -> dict[str, np.ndarray]:
        east, south = gradients(border(a), dx, dy)
        length = np.sqrt(east**2 + south**2 + 1)
        sums = [_around(border(part / length), reach).sum((-1, -2)) for part in (east, south, np.ones_like(east))]
        return {"ruggedness": np.clip(1 - np.sqrt(sum(s**2 for s in sums)) / window**2, 0.0, 1.0)}

    return on_tiles(cells, shape, reach + 1, ["ruggedness"], measure, tile)


def relief(cells: DataFrame, shape: Shape, radius: int, tile: int = 256) -> DataFrame:
    """Greatest less least value in the square around each cell."""

    def measure(a: np.ndarray, border: Callable) -> dict[str, np.ndarray]:
        have = np.isfinite(a)

        def extreme(x: np.ndarray, fill: float, pick: Callable) -> np.ndarray:
            for axis in (0, 1):
                pad = [(radius, radius) if k == axis else (0, 0) for k in (0, 1)]
                x = pick(np.lib.stride_tricks.sliding_window_view(np.pad(x, pad, constant_values=fill), 2 * radius + 1, axis=axis), axis=-1)
            return x

        high = extreme(np.where(have, a, -np.inf), -np.inf, np.max)
        low = extreme(np.where(have, a, np.inf), np.inf, np.min)
        return {"relief": np.where(have, high - low, np.nan)}

    return on_tiles(cells, shape, radius, ["relief"], measure, tile)


def annulus_index(cells: DataFrame, shape: Shape, outer: int, inner: int = 0, tile: int = 256) -> DataFrame:
    """Value less the mean of the cells between two radii, the cell itself left out; negative in a hollow."""
    if not 0 <= inner < outer:
        raise ValueError("the inner radius is not negative and less than the outer")
    steps = [(i, j) for i in range(-outer, outer + 1) for j in range(-outer, outer + 1) if max(inner**2, 1) <= i * i + j * j <= outer**2]

    def measure(a: np.ndarray, border: Callable) -> dict[str, np.ndarray]:
        have = np.isfinite(a)
        z = np.pad(np.where(have, a, 0.0), outer)
        h = np.pad(have.astype(float), outer)
        n0, n1 = a.shape
        at = lambda x, i, j: x[outer + i : outer + i + n0, outer + j : outer + j + n1]
        total, count = sum(at(z, *s) for s in steps), sum(at(h, *s) for s in steps)
        with np.errstate(invalid="ignore", divide="ignore"):
            return {"index": a - total / np.where(count > 0, count, np.nan)}

    return on_tiles(cells, shape, outer, ["index"], measure, tile)


def sample(stations: DataFrame, cells: DataFrame, origin: tuple[float, float], size: tuple[float, float]) -> DataFrame:
    """stations (x, y and more) with row, col and value of the cell under each; null off the raster or on a gap.

    origin is the raster's upper left corner; rows grow downwards.
    """
    at = stations.withColumns({"row": F.floor((F.lit(origin[1]) - F.col("y")) / size[1]).cast("long"), "col": F.floor((F.col("x") - F.lit(origin[0])) / size[0]).cast("long")})
    return at.join(cells.select("row", "col", "value"), ["row", "col"], "left")


# Shares of the risk score and the factor that brings each measure to 1.
RISK = {"entropy": (0.30, 1 / 5.0), "edge": (0.30, 20.0), "banding": (0.20, 15.0), "coherence": (0.20, 1.0)}


def image_measures(pixels: DataFrame, key: str = "image_id") -> DataFrame:
    """For each full image of pixels (key, row, col, value from 0 to 1): entropy, edge, banding, coherence and risk.

    entropy is that of 32 equal bins in bits, edge the mean length of the steps to the right and down, banding the
    deviation of the row means, coherence that of the column means over it, risk their weighted sum from 0 to 100.
    Values outside 0 to 1 are in no bin; an image of one row or column has edge 0.
    """
    from pyspark.sql import Window

    def spread(axis: str, name: str) -> DataFrame:
        return pixels.groupBy(key, axis).agg(F.avg("value").alias("m")).groupBy(key).agg(F.stddev_pop("m").alias(name))

    bins = pixels.where("value between 0 and 1").groupBy(key, F.least(F.lit(31), F.floor(F.col("value") * 32.0)).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    entropy = bins.groupBy(key).agg((F.log2(F.sum("n")) - F.sum(F.col("n") * F.log2("n")) / F.sum("n")).alias("entropy"))
    step = lambda line, along: F.lead("value").over(Window.partitionBy(key, line).orderBy(along)) - F.col("value")
    edge = pixels.select(key, step("row", "col").alias("gx"), step("col", "row").alias("gy")).groupBy(key).agg(F.coalesce(F.avg(F.sqrt(F.col("gx") * F.col("gx") + F.col("gy") * F.col("gy"))), F.lit(0.0)).alias("edge"))
    found = spread("row", "banding").join(spread("col", "across"), key).join(entropy, key, "left").join(edge, key)
    full = found.select(key, F.coalesce("entropy", F.lit(0.0)).alias("entropy"), "edge", "banding", (F.col("across") / (F.col("banding") + 1e-9)).alias("coherence"))
    risk = sum((w * F.least(F.col(c) * k, F.lit(1.0)) for c, (w, k) in RISK.items()), F.lit(0.0))
    return full.withColumn("risk", F.round(risk * 100.0, 2))


def changed_share(before: DataFrame, after: DataFrame, threshold: float, key: str = "image_id") -> DataFrame:
    """For each image in both: how many pixels both have, and the share that differ by more than the threshold."""
    a = before.select(key, "row", "col", F.col("value").alias("a"))
    b = after.select(key, "row", "col", F.col("value").alias("b"))
    return a.join(b, [key, "row", "col"]).groupBy(key).agg(F.count(F.lit(1)).alias("n_pixels"), F.avg((F.abs(F.col("a") - F.col("b")) > threshold).cast("double")).alias("changed"))
