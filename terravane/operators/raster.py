"""Rasters in long form: a row for each cell (row, col, value), null where there is no data.

Neighbour kernels run on tiles: cells go to the tiles whose halo they belong to (an explode, so a shuffle by tile key),
and numpy computes the inner cells of each tile. Memory is bounded by the tile.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tiled(cells: DataFrame, kernel: Callable[[np.ndarray], np.ndarray], halo: int, tile: int = 256) -> DataFrame:
    """row, col and value after a kernel on padded tiles; the kernel returns an array of its input's shape."""
    spread = lambda c: F.sequence(F.floor((F.col(c) - halo) / tile), F.floor((F.col(c) + halo) / tile))
    dealt = cells.select("row", "col", "value", F.explode(spread("row")).alias("tr"), spread("col").alias("tcs")).select("row", "col", "value", "tr", F.explode("tcs").alias("tc"))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        tr, tc = int(part["tr"].iloc[0]), int(part["tc"].iloc[0])
        a = np.full((tile + 2 * halo, tile + 2 * halo), np.nan)
        r, c = part["row"].to_numpy() - tr * tile + halo, part["col"].to_numpy() - tc * tile + halo
        a[r, c] = part["value"].to_numpy(dtype=float, na_value=np.nan)
        out = kernel(a)
        inner = (r >= halo) & (r < tile + halo) & (c >= halo) & (c < tile + halo)
        v = out[r[inner], c[inner]]
        return pd.DataFrame({"row": part["row"].to_numpy()[inner], "col": part["col"].to_numpy()[inner], "value": pd.array(np.where(np.isnan(v), 0.0, v), "Float64").copy()}).assign(value=lambda d: d["value"].mask(np.isnan(v)))

    return dealt.groupBy("tr", "tc").applyInPandas(run, "row long, col long, value double")


def slope(cells: DataFrame, dx: float, dy: float, tile: int = 256) -> DataFrame:
    """Slope in degrees by central differences; null at the border and beside missing cells."""

    def kernel(a: np.ndarray) -> np.ndarray:
        out = np.full_like(a, np.nan)
        gx = (a[1:-1, 2:] - a[1:-1, :-2]) / (2 * dx)
        gy = (a[2:, 1:-1] - a[:-2, 1:-1]) / (2 * dy)
        out[1:-1, 1:-1] = np.degrees(np.arctan(np.hypot(gx, gy)))
        return out

    return tiled(cells, kernel, 1, tile)


def position_index(cells: DataFrame, radius: int, tile: int = 256) -> DataFrame:
    """Value minus the mean of the square around it, the cells that exist in it."""

    def kernel(a: np.ndarray) -> np.ndarray:
        k = 2 * radius + 1
        have = np.isfinite(a)
        total = np.pad(np.where(have, a, 0.0), radius).cumsum(0).cumsum(1)
        count = np.pad(have.astype(float), radius).cumsum(0).cumsum(1)

        def window(s: np.ndarray) -> np.ndarray:
            s = np.pad(s, ((1, 0), (1, 0)))
            return s[k:, k:] - s[:-k, k:] - s[k:, :-k] + s[:-k, :-k]

        with np.errstate(invalid="ignore", divide="ignore"):
            return a - window(total) / window(count)

    return tiled(cells, kernel, radius, tile)


def coarsen(cells: DataFrame, factor: int) -> DataFrame:
    """Mean, least, greatest and number of the values in blocks of factor by factor."""
    at = lambda c: F.floor(F.col(c) / factor).alias(c)
    return cells.where("value is not null").groupBy(at("row"), at("col")).agg(F.avg("value").alias("mean"), F.min("value").alias("least"), F.max("value").alias("most"), F.count(F.lit(1)).alias("n"))


def difference(after: DataFrame, before: DataFrame, sigma: float = 0.0, z: float = 1.96) -> DataFrame:
    """after - before where both have data, and whether it exceeds z times the combined uncertainty."""
    j = after.select("row", "col", F.col("value").alias("a")).join(before.select("row", "col", F.col("value").alias("b")), ["row", "col"])
    d = F.col("a") - F.col("b")
    return j.where("a is not null and b is not null").select("row", "col", d.alias("change"), (F.abs(d) > z * sigma * 2**0.5).alias("significant"))


def accounting(cells: DataFrame) -> DataFrame:
    """How many cells have data and how many not."""
    return cells.agg(F.count("value").alias("n_data"), F.count_if(F.col("value").isNull()).alias("n_missing"))


def fill(cells: DataFrame, tile: int = 256) -> DataFrame:
    """row, col, value (filled to the spill level) and depth of the cells with data, wherever the raster begins and ends."""
    from .basins import fill as filled

    r0, c0, r1, c1 = cells.agg(F.min("row"), F.min("col"), F.max("row"), F.max("col")).first()
    if r0 is None:
        return cells.select("row", "col", F.col("value").cast("double").alias("value"), F.lit(0.0).alias("depth"))
    moved = cells.select((F.col("row") - r0).alias("row"), (F.col("col") - c0).alias("col"), "value")
    done = filled(moved, (r1 - r0 + 1, c1 - c0 + 1), tile)
    return done.select((F.col("row") + r0).alias("row"), (F.col("col") + c0).alias("col"), F.col("filled").alias("value"), "depth")
