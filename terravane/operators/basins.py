"""Closed depressions, steep bands and survey seams of rasters in long form (row, col, value).

Heights are filled to their spill levels and regions are labelled by tiles (see tiles.py), so no step depends on how
long a path winds or how large a region is. A region's measures are sums, least and greatest values over its cells and
over the two-by-two squares that it touches, so tiles hand on one row a region; only outlines (the first and last cell
of each row) of the regions that are reported meet in one task, to take their convex hull.

Defined results: a null, NaN or absent cell is a gap. Gaps and what lies beyond the border are outlets: a hollow that
could drain into them is not closed. Regions join over sides and corners. A region's label is the place (row * columns
+ column) of its first cell in reading order, whatever the tiles. Where several cells are deepest the first counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import saved
from .terrain import gradients
from .tiles import EDGE, OUTSIDE, RIM, Shape, dealt, front, grid_of, joined, least_edges, levels_of, merge_labels, merge_passes, pairs, roots_of, settle, upward

TILE = 256
#: Depths up to this count as none where no uncertainty is stated.
LEAST_DEPTH = 1e-6
_CELL = 3

# Filling


def _flooded(a: np.ndarray, key: tuple, tile: int, wide: int) -> pd.DataFrame:
    """One tile (with a halo of one cell) settled as far as it can be: its cells, its rim and the graph of its labels."""
    z = a[1:-1, 1:-1]
    have = np.isfinite(z)
    h, w = z.shape
    place = (np.arange(h)[:, None] + int(key[0]) * tile) * wide + np.arange(w)[None, :] + int(key[1]) * tile
    ground = np.where(have, z, np.inf)
    open_side = np.zeros((h, w), bool)
    best, to = ground, np.arange(h * w).reshape(h, w)
    padded, number = np.pad(ground, 1, constant_values=np.inf), np.pad(to, 1, constant_values=-1)
    for i in (-1, 0, 1):
        for j in (-1, 0, 1):
            if i or j:
                open_side |= ~np.isfinite(a[1 + i : 1 + i + h, 1 + j : 1 + j + w])
                zz, nn = padded[1 + i : 1 + i + h, 1 + j : 1 + j + w], number[1 + i : 1 + i + h, 1 + j : 1 + j + w]
                lower = (zz < best) | ((zz == best) & (nn >= 0) & (nn < to))
                best, to = np.where(lower, zz, best), np.where(lower, nn, to)
    down = to.ravel()
    while not np.array_equal(nxt := down[down], down):
        down = nxt
    flat = have.ravel()
    bottoms, node = np.unique(down[flat], return_inverse=True)
    n = len(bottoms)
    at = np.full(h * w, -1)
    at[flat] = node
    at = at.reshape(h, w)
    u, v = pairs(at)
    high = np.maximum(*pairs(ground))
    differ = (u != v) & (u >= 0) & (v >= 0)
    u, v, high = least_edges(u[differ], v[differ], high[differ])
    # The last node is the outside.
    drains = have & open_side
    low = np.full(n, np.inf)
    np.minimum.at(low, at[drains], z[drains])
    out = np.flatnonzero(np.isfinite(low))
    u, v, high = np.concatenate([u, out]), np.concatenate([v, np.full(len(out), n)]), np.concatenate([high, low[out]])
    edge = np.zeros((h, w), bool)
    edge[[0, -1], :] = edge[:, [0, -1]] = True
    edge &= have
    fixed = np.zeros(n + 1, bool)
    fixed[at[edge]] = fixed[n] = True
    owner, level = settle(n + 1, u, v, high, fixed)
    names = np.append(place.ravel()[bottoms], OUTSIDE)
    x, y, pass_at = least_edges(owner[u], owner[v], np.maximum(high, np.maximum(level[u], level[v])))
    row, col = np.nonzero(have)
    mine = at[row, col]
    r0, c0 = int(key[0]) * tile, int(key[1]) * tile
    cells = front(_CELL, row=row + r0, col=col + c0, u=names[owner[mine]], w=np.maximum(z[row, col], level[mine])).assign(z=z[row, col])
    er, ec = np.nonzero(edge)
    rim = front(RIM, row=er + r0, col=ec + c0, u=names[owner[at[er, ec]]], w=z[er, ec])
    return pd.concat([cells, rim, front(EDGE, u=names[x], v=names[y], w=pass_at)]).assign(tr=int(key[0]), tc=int(key[1]))


def fill(cells: DataFrame, shape: Shape, tile: int = TILE) -> DataFrame:
    """row, col, value, filled (raised to the spill level) and depth of every cell with data."""

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return _flooded(grid_of(part, key, tile, 1, "value"), key, tile, shape[1])[["tr", "tc", "kind", "row", "col", "u", "v", "w", "z"]]

    known = cells.where(F.col("value").isNotNull() & ~F.isnan(F.col("value").cast("double")))
    first = saved(dealt(known, shape, tile, 1, "value").groupBy("tr", "tc").applyInPandas(run, "tr long, tc long, kind int, row long, col long, u long, v long, w double, z double"))
    settled = upward(first.where(F.col("kind").isin(RIM, EDGE)).drop("z"), shape, tile, merge_passes)
    own = first.where(F.col("kind") == _CELL).select("row", "col", F.col("z").alias("value"), F.nullif("u", F.lit(OUTSIDE)).alias("label"), "w")
    full = own.join(levels_of(settled), "label", "left").select("row", "col", "value", F.greatest("w", F.coalesce("level", "w")).alias("filled"))
    return full.withColumn("depth", F.col("filled") - F.col("value"))


# Regions

#: Crofton's weights for the sixteen patterns of a two-by-two square, four directions (fixed values).
_A, _B = math.pi / 4 * (1 + 1 / math.sqrt(2)), math.pi / (4 * math.sqrt(2))
CROFTON = np.array([0, _A, _B, 2 * _B, 0, _A, 0, _B, math.pi / 4, math.pi / 2, _B, _B, math.pi / 4, math.pi / 2, 0, 0])

_SUMS = ("n", "rows", "cols", "rr", "cc", "rc", "outline", "slopes", "n_slopes", "n_flat", "depths", "guessed", "n_seam")
_PART = "label long, " + ", ".join(f"{c} {'double' if c in ('outline', 'slopes', 'depths') else 'long'}" for c in _SUMS) + ", r0 long, r1 long, c0 long, c1 long, low double, high double, sigma double, beside_gap boolean, depth double, deepest long, spill double, floor double"
_REGION = f"tr long, tc long, kind int, row long, col long, u long, v long, w double, {_PART}, c_first long, c_last long"
_PARTIAL, _OUTLINE = 4, 5


def _outline(wet: np.ndarray) -> np.ndarray:
    """The share of the outline that each wet inner cell of a padded mask answers for: squares of which it is the first wet cell."""
    at = lambda i, j: wet[1 + i : wet.shape[0] - 1 + i, 1 + j : wet.shape[1] - 1 + j].astype(int)
    own = CROFTON[8 + 2 * at(0, 1) + 4 * at(1, 0) + at(1, 1)]
    own = own + np.where(at(0, -1) == 0, CROFTON[2 + 4 * at(1, -1) + at(1, 0)], 0.0)
    own = own + np.where((at(-1, 0) + at(-1, 1)) == 0, CROFTON[4 + at(0, 1)], 0.0)
    return own + np.where((at(-1, -1) + at(-1, 0) + at(0, -1)) == 0, CROFTON[1], 0.0)


def _parts(a: dict[str, np.ndarray], wet: np.ndarray, key: tuple, tile: int, shape: Shape, least_depth: float, least_cells: float) -> pd.DataFrame:
    """What a tile says of its regions: a row of measures for each, the first and last cell of each of their rows, and its rim."""
    r0, c0 = int(key[0]) * tile, int(key[1]) * tile
    inner = wet[1:-1, 1:-1]
    h, w = inner.shape
    r, c = np.nonzero(inner)
    at = np.full((h, w), -1)
    at[r, c] = np.arange(len(r))
    u, v = pairs(at)
    some = (u >= 0) & (v >= 0)
    root = joined(len(r), u[some], v[some])
    heads, k = np.unique(root, return_inverse=True)
    n = len(heads)
    take = lambda name: a[name][1:-1, 1:-1][r, c]
    row, col = r + r0, c + c0
    place = row * shape[1] + col
    add = lambda x: np.bincount(k, weights=x, minlength=n)

    def pick(ufunc, start, x):
        out = np.full(n, start, dtype=np.asarray(x).dtype)
        ufunc.at(out, k, x)
        return out

    whole = lambda x: pick(np.add, 0, x)
    slope, depth, z = take("slope"), take("depth"), take("value")
    steep = np.isfinite(slope)
    deepest = np.lexsort((place, -depth, k))
    first = deepest[np.searchsorted(k[deepest], np.arange(n))]
    gap = np.zeros((h, w), bool)
    rr, cc = np.arange(h)[:, None] + r0, np.arange(w)[None, :] + c0
    for i in (-1, 0, 1):
        for j in (-1, 0, 1):
            on = (rr + i >= 0) & (rr + i < shape[0]) & (cc + j >= 0) & (cc + j < shape[1])
            gap |= on & ~np.isfinite(a["value"][1 + i : 1 + i + h, 1 + j : 1 + j + w])
    rim = (r == 0) | (c == 0) | (r == h - 1) | (c == w - 1)
    one = np.ones(len(r), np.int64)
    part = pd.DataFrame(
        {
            "label": place[heads], "n": whole(one), "rows": whole(row), "cols": whole(col), "rr": whole(row * row), "cc": whole(col * col), "rc": whole(row * col),
            "outline": add(_outline(wet)[r, c]), "slopes": add(np.where(steep, slope, 0.0)), "n_slopes": whole(steep.astype(np.int64)), "n_flat": whole((steep & (slope < 2.0)).astype(np.int64)),
            "depths": add(depth), "guessed": whole((take("guessed") > 0).astype(np.int64)), "n_seam": whole((take("seam") > 0).astype(np.int64)),
            "r0": pick(np.minimum, 1 << 62, row), "r1": pick(np.maximum, -1, row), "c0": pick(np.minimum, 1 << 62, col), "c1": pick(np.maximum, -1, col),
            "low": pick(np.minimum, np.inf, z), "high": pick(np.maximum, -np.inf, z), "sigma": pick(np.fmax, np.nan, take("sigma")), "beside_gap": pick(np.logical_or, False, gap[r, c]),
            "depth": depth[first], "deepest": place[first], "spill": z[first] + depth[first], "floor": z[first],
        }
    )
    # A region inside the tile that is too small or too shallow is done with.
    whole_here = ~pick(np.logical_or, False, rim)
    stays = ~whole_here | ((part["depth"].to_numpy() >= least_depth) & (part["n"].to_numpy() >= least_cells))
    order = np.lexsort((c, r, k))
    line = k[order] * (h + 1) + r[order]
    new = np.ones(len(line), bool)
    new[1:] = line[1:] != line[:-1]
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(line))[: len(starts)] - 1
    lines = order[starts]
    out = pd.DataFrame({"label": place[heads][k[lines]], "row": row[lines], "c_first": col[lines], "c_last": col[order[ends]], "kind": _OUTLINE})[stays[k[lines]]]
    rims = front(RIM, row=row[rim], col=col[rim], u=place[heads][k[rim]])
    return pd.concat([_typed(x, key) for x in (part[stays].assign(kind=_PARTIAL), out, rims)])


def _typed(made: pd.DataFrame, key: tuple) -> pd.DataFrame:
    """A frame with all columns of _REGION, null where it has none."""
    kinds = dict(f.split() for f in _REGION.split(", "))
    types = {"long": "Int64", "int": "Int64", "boolean": "boolean", "double": "float64"}
    made = made.assign(tr=int(key[0]), tc=int(key[1])).reindex(columns=list(kinds))
    return made.astype({name: types[kind] for name, kind in kinds.items()})


def regions(cells: DataFrame, shape: Shape, dx: float, dy: float, least_slope: float | None = None, least_depth: float = 0.0, least_cells: float = 1.0, tile: int = TILE) -> tuple[DataFrame, DataFrame]:
    """Measures (a row a region) and outlines (label, row, c_first, c_last) of the regions of cells.

    cells have row, col and value, and may have depth, sigma, guessed and seam. A region's cells are steeper than
    least_slope (in degrees), or without it deeper than the column floor_depth.
    """
    names = ["value", *(c for c in ("depth", "sigma", "guessed", "seam", "floor_depth") if c in cells.columns)]

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        a = {c: grid_of(part, key, tile, 1, c) for c in names}
        size = tile + 2
        for c, fallback in (("depth", 0.0), ("sigma", np.nan), ("guessed", 0.0), ("seam", 0.0)):
            a.setdefault(c, np.full((size, size), fallback))
        rows = np.clip(np.arange(size) + int(key[0]) * tile - 1, 0, shape[0] - 1) - (int(key[0]) * tile - 1)
        cols = np.clip(np.arange(size) + int(key[1]) * tile - 1, 0, shape[1] - 1) - (int(key[1]) * tile - 1)
        east, south = gradients(a["value"][np.ix_(rows, cols)], dx, dy)
        a["slope"] = np.degrees(np.arctan(np.hypot(east, south)))
        with np.errstate(invalid="ignore"):
            mask = a["depth"] > a["floor_depth"] if least_slope is None else (a["slope"] >= least_slope) & np.isfinite(a["value"])
        a["depth"] = np.nan_to_num(a["depth"])
        return _parts(a, mask, key, tile, shape, least_depth, least_cells)

    first = saved(dealt(cells, shape, tile, 1, *names).groupBy("tr", "tc").applyInPandas(run, _REGION))
    settled = upward(first.where(F.col("kind") == RIM).select("tr", "tc", "kind", "row", "col", "u", "v", "w"), shape, tile, merge_labels)
    roots = saved(roots_of(settled))

    def under_root(df: DataFrame) -> DataFrame:
        return df.join(roots, "label", "left").withColumn("label", F.coalesce("root", "label")).drop("root")

    deep = F.min(F.struct((-F.col("depth")).alias("d"), F.col("deepest").alias("deepest"), F.col("spill").alias("spill"), F.col("floor").alias("floor"))).alias("at")
    merged = (
        under_root(first.where(F.col("kind") == _PARTIAL).select(*(f.split()[0] for f in _PART.split(", "))))
        .groupBy("label")
        .agg(*(F.sum(c).alias(c) for c in _SUMS), *(F.min(c).alias(c) for c in ("r0", "c0", "low")), *(F.max(c).alias(c) for c in ("r1", "c1", "high", "beside_gap")), F.max(F.nanvl("sigma", F.lit(None).cast("double"))).alias("sigma"), deep)
        .withColumns({"depth": -F.col("at.d"), "deepest": F.col("at.deepest"), "spill": F.col("at.spill"), "floor": F.col("at.floor")})
        .drop("at")
    )
    outlines = under_root(first.where(F.col("kind") == _OUTLINE).select("label", "row", "c_first", "c_last")).groupBy("label", "row").agg(F.min("c_first").alias("c_first"), F.max("c_last").alias("c_last"))
    kept = merged.where((F.col("depth") >= least_depth) & (F.col("n") >= least_cells)) if least_depth > 0 or least_cells > 1 else merged
    return kept, outlines


def axes() -> tuple[Column, Column]:
    """Lengths, in cells, of the longer and the shorter axis of the ellipse with the region's second moments."""
    n = F.col("n").cast("double")
    # About the box's corner, so that no digits are lost far from the raster's origin.
    mean = lambda s, o: F.col(s) / n - F.col(o)
    var = lambda s, ss, o: (F.col(ss) - 2 * F.col(o) * F.col(s) + F.col(o) * F.col(o) * F.col("n")).cast("double") / n - mean(s, o) * mean(s, o)
    both = (F.col("rc") - F.col("c0") * F.col("rows") - F.col("r0") * F.col("cols") + F.col("r0") * F.col("c0") * F.col("n")).cast("double") / n - mean("rows", "r0") * mean("cols", "c0")
    a, b = var("rows", "rr", "r0"), var("cols", "cc", "c0")
    half, root = (a + b) / 2, F.sqrt((a - b) * (a - b) / 4 + both * both)
    zero = F.lit(0.0)
    return 4 * F.sqrt(F.greatest(half + root, zero)), 4 * F.sqrt(F.greatest(half - root, zero))


def _hull_cells(r: np.ndarray, first: np.ndarray, last: np.ndarray) -> int:
    """Cells whose centres lie in or on the convex hull of the cells' side midpoints. Everything is doubled, so integers are exact."""

    def chain(x: np.ndarray, sign: int) -> list[int]:
        """For each doubled row the hull's bound, as the outermost cell on it."""
        y = np.concatenate([2 * r - 1, 2 * r, 2 * r + 1])
        x = np.concatenate([2 * x, 2 * x + sign, 2 * x])
        points: dict[int, int] = {}
        for yy, xx in zip(y.tolist(), (x * sign).tolist(), strict=True):
            points[yy] = max(points.get(yy, xx), xx)
        hull: list[tuple[int, int]] = []
        for p in sorted(points.items()):
            while len(hull) > 1 and (hull[-1][0] - hull[-2][0]) * (p[1] - hull[-2][1]) >= (hull[-1][1] - hull[-2][1]) * (p[0] - hull[-2][0]):
                hull.pop()
            hull.append(p)
        out, k = [], 0
        for row in range(int(r.min()), int(r.max()) + 1):
            while hull[k + 1][0] < 2 * row:
                k += 1
            (y1, x1), (y2, x2) = hull[k], hull[k + 1]
            out.append((x1 * (y2 - y1) + (x2 - x1) * (2 * row - y1)) // (2 * (y2 - y1)))
        return out

    right, left = chain(last, 1), chain(first, -1)
    return sum(a + b + 1 for a, b in zip(right, left, strict=True))


def hulls(outlines: DataFrame) -> DataFrame:
    """label and hull (cells of its convex hull) of each region.

    Regions go to Python many at a time: most have a few lines, and a pandas group for each would cost more than its hull.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame({"label": part["label"], "hull": [_hull_cells(*np.stack(lines).T) for lines in part["lines"]]})

    lines = F.collect_list(F.array("row", "c_first", "c_last")).alias("lines")
    return outlines.groupBy("label").agg(lines).mapInPandas(run, "label long, hull long")


def depressions(cells: DataFrame, shape: Shape, dx: float, dy: float, min_depth: float, min_area: float, footprint_depth: float | None = None, origin: tuple[float, float] = (0.0, 0.0), tile: int = TILE) -> DataFrame:
    """Closed depressions of at least this depth and area, with their measures.

    cells have row, col and value, and may have sigma (a height's uncertainty) and guessed (interpolated, boolean). A
    cell belongs where it lies deeper than footprint_depth, or by default deeper than the uncertainty of a depth.
    origin is the raster's upper left corner; rows grow downwards.
    """
    if min_depth <= 0 or min_area <= 0 or (footprint_depth is not None and not 0 <= footprint_depth < math.inf):
        raise ValueError("least depth and area have to be positive, and a footprint's depth must not be negative")
    more = [c for c in ("sigma", "guessed") if c in cells.columns]
    full = fill(cells, shape, tile)
    if more:
        full = full.join(cells.select("row", "col", *(F.col(c).cast("double").alias(c) for c in more)), ["row", "col"])
    if footprint_depth is not None:
        floor = F.lit(float(footprint_depth))
    elif "sigma" in more:
        floor = F.greatest(F.lit(LEAST_DEPTH), F.coalesce(F.nanvl("sigma", F.lit(0.0)), F.lit(0.0)) * math.sqrt(2.0))
    else:
        floor = F.lit(LEAST_DEPTH)
    found, outlines = regions(full.withColumn("floor_depth", floor), shape, dx, dy, None, min_depth, min_area / (dx * dy), tile)
    found = saved(found)
    found = found.join(hulls(outlines.join(found.select("label"), "label", "left_semi")), "label")
    area, long, short = F.col("n") * (dx * dy), *axes()
    or_one = lambda c: F.when(c > 0, c).otherwise(1.0)
    around = F.when(F.col("n") > 1, F.col("outline")).otherwise(4.0) * math.sqrt(dx * dy)
    wide = 2 * F.sqrt(area / math.pi)
    unsure = math.sqrt(2.0) * F.col("sigma")
    x = lambda c: F.lit(origin[0]) + c * dx
    y = lambda r: F.lit(origin[1]) - r * dy
    deep_row, deep_col = F.floor(F.col("deepest") / shape[1]), F.col("deepest") % shape[1]
    return found.select(
        "label",
        F.col("n").alias("n_cells"),
        area.alias("area"),
        F.col("depth").alias("max_depth"),
        (F.col("depths") / F.col("n")).alias("mean_depth"),
        (F.col("depths") * (dx * dy)).alias("volume"),
        "spill",
        "floor",
        x(F.col("cols") / F.col("n") + 0.5).alias("centre_x"),
        y(F.col("rows") / F.col("n") + 0.5).alias("centre_y"),
        x(deep_col + 0.5).alias("deepest_x"),
        y(deep_row + 0.5).alias("deepest_y"),
        *(F.col(c) for c in ("r0", "c0", "r1", "c1")),
        wide.alias("diameter"),
        (F.col("depth") / wide).alias("depth_to_diameter"),
        F.least(F.lit(1.0), 4 * math.pi * area / (around * around)).alias("circularity"),
        (or_one(long) / or_one(short)).alias("elongation"),
        (F.col("n") / F.col("hull")).alias("solidity"),
        (F.col("n") / ((F.col("r1") - F.col("r0") + 1) * (F.col("c1") - F.col("c0") + 1))).alias("rectangularity"),
        F.when(F.col("n_slopes") > 0, F.col("slopes") / F.col("n_slopes")).alias("wall_slope"),
        F.when(F.col("n_slopes") > 0, F.col("n_flat") / F.col("n_slopes")).alias("flat_share"),
        "beside_gap",
        ((F.col("r0") == 0) | (F.col("c0") == 0) | (F.col("r1") == shape[0] - 1) | (F.col("c1") == shape[1] - 1)).alias("at_edge"),
        (F.col("guessed") / F.col("n") if "guessed" in more else F.lit(None).cast("double")).alias("guessed_share"),
        unsure.alias("depth_uncertainty"),
        F.when(unsure > 0, F.col("depth") / unsure).alias("significance"),
    )


# Seams


def _median(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Exact medians by rank. Values are sorted within a key, not gathered; a key is one line of the raster at most."""
    ranked = df.withColumns({"__k": F.row_number().over(Window.partitionBy(*keys).orderBy(value)), "__n": F.count(F.lit(1)).over(Window.partitionBy(*keys))})
    middle = ranked.where((F.col("__k") >= F.floor((F.col("__n") + 1) / 2)) & (F.col("__k") <= F.floor(F.col("__n") / 2) + 1))
    return middle.groupBy(*keys).agg(F.avg(value).alias(name))


def _steps(cells: DataFrame, shape: Shape, tile: int) -> DataFrame:
    """down (whether the step is downwards), index and step. No text leaves the Python workers: there are two rows a cell."""

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        a = grid_of(part, key, tile, 1, "value")[1:, 1:]
        out = []
        for down, near in ((False, a[:-1, 1:]), (True, a[1:, :-1])):
            d = near - a[:-1, :-1]
            r, c = np.nonzero(np.isfinite(d))
            out.append(pd.DataFrame({"down": np.full(len(r), down), "index": (r + int(key[0]) * tile) if down else (c + int(key[1]) * tile), "step": d[r, c]}))
        return pd.concat(out)

    return dealt(cells.select("row", "col", "value"), shape, tile, 1, "value").groupBy("tr", "tc").applyInPandas(run, "down boolean, index long, step double")


def steps(cells: DataFrame, shape: Shape, tile: int = TILE) -> DataFrame:
    """axis, index and step for every two neighbouring cells with data: "column" to the right, "row" downwards.

    The step lies between index and index + 1.
    """
    return _steps(cells, shape, tile).select(F.when(F.col("down"), "row").otherwise("column").alias("axis"), "index", "step")


def seams(cells: DataFrame, shape: Shape, z_threshold: float = 8.0, min_sign_share: float = 0.9, min_run_share: float = 0.5, min_step: float = 0.0, tile: int = TILE) -> DataFrame:
    """Joins between surveys: grid lines along which the surface steps by nearly the same amount.

    A line's median step has to stand out from those of all lines of its axis (by median and median deviation, scaled to
    a standard deviation), and most of its steps have one sign. Lines with too few steps do not count, and an axis with
    fewer than five lines that count has no seams; if the median deviation is 0 the standard deviation is taken.
    """
    all_steps = saved(_steps(cells, shape, tile))
    length = F.when(F.col("axis") == "column", shape[0]).otherwise(shape[1])
    # Zeros are of neither sign.
    lines = all_steps.groupBy("down", "index").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("step") > 0).alias("up"), F.count_if(F.col("step") < 0).alias("down_steps"))
    lines = lines.withColumn("axis", F.when(F.col("down"), "row").otherwise("column"))
    usable = lines.where(F.col("n") >= F.greatest(F.lit(3), F.ceil(length * F.lit(min_run_share))))
    # Lines know their number of steps, so one rank over the sorted steps is enough for their medians.
    ranked = all_steps.withColumn("k", F.row_number().over(Window.partitionBy("down", "index").orderBy("step")))
    middle = ranked.join(usable, ["down", "index"]).where((F.col("k") >= F.floor((F.col("n") + 1) / 2)) & (F.col("k") <= F.floor(F.col("n") / 2) + 1))
    usable = saved(middle.groupBy("axis", "index", "n", "up", "down_steps").agg(F.avg("step").alias("med")).withColumnRenamed("down_steps", "down"))
    # From here on there is a row a line.
    centre = _median(usable, ["axis"], "med", "centre").join(usable.groupBy("axis").agg(F.count(F.lit(1)).alias("n_lines"), F.stddev_pop("med").alias("sd")), "axis")
    off = usable.join(centre, "axis").withColumn("off", F.abs(F.col("med") - F.col("centre")))
    scaled = off.join(_median(off.select("axis", "off"), ["axis"], "off", "mad"), "axis").where("n_lines >= 5")
    scale = F.when(F.col("mad") > 0, 1.4826 * F.col("mad")).otherwise(F.col("sd"))
    z = (F.col("med") - F.col("centre")) / scale
    sign = F.greatest("up", "down") / F.col("n")
    told = scaled.where(scale > 0).select("axis", "index", F.col("med").alias("step"), z.alias("robust_z"), sign.alias("sign_share"), (F.col("n") / length).alias("run_share"))
    return told.where((F.abs("robust_z") >= z_threshold) & (F.abs("step") >= min_step) & (F.col("sign_share") >= min_sign_share))


def seam_lines(found: DataFrame, shape: Shape, halo: int = 1) -> DataFrame:
    """axis and line: rows or columns of cells within halo of a seam."""
    top = F.when(F.col("axis") == "column", shape[1]).otherwise(shape[0]) - 1
    return found.select("axis", F.explode(F.sequence(F.greatest(F.lit(0), F.col("index") - halo + 1), F.least(top.cast("long"), F.col("index") + halo))).alias("line")).distinct()


# Detections


_BLOCK = 256


def _over_seams(boxes: DataFrame, lines: DataFrame) -> DataFrame:
    """boxes with on_seam: whether a seam's line crosses the box. Lines and boxes meet by blocks of lines."""
    block = lambda c: F.floor(F.col(c) / _BLOCK)
    hit = None
    for axis, lo, hi in (("column", "c0", "c1"), ("row", "r0", "r1")):
        spread = boxes.select("label", lo, hi, F.explode(F.sequence(block(lo), block(hi))).alias("block"))
        own = lines.where(F.col("axis") == axis).select("line", block("line").alias("block"))
        crossed = spread.join(own, "block").where(F.col("line").between(F.col(lo), F.col(hi))).select("label")
        hit = crossed if hit is None else hit.unionByName(crossed)
    return boxes.join(hit.distinct().withColumn("on_seam", F.lit(True)), "label", "left").withColumn("on_seam", F.coalesce("on_seam", F.lit(False)))


# A box that a region fills to this share is rectangular.
RECTANGULAR = 0.88


def basin_detections(cells: DataFrame, shape: Shape, dx: float, dy: float, min_depth: float, min_area: float, offshore: bool = False, in_karst: bool = False, significance_floor: float = 3.0, artifact_share: float = 0.5, origin: tuple[float, float] = (0.0, 0.0), tile: int = TILE) -> DataFrame:
    """Depressions with flags, tier, proposed class and a score from 0 to 100 that ranks them for review.

    On land a rectangular flat-floored one is an excavation and, inside mapped karst, a round one a sinkhole; on the
    seabed a steep round one may be a blue hole. What lies on a seam, or mostly on interpolated cells, is an artefact.
    """
    lines = seam_lines(seams(cells, shape, tile=tile), shape)
    found = _over_seams(depressions(cells, shape, dx, dy, min_depth, min_area, None, origin, tile), lines)
    mostly = F.coalesce(F.col("guessed_share") >= artifact_share, F.lit(False))
    partly = F.coalesce(F.col("guessed_share") > 0, F.lit(False)) & ~mostly
    unknown = F.col("significance").isNull()
    below = F.coalesce(F.col("significance") < significance_floor, F.lit(False))
    flags = F.array_compact(
        F.array(*(F.when(test, F.lit(name)) for test, name in ((F.col("on_seam"), "SEAM_OVERLAP"), (mostly, "MOSTLY_INTERPOLATED"), (partly, "PARTLY_INTERPOLATED"), (unknown, "UNCERTAINTY_UNKNOWN"), (below, "BELOW_UNCERTAINTY"), (F.col("at_edge"), "ADJOINS_EDGE"))))
    )
    artifact = F.col("on_seam") | mostly
    if offshore:
        steep_round = (F.col("circularity") >= 0.7) & (F.col("depth_to_diameter") >= 0.15) & F.coalesce(F.col("wall_slope") >= 20.0, F.lit(False))
        kind = F.when(artifact, "SURVEY_ARTIFACT").when(steep_round, "BLUE_HOLE_CANDIDATE").otherwise("SEAFLOOR_DEPRESSION")
    else:
        square = (F.col("rectangularity") >= RECTANGULAR) & F.coalesce(F.col("flat_share") >= 0.5, F.lit(False))
        kind = F.when(artifact, "UNCLASSIFIED_ANOMALY").when(square, "SURFACE_EXCAVATION").when(F.lit(in_karst) & (F.col("circularity") >= 0.6), "SINKHOLE").otherwise("CLOSED_DEPRESSION")
    upto = lambda c, most: F.least(F.coalesce(c, F.lit(0.0)) / most, F.lit(1.0))
    score = 35 * upto(F.col("significance"), 10.0) + 25 * upto(F.col("depth_to_diameter"), 0.3) + 15 * F.col("circularity") + 10 * upto(F.col("wall_slope"), 35.0)
    score = score + F.when(F.col("at_edge") | F.col("beside_gap"), 0.0).otherwise(15.0)
    score = score * F.when(F.col("on_seam"), 0.25).otherwise(1.0) * F.when(mostly, 0.25).when(partly, 0.75).otherwise(1.0)
    tier = F.when(artifact | unknown | below, "CANDIDATE").otherwise("SUPPORTING")
    return found.withColumns({"flags": flags, "tier": tier, "proposed_class": kind, "score": F.round(F.greatest(F.lit(0.0), F.least(F.lit(100.0), score)), 2)})


def escarpments(cells: DataFrame, shape: Shape, dx: float, dy: float, min_slope: float, min_length: float, min_elongation: float = 3.0, origin: tuple[float, float] = (0.0, 0.0), tile: int = TILE) -> DataFrame:
    """Long steep bands: connected cells at least this steep whose ellipse is long and narrow enough.

    A band most of whose cells lie on a seam is a survey artefact.
    """
    if not 0 < min_slope < 90 or min_length <= 0:
        raise ValueError("the least slope lies between 0 and 90 degrees, and the least length is positive")
    lines = saved(seam_lines(seams(cells, shape, tile=tile), shape))
    by = lambda axis, name: lines.where(F.col("axis") == axis).select(F.col("line").alias(name), F.lit(1.0).alias(f"on_{name}"))
    marked = cells.select("row", "col", "value").join(by("column", "col"), "col", "left").join(by("row", "row"), "row", "left")
    marked = marked.select("row", "col", "value", F.greatest(F.coalesce("on_col", F.lit(0.0)), F.coalesce("on_row", F.lit(0.0))).alias("seam"))
    found, _ = regions(marked, shape, dx, dy, min_slope, tile=tile)
    cell = math.sqrt(dx * dy)
    long, short = axes()
    sized = found.withColumns({"length": long * cell, "width": F.greatest(short * cell, F.lit(cell))}).where((F.col("length") >= min_length) & (F.col("length") / F.col("width") >= min_elongation))
    seam, relief, mean = F.col("n_seam") / F.col("n") > 0.5, F.col("high") - F.col("low"), F.col("slopes") / F.col("n_slopes")
    score = F.round(F.least(F.lit(100.0), 40 * F.least(relief / 50.0, F.lit(1.0)) + 30 * F.least(mean / 45.0, F.lit(1.0))), 2)
    return sized.select(
        "label",
        F.col("n").alias("n_cells"),
        (F.lit(origin[0]) + (F.col("cols") / F.col("n") + 0.5) * dx).alias("centre_x"),
        (F.lit(origin[1]) - (F.col("rows") / F.col("n") + 0.5) * dy).alias("centre_y"),
        "length",
        "width",
        relief.alias("relief"),
        mean.alias("mean_slope"),
        seam.alias("on_seam"),
        F.when(seam, "SURVEY_ARTIFACT").otherwise("ESCARPMENT").alias("proposed_class"),
        F.when(seam, "CANDIDATE").otherwise("SUPPORTING").alias("tier"),
        score.alias("score"),
    )
