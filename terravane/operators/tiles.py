"""Rasters over tiles that know of one another: what a tile cannot settle alone is settled in groups of tiles, level by level.

A tile hands on only its rim: cells on its border with a label, and a small graph of labels. A group of FAN x FAN tiles
joins the rims of its members, settles what lies inside, and hands on its own rim, until one group covers the raster.
Levels grow with the logarithm of the raster's side; a group holds the rims of its members and never their cells. Results
flow back down by joins on labels. The scheme follows the published parallel priority-flood (Barnes, 2016), with
Boruvka's rounds in place of a queue, so that numpy can take whole rounds at once.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import saved

Shape = tuple[int, int]
FAN = 8
#: The label of what lies beyond the border or in a gap.
OUTSIDE = -1
#: kind: a cell of a rim, an edge between labels, or a label that is settled (u, its owner v, at w).
RIM, EDGE, SETTLED = 0, 1, 2
_FRONT = "tr long, tc long, kind int, row long, col long, u long, v long, w double"
_STEPS = ((0, 1), (1, 0), (1, 1), (1, -1))


def dealt(cells: DataFrame, shape: Shape, tile: int, halo: int, *columns: str) -> DataFrame:
    """Cells of the raster, copied to every tile (tr, tc) in whose halo they lie."""
    last = [(n - 1) // tile for n in shape]

    def near(c: str, top: int) -> F.Column:
        return F.sequence(F.greatest(F.lit(0), F.floor((F.col(c) - halo) / tile)), F.least(F.lit(top), F.floor((F.col(c) + halo) / tile)))

    inside = cells.where(F.col("row").between(0, shape[0] - 1) & F.col("col").between(0, shape[1] - 1))
    spread = inside.select("row", "col", *columns, F.explode(near("row", last[0])).alias("tr"), near("col", last[1]).alias("tcs"))
    return spread.select("row", "col", *columns, "tr", F.explode("tcs").alias("tc"))


def grid_of(part: pd.DataFrame, key: tuple, tile: int, halo: int, column: str) -> np.ndarray:
    """One column of a tile's cells as a padded array, NaN where nothing is."""
    a = np.full((tile + 2 * halo,) * 2, np.nan)
    a[part["row"].to_numpy() - (int(key[0]) * tile - halo), part["col"].to_numpy() - (int(key[1]) * tile - halo)] = part[column].to_numpy(dtype=float, na_value=np.nan)
    return a


def pairs(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries of a at both ends of every step to one of eight neighbours, each pair once."""
    left, right = [], []
    h, w = a.shape
    for i, j in _STEPS:
        left.append(a[: h - i, max(0, -j) : w - max(0, j)].ravel())
        right.append(a[i:, max(0, j) : w - max(0, -j)].ravel())
    return np.concatenate(left), np.concatenate(right)


def joined(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The least index reachable from each of n nodes over undirected edges."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        while not np.array_equal(nxt := new[new], new):
            new = nxt
        if np.array_equal(new, label):
            return label
        label = new


def settle(n: int, u: np.ndarray, v: np.ndarray, w: np.ndarray, fixed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of n nodes the fixed node it drains to, and the lowest level at which it does.

    An edge is a pass of height w. In each round every group of nodes that holds no fixed one goes over its lowest pass
    (the first in order of height), which raises all its nodes to that height at least; groups that choose one
    another, or a chain of others, become one. Fixed nodes drain to themselves at minus infinity.
    """
    order = np.argsort(w, kind="stable")
    u, v, w = u[order], v[order], w[order]
    group, level = np.arange(n), np.full(n, -np.inf)
    stop = fixed.copy()
    while True:
        gu, gv = group[u], group[v]
        live = (gu != gv) & ~(stop[gu] & stop[gv])
        u, v, w = u[live], v[live], w[live]
        if not len(u):
            return group, level
        src, dst = np.stack([gu[live], gv[live]], axis=1).ravel(), np.stack([gv[live], gu[live]], axis=1).ravel()
        can = np.flatnonzero(~stop[src])
        first = np.full(n, -1)
        first[src[can][::-1]] = can[::-1]  # of several the last written stays, which is the lowest pass
        some = np.flatnonzero(first >= 0)
        to, height = np.arange(n), np.full(n, -np.inf)
        to[some], height[some] = dst[first[some]], w[first[some] // 2]
        mutual = some[(to[to[some]] == some) & (some < to[some])]
        to[mutual] = mutual
        level = np.maximum(level, height[group])
        while not np.array_equal(nxt := to[to], to):
            to = nxt
        group = to[group]


def least_edges(u: np.ndarray, v: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The lowest edge between every two different nodes."""
    some = u != v
    a, b, w = np.minimum(u, v)[some], np.maximum(u, v)[some], w[some]
    order = np.lexsort((w, b, a))
    a, b, w = a[order], b[order], w[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new], w[new]


def front(kind: int, **columns) -> pd.DataFrame:
    """Rows to hand on; what is not given is null."""
    n = max((len(c) for c in columns.values()), default=0)
    out = {}
    for c in ("row", "col", "u", "v"):
        out[c] = pd.array(np.asarray(columns[c]), "Int64") if c in columns else pd.array([None] * n, "Int64")
    return pd.DataFrame({"kind": np.full(n, kind, np.int32), **out, "w": np.asarray(columns.get("w", np.zeros(n)), float)})


def _meetings(rim: pd.DataFrame, wide: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in rim of neighbouring cells of different tiles."""
    row, col = rim["row"].to_numpy(np.int64), rim["col"].to_numpy(np.int64)
    tr, tc = rim["tr"].to_numpy(np.int64), rim["tc"].to_numpy(np.int64)
    key = row * wide + col
    order = np.argsort(key)
    a, b = [], []
    for i, j in _STEPS:
        at = np.minimum(np.searchsorted(key[order], key + i * wide + j), max(len(key) - 1, 0))
        other = order[at] if len(key) else at
        hit = np.flatnonzero((key[other] == key + i * wide + j) & (col + j >= 0) & (col + j < wide) & ((tr != tr[other]) | (tc != tc[other])))
        a.append(hit)
        b.append(other[hit])
    return np.concatenate(a), np.concatenate(b)


Merge = Callable[[pd.DataFrame, pd.DataFrame, np.ndarray, np.ndarray, np.ndarray], pd.DataFrame]


def upward(fronts: DataFrame, shape: Shape, tile: int, merge: Merge) -> list[DataFrame]:
    """The settled rows (u, v, w) of every level, the lowest first.

    merge gets the rim cells and the edges of a group, the positions of rim cells that meet, and which rim cells lie on the
    group's own rim; it returns rows as front() makes them.
    """

    def grouped(side: int, top: bool):
        def group(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
            rim, edges = part[part["kind"] == RIM].reset_index(drop=True), part[part["kind"] == EDGE]
            a, b = _meetings(rim, shape[1])
            r, c = rim["row"].to_numpy(np.int64) - int(key[0]) * side, rim["col"].to_numpy(np.int64) - int(key[1]) * side
            outer = np.zeros(len(rim), bool) if top else (r == 0) | (c == 0) | (r == side - 1) | (c == side - 1)
            return merge(rim, edges, a, b, outer).assign(tr=int(key[0]), tc=int(key[1]))[["tr", "tc", "kind", "row", "col", "u", "v", "w"]]

        return group

    levels, side, top = [], tile, False
    while not top:
        side *= FAN
        top = side >= max(shape)
        keys = [F.floor(F.col("tr") / FAN).alias("up_r"), F.floor(F.col("tc") / FAN).alias("up_c")]
        done = saved(fronts.groupBy(*keys).applyInPandas(grouped(side, top), _FRONT))
        levels.append(done.where(F.col("kind") == SETTLED).select("u", "v", "w"))
        fronts = done.where(F.col("kind") != SETTLED)
    return levels


def merge_passes(rim: pd.DataFrame, edges: pd.DataFrame, a: np.ndarray, b: np.ndarray, outer: np.ndarray) -> pd.DataFrame:
    """For upward(): labels settle at the lowest pass to the group's rim or outside."""
    label, w = rim["u"].to_numpy(np.int64), rim["w"].to_numpy(float)
    u = np.concatenate([edges["u"].to_numpy(np.int64), label[a]])
    v = np.concatenate([edges["v"].to_numpy(np.int64), label[b]])
    high = np.concatenate([edges["w"].to_numpy(float), np.maximum(w[a], w[b])])
    names = np.unique(np.concatenate([[OUTSIDE], label, u, v]))
    at = lambda x: np.searchsorted(names, x)
    fixed = np.zeros(len(names), bool)
    fixed[at(label[outer])] = True
    fixed[0] = True
    owner, level = settle(len(names), at(u), at(v), high, fixed)
    free = np.flatnonzero(~fixed)
    x, y, z = least_edges(owner[at(u)], owner[at(v)], np.maximum(high, np.maximum(level[at(u)], level[at(v)])))
    kept = rim[outer]
    return pd.concat(
        [
            front(SETTLED, u=names[free], v=names[owner[free]], w=level[free]),
            front(EDGE, u=names[x], v=names[y], w=z),
            front(RIM, row=kept["row"], col=kept["col"], u=kept["u"], w=kept["w"]),
        ]
    )


def merge_labels(rim: pd.DataFrame, edges: pd.DataFrame, a: np.ndarray, b: np.ndarray, outer: np.ndarray) -> pd.DataFrame:
    """For upward(): labels of cells that meet are one, under the least of them."""
    names, at = np.unique(rim["u"].to_numpy(np.int64), return_inverse=True)
    root = joined(len(names), at[a], at[b])
    moved = np.flatnonzero(root != np.arange(len(names)))
    kept = rim[outer]
    return pd.concat([front(SETTLED, u=names[moved], v=names[root[moved]]), front(RIM, row=kept["row"], col=kept["col"], u=names[root[at[outer]]])])


def levels_of(settled: list[DataFrame]) -> DataFrame:
    """label and level (the lowest one at which it drains outside) of all settled labels."""
    known = None
    for part in reversed(settled):
        mine = part.select(F.col("u").alias("label"), F.col("v").alias("owner"), F.col("w").alias("level"))
        if known is not None:
            above = known.select(F.col("label").alias("owner"), F.col("level").alias("higher"))
            mine = mine.join(above, "owner", "left").select("label", "owner", F.greatest("level", F.coalesce("higher", "level")).alias("level"))
        mine = mine.select("label", "level")
        known = mine if known is None else known.unionByName(mine)
    return known


def roots_of(settled: list[DataFrame]) -> DataFrame:
    """label and root of all labels that are not their own root."""
    known = None
    for part in reversed(settled):
        mine = part.select(F.col("u").alias("label"), F.col("v").alias("root"))
        if known is not None:
            above = known.select(F.col("label").alias("root"), F.col("root").alias("higher"))
            mine = mine.join(above, "root", "left").select("label", F.coalesce("higher", "root").alias("root"))
        known = mine if known is None else known.unionByName(mine)
    return known
