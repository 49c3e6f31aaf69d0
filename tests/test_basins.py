"""Filling, regions, seams and steep bands against plain versions, whatever the tiles."""

import heapq
import math

import numpy as np
import pytest

from terravane.operators import basins
from terravane.operators import tiles as T

NEAR = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1) if (i, j) != (0, 0)]


def frame(spark, z, **more):
    rows = [(r, c, float(z[r, c]) if np.isfinite(z[r, c]) else None, *(float(a[r, c]) for a in more.values())) for r in range(z.shape[0]) for c in range(z.shape[1])]
    return spark.createDataFrame(rows, ", ".join(["row long", "col long", "value double", *(f"{n} double" for n in more)]))


def plain_fill(z):
    h, w = z.shape
    out, heap = np.full(z.shape, np.inf), []
    for r in range(h):
        for c in range(w):
            if np.isfinite(z[r, c]) and any(not (0 <= r + i < h and 0 <= c + j < w) or not np.isfinite(z[r + i, c + j]) for i, j in NEAR):
                out[r, c] = z[r, c]
                heapq.heappush(heap, (z[r, c], r, c))
    while heap:
        level, r, c = heapq.heappop(heap)
        for i, j in NEAR:
            y, x = r + i, c + j
            if 0 <= y < h and 0 <= x < w and np.isfinite(z[y, x]) and not np.isfinite(out[y, x]):
                out[y, x] = max(level, z[y, x])
                heapq.heappush(heap, (out[y, x], y, x))
    return np.where(np.isfinite(z), out, np.nan)


def plain_regions(mask):
    seen, out = np.zeros(mask.shape, bool), []
    for r, c in zip(*np.nonzero(mask), strict=True):
        if seen[r, c]:
            continue
        seen[r, c], front, own = True, [(r, c)], []
        while front:
            y, x = front.pop()
            own.append((int(y), int(x)))
            for i, j in NEAR:
                a, b = y + i, x + j
                if 0 <= a < mask.shape[0] and 0 <= b < mask.shape[1] and mask[a, b] and not seen[a, b]:
                    seen[a, b] = True
                    front.append((a, b))
        out.append(sorted(own))
    return out


def surfaces():
    rng = np.random.default_rng(3)
    smooth = rng.standard_normal((64, 64)).cumsum(0).cumsum(1) * 0.1
    noise = rng.integers(0, 9, (64, 64)).astype(float)
    gaps = np.where(rng.random((64, 64)) < 0.05, np.nan, rng.standard_normal((64, 64)))
    spiral = np.zeros((41, 57))
    spiral[1:-1, 1:-1] = 5.0
    spiral[3:-3, 3] = spiral[-4, 3:-3] = spiral[3:-3, -4] = spiral[3, 8:-3] = spiral[3:20, 8] = -3.0
    return {"smooth": smooth, "noise": noise, "gaps": gaps, "spiral": spiral}


def got_fill(spark, z, tile):
    out = np.full(z.shape, np.nan)
    for r in basins.fill(frame(spark, z), z.shape, tile).collect():
        out[r["row"], r["col"]] = r["filled"]
        assert r["depth"] == r["filled"] - r["value"]
    return out


@pytest.mark.parametrize("name", ["smooth", "noise", "gaps", "spiral"])
def test_fill_equals_a_plain_flood(spark, monkeypatch, name):
    z = surfaces()[name]
    want = plain_fill(z)
    monkeypatch.setattr(T, "FAN", 2)
    for tile in (7, 16, 64):
        assert np.array_equal(got_fill(spark, z, tile), want, equal_nan=True), tile


def test_fill_of_odd_rasters(spark):
    assert basins.fill(spark.createDataFrame([], "row long, col long, value double"), (5, 5), 4).count() == 0
    assert [tuple(r) for r in basins.fill(spark.createDataFrame([(2, 3, 1.5)], "row long, col long, value double"), (5, 5), 4).collect()] == [(2, 3, 1.5, 1.5, 0.0)]
    assert basins.fill(spark.createDataFrame([(0, 0, None), (1, 1, float("nan"))], "row long, col long, value double"), (5, 5), 4).count() == 0


def test_settle_equals_least_greatest_passes():
    rng = np.random.default_rng(9)
    for _ in range(30):
        n = 25
        u, v, w = rng.integers(0, n, 60), rng.integers(0, n, 60), rng.integers(0, 12, 60).astype(float)
        fixed = rng.random(n) < 0.15
        owner, level = T.settle(n, u, v, w, fixed)
        best = np.where(fixed, -np.inf, np.inf)
        for _ in range(n):
            for a, b, c in zip(u, v, w, strict=True):
                for x, y in ((a, b), (b, a)):
                    if not fixed[x]:
                        best[x] = min(best[x], max(c, best[y]))
        reached = np.isfinite(best) | fixed
        assert np.array_equal(level[reached], best[reached]) and fixed[owner[reached]].all() and not fixed[owner[~reached]].any()


def bowls():
    """Two bowls, a box with a flat floor and a pit of one cell on tilted ground."""
    r, c = np.mgrid[0:70, 0:90].astype(float)
    z = 20 + 0.01 * c
    for y, x, radius, deep in ((20, 25, 9, 4.0), (48, 60, 12, 7.0)):
        d = np.hypot(r - y, c - x)
        z = np.where(d < radius, z - deep * (1 - (d / radius) ** 2), z)
    z[45:60, 10:28] = 15.0
    z[5, 80] = 11.0
    return z


def plain_measures(z, dx, dy, min_depth, min_area):
    depth = np.nan_to_num(plain_fill(z) - z)
    out = {}
    for own in plain_regions(depth > 1e-6):
        r, c = np.array(own).T
        d = depth[r, c]
        if d.max() < min_depth or len(own) * dx * dy < min_area:
            continue
        image = np.zeros((r.max() - r.min() + 3, c.max() - c.min() + 3), int)
        image[r - r.min() + 1, c - c.min() + 1] = 1
        up, left, corner = (np.zeros_like(image) for _ in range(3))
        up[1:], left[:, 1:], corner[1:, 1:] = image[:-1], image[:, :-1], image[:-1, :-1]
        outline = basins.CROFTON[image + 2 * up + 4 * left + 8 * corner].sum() if len(own) > 1 else 4.0
        area, around = len(own) * dx * dy, outline * math.sqrt(dx * dy)
        cov = np.cov(np.stack([r, c]), bias=True) if len(own) > 1 else np.zeros((2, 2))
        short, long = (4 * math.sqrt(max(e, 0)) or 1.0 for e in np.linalg.eigvalsh(cov))
        first = min((-d[k], own[k]) for k in range(len(own)))[1]
        out[int(r[0]) * z.shape[1] + int(c[0])] = {
            "n_cells": len(own), "max_depth": d.max(), "mean_depth": d.mean(), "volume": d.sum() * dx * dy, "floor": z[first], "spill": z[first] + depth[first],
            "centre_x": (c.mean() + 0.5) * dx, "centre_y": -(r.mean() + 0.5) * dy, "circularity": min(1.0, 4 * math.pi * area / around**2), "elongation": long / short,
            "rectangularity": len(own) / ((r.max() - r.min() + 1) * (c.max() - c.min() + 1)), "r1": r.max(), "c1": c.max(), "deepest_x": (first[1] + 0.5) * dx,
        }
    return out


@pytest.mark.parametrize("tile", [16, 32, 128])
def test_depressions_equal_plain_measures(spark, monkeypatch, tile):
    monkeypatch.setattr(T, "FAN", 2)
    z = bowls()
    want = plain_measures(z, 2.0, 3.0, 0.5, 5.0)
    got = {r["label"]: r for r in basins.depressions(frame(spark, z), z.shape, 2.0, 3.0, 0.5, 5.0, tile=tile).collect()}
    assert set(got) == set(want) and len(want) == 4
    for k, w in want.items():
        for name, value in w.items():
            assert got[k][name] == pytest.approx(value, rel=1e-9, abs=1e-9), (k, name)
    box = got[45 * 90 + 10]
    assert box["solidity"] == 1.0 and box["rectangularity"] == 1.0 and box["flat_share"] > 0.5 and not box["at_edge"]
    assert box["significance"] is None and box["guessed_share"] is None


def test_hull_of_a_cross_and_of_a_line():
    r = np.array([0, 1, 2])
    # A plus of five cells: its hull of side midpoints is an octagon that holds no further centre.
    assert basins._hull_cells(r, np.array([1, 0, 1]), np.array([1, 2, 1])) == 5
    # An L of five cells spans a triangle whose diagonal passes through the middle cell.
    assert basins._hull_cells(r, np.array([0, 0, 0]), np.array([0, 0, 2])) == 6
    assert basins._hull_cells(np.array([4]), np.array([3]), np.array([9])) == 7


def test_uncertain_heights_and_guessed_cells(spark):
    z = bowls()
    sigma = np.full(z.shape, 0.5)
    sigma[:, :40] = np.nan
    guessed = np.zeros(z.shape)
    guessed[32:, 45:] = 1
    got = {r["label"]: r for r in basins.basin_detections(frame(spark, z, sigma=sigma, guessed=guessed), z.shape, 1.0, 1.0, 0.5, 5.0, tile=32).collect()}
    assert len(got) == 3  # the pit of one cell is too small
    big = next(r for r in got.values() if r["n_cells"] > 200 and r["c0"] > 40)
    assert big["guessed_share"] == 1.0 and big["depth_uncertainty"] == pytest.approx(math.sqrt(0.5)) and big["flags"] == ["MOSTLY_INTERPOLATED"]
    assert big["proposed_class"] == "UNCLASSIFIED_ANOMALY" and big["tier"] == "CANDIDATE"
    box = got[45 * 90 + 10]
    assert box["proposed_class"] == "SURFACE_EXCAVATION" and box["flags"] == ["UNCERTAINTY_UNKNOWN"]
    sea = {r["label"]: r["proposed_class"] for r in basins.basin_detections(frame(spark, z), z.shape, 1.0, 1.0, 0.5, 5.0, offshore=True, tile=32).collect()}
    assert set(sea.values()) == {"SEAFLOOR_DEPRESSION", "BLUE_HOLE_CANDIDATE"} and len(sea) == 3
    karst = basins.basin_detections(frame(spark, z), z.shape, 1.0, 1.0, 0.5, 5.0, in_karst=True, tile=32).collect()
    assert sorted(r["proposed_class"] for r in karst) == ["SINKHOLE", "SINKHOLE", "SURFACE_EXCAVATION"]


def plain_seams(z, threshold=8.0):
    out = []
    for name, d in (("column", np.diff(z, axis=1)), ("row", np.diff(z, axis=0).T)):
        n = np.isfinite(d).sum(axis=0)
        usable = [k for k in range(d.shape[1]) if n[k] >= max(3, math.ceil(0.5 * d.shape[0]))]
        if len(usable) < 5:
            continue
        med = {k: np.nanmedian(d[:, k]) for k in usable}
        centre = np.median(list(med.values()))
        scale = 1.4826 * np.median([abs(m - centre) for m in med.values()]) or np.std(list(med.values()))
        for k in usable if scale > 0 else []:
            sign = max((d[:, k] > 0).sum(), (d[:, k] < 0).sum()) / n[k]
            if abs(med[k] - centre) / scale >= threshold and sign >= 0.9:
                out.append((name, k, round(med[k], 9), round((med[k] - centre) / scale, 6), round(sign, 9), round(n[k] / d.shape[0], 9)))
    return sorted(out)


def test_seams_are_found_where_planted_and_not_in_noise(spark):
    rng = np.random.default_rng(6)
    z = rng.standard_normal((50, 60)) * 0.1
    assert basins.seams(frame(spark, z), z.shape, tile=16).count() == 0
    z[:, 31:] += 2.0
    z[20:] -= 3.0
    z[rng.random(z.shape) < 0.1] = np.nan
    want = plain_seams(z)
    for tile in (16, 64):
        got = sorted((r[0], r[1], *(round(x, p) for x, p in zip(r[2:], (9, 6, 9, 9), strict=True))) for r in map(tuple, basins.seams(frame(spark, z), z.shape, tile=tile).collect()))
        assert got == want and {g[:2] for g in got} == {("column", 30), ("row", 19)}
    lines = {tuple(r) for r in basins.seam_lines(basins.seams(frame(spark, z), z.shape, tile=16), z.shape).collect()}
    assert lines == {("column", 30), ("column", 31), ("row", 19), ("row", 20)}
    few = frame(spark, np.zeros((4, 4)))
    assert basins.seams(few, (4, 4)).count() == 0


def test_escarpments_are_the_same_for_all_tiles(spark, monkeypatch):
    monkeypatch.setattr(T, "FAN", 2)
    rng = np.random.default_rng(1)
    r, c = np.mgrid[0:80, 0:100].astype(float)
    z = np.where(c + 0.3 * r < 50, 0.0, np.where(c + 0.3 * r < 54, (c + 0.3 * r - 50) * 3, 12.0)) + rng.standard_normal(r.shape) * 0.01
    z[60:63, 5:8] += 4.0
    found = [sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in row) for row in basins.escarpments(frame(spark, z), z.shape, 1.0, 1.0, 30.0, 20.0, tile=t).collect()) for t in (16, 64, 128)]
    assert found[0] == found[1] == found[2] and len(found[0]) == 1
    ((label, n, *_),) = found[0]
    east, south = basins.gradients(np.pad(z, 1, mode="edge"), 1.0, 1.0)
    steep = plain_regions((np.degrees(np.arctan(np.hypot(east, south))) >= 30.0)[1:-1, 1:-1])
    assert (n, label) in {(len(own), own[0][0] * 100 + own[0][1]) for own in steep}
    with pytest.raises(ValueError):
        basins.escarpments(frame(spark, z), z.shape, 1.0, 1.0, 90.0, 20.0)


def test_hulls_are_taken_many_at_a_time(spark):
    lines = [(k, k + i, 3 * k - i, 3 * k + 2 * i) for k in range(40) for i in range(1 + k % 5)]
    found = basins.hulls(spark.createDataFrame(lines, "label long, row long, c_first long, c_last long"))
    want = {k: basins._hull_cells(*np.array([x[1:] for x in lines if x[0] == k]).T) for k in range(40)}
    assert {r["label"]: r["hull"] for r in found.collect()} == want
    assert "MapInPandas" in found._jdf.queryExecution().executedPlan().toString()
