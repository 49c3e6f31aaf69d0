"""Shares in cells against clipping by half planes, and scores against answers worked out by hand."""

import math
import random

import pytest

from terravane.operators import grids


def clipped(ring, x0, y0, x1, y1):
    for axis, bound, sign in ((0, x0, 1), (0, x1, -1), (1, y0, 1), (1, y1, -1)):
        out = []
        for p, q in zip(ring, ring[1:] + ring[:1], strict=True):
            a, b = sign * (p[axis] - bound), sign * (q[axis] - bound)
            if a >= 0:
                out.append(p)
            if (a < 0) != (b < 0):
                t = a / (a - b)
                out.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
        ring = out
    return abs(sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(ring, ring[1:] + ring[:1], strict=True))) / 2 if ring else 0.0


def test_polygons_in_cells(spark):
    rng = random.Random(2)
    edges, want = [], {}
    for k in range(25):
        cx, cy, n = rng.uniform(2, 18), rng.uniform(2, 18), rng.randint(3, 9)
        outer = [(cx + rng.uniform(2, 4) * math.cos(2 * math.pi * i / n), cy + rng.uniform(2, 4) * math.sin(2 * math.pi * i / n)) for i in range(n)]
        hole = [(cx + 0.2 * x, cy + 0.2 * y) for x, y in ((-1, -1), (-1, 1), (1, 1), (1, -1))]
        for r, ring in ((0, outer), (1, hole)):
            edges += [(k, r, *p, *q) for p, q in zip(ring, ring[1:] + ring[:1], strict=True)]
        for i in range(20):
            for j in range(20):
                # The loop clips concave rings too: what it adds along a border has no area.
                v = clipped(outer, i, j, i + 1, j + 1) - clipped(hole, i, j, i + 1, j + 1)
                if v > grids.EPSILON:
                    want[k, i, j] = v
    got = grids.polygons_in_cells(spark.createDataFrame(edges, "polygon_id long, ring int, x1 double, y1 double, x2 double, y2 double"), 1.0, 20, 20).collect()
    assert {(r["polygon_id"], r["col"], r["row"]): r["area"] for r in got} == pytest.approx(want, abs=1e-9)


def test_lines_on_edges_belong_to_both_sides(spark):
    rows = [(1, 0.0, 1.0, 2.0, 1.0), (2, 0.5, 0.5, 1.5, 1.5), (3, 1.0, 1.0, 1.0, 1.0), (4, None, 0.0, 1.0, 1.0), (5, -9.0, -9.0, -5.0, -5.0)]
    got = grids.lines_in_cells(spark.createDataFrame(rows, "line_id long, x1 double, y1 double, x2 double, y2 double"), 1.0, 3, 3).collect()
    found = {(r["line_id"], r["col"], r["row"]): r["length"] for r in got}
    h = math.sqrt(0.5)
    assert found == pytest.approx({(1, 0, 0): 1.0, (1, 1, 0): 1.0, (1, 0, 1): 1.0, (1, 1, 1): 1.0, (2, 0, 0): h, (2, 1, 1): h})


def test_scores_by_hand(spark):
    # 2 nodes: 10 + 2 roles 15 + 2 domains 12 + 1 function 4 + T2 10 - 1 contradiction 10 = 41. A lone T1 with all: 5+7.5+6+4+15 = 37.5, held to 29.
    rows = [("a", "x", "d", "f", "T2", 1), ("a", "y", "e", "f", "T4", None), ("b", "x", "d", "f", "T1", 0), ("c", None, "", None, None, 9)]
    got = {r["cluster"]: r["score"] for r in grids.group_scores(spark.createDataFrame(rows, "cluster string, role string, domain string, function string, tier string, contradictions int")).collect()}
    assert got == {"a": 41.0, "b": 29.0, "c": 0.0}
    # 5 nodes, 4 roles, 3 domains, 3 functions, T3: 25 + 30 + 18 + 12 + 5 = 90, held to 84 without a good tier.
    rows = [("d", f"r{i % 4}", f"d{i % 3}", f"f{i % 3}", "T3", 0) for i in range(5)]
    assert grids.group_scores(spark.createDataFrame(rows, "cluster string, role string, domain string, function string, tier string, contradictions int")).first()["score"] == 84.0


def test_sites_and_sets(spark):
    o = spark.createDataFrame([(1, " a ", "confirmed"), (1, "b", "confirmed"), (1, "b", "pending"), (2, "z", "confirmed"), (3, None, None)], "site long, factor string, status string")
    r = spark.createDataFrame([("a", 3), ("b", 5)], "factor string, delta long")
    assert {x["site"]: (x["score"], x["class"][:4]) for x in grids.site_confidence(o, r).collect()} == {1: (8, "high"), 2: (0, "low-"), 3: (0, "low-")}
    cells = spark.createDataFrame([(1, i, j) for i in range(3) for j in range(3)] * 2, "set_id long, row long, col long")
    assert [(x["row"], x["col"]) for x in grids.edge_of_set(cells).where("interior").collect()] == [(1, 1)] and grids.edge_of_set(cells).count() == 9
    assert grids.widen_set(cells.where("row = 0 and col = 0"), 1, 2, 5, 5).count() == 6
