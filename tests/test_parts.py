"""Points and lines against areas by exact fractions, distances to parts, typed coordinates and the conic projection."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from terravane.functions import coordinates as C
from terravane.operators import parts as P

EDGE = "ax double, ay double, bx double, by double"


def ring(*places):
    return [(*a, *b) for a, b in zip(places, (*places[1:], places[0]), strict=True)]


def where(x, y, edges):
    """1 inside, 0 on the outline, -1 outside."""
    inside = False
    for ax, ay, bx, by in edges:
        if (bx - ax) * (y - ay) == (by - ay) * (x - ax) and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
            return 0
        if (ay > y) != (by > y) and x < ax + Fraction((y - ay) * (bx - ax), 1) / (by - ay):
            inside = not inside
    return 1 if inside else -1


def meetings(e, edges):
    ax, ay, bx, by = e
    out = set()
    for px, py, qx, qy in edges:
        d = (bx - ax) * (qy - py) - (by - ay) * (qx - px)
        if d:
            t, u = Fraction((px - ax) * (qy - py) - (py - ay) * (qx - px), d), Fraction((px - ax) * (by - ay) - (py - ay) * (bx - ax), d)
            if 0 <= t <= 1 and 0 <= u <= 1:
                out.add(t)
        elif (bx - ax) * (py - ay) == (by - ay) * (px - ax):
            long = (bx - ax) ** 2 + (by - ay) ** 2
            out |= {t for x, y in ((px, py), (qx, qy)) if 0 <= (t := Fraction((x - ax) * (bx - ax) + (y - ay) * (by - ay), long)) <= 1}
    return out


def plain_relation(kind, rows, edges):
    """None without a common place, else the parts of the feature that lie inside, on and outside."""
    seen = set()
    for ax, ay, bx, by in rows:
        if kind == "point":
            seen.add(where(ax, ay, edges))
        else:
            cuts = sorted(meetings((ax, ay, bx, by), edges) | {Fraction(0), Fraction(1)})
            seen |= {where(ax + t * (bx - ax), ay + t * (by - ay), edges) for t in cuts} - {-1}
            seen |= {where(ax + (s + t) / 2 * (bx - ax), ay + (s + t) / 2 * (by - ay), edges) for s, t in zip(cuts, cuts[1:], strict=False)}
    return seen if seen - {-1} else None


@pytest.fixture(scope="module")
def scene(spark):
    rng = random.Random(7)
    areas = {
        1: ring((0, 0), (10, 0), (10, 10), (0, 10)) + ring((3, 3), (3, 6), (6, 6), (6, 3)),
        2: ring((12, 2), (18, 2), (15, 9)),
        3: ring((4, 12), (9, 12), (9, 18), (7, 14), (4, 18)),
        4: ring((20, 0), (22, 0), (22, 2), (20, 2)) + ring((22, 2), (24, 2), (24, 4), (22, 4)),
    }
    features = {}
    for i in range(160):
        n = rng.randrange(1, 4)
        spots = [(rng.randrange(-1, 26), rng.randrange(-1, 20)) for _ in range(n + 1)]
        kind = "line" if i % 3 else "point"
        rows = [(*a, *b) for a, b in zip(spots, spots[1:], strict=False) if a != b] if kind == "line" else [(*p, None, None) for p in spots]
        if rows:
            features[i] = (kind, rows)
    features[500] = ("line", [(0, 0, 10, 0)])
    features[501] = ("line", [(3, 3, 6, 3), (6, 3, 6, 6)])
    features[502] = ("line", [(1, 1, 2, 2)])
    features[503] = ("line", [(0, 5, 10, 5)])
    features[504] = ("line", [(20, 2, 24, 2)])
    f = spark.createDataFrame([(k, kind, *(None if v is None else float(v) for v in r)) for k, (kind, rows) in features.items() for r in rows], f"feature_id long, kind string, {EDGE}")
    a = spark.createDataFrame([(k, *map(float, e)) for k, edges in areas.items() for e in edges], f"area_id long, {EDGE}")
    return features, areas, f, a


def test_lines_and_points_equal_exact_fractions(scene):
    features, areas, f, a = scene
    want = {}
    for k, (kind, rows) in features.items():
        for m, edges in areas.items():
            seen = plain_relation(kind, rows, edges)
            if seen is not None:
                want[k, m] = (1 in seen and -1 not in seen, 1 not in seen, 1 in seen and -1 in seen)
    for cell in (1.0, 7.0):
        got = {(r["feature_id"], r["area_id"]): (r["within"], r["touches"], r["crosses"]) for r in P.line_relations(f, a, cell).collect()}
        assert got == want
    assert {tuple(v) for v in want.values()} == {(True, False, False), (False, True, False), (False, False, True)}
    assert {tuple(r) for r in P.intersecting(f, a, 3.0).collect()} == set(want)


def test_polygons_and_mixed_features(spark, scene):
    a = scene[3]
    around, inside, hole, beside = ring((-5, -5), (40, -5), (40, 30), (-5, 30)), ring((1, 1), (2, 1), (2, 2)), ring((4, 4), (5, 4), (5, 5)), ring((30, 30), (31, 30), (31, 31))
    rows = [(k, "polygon", *map(float, e)) for k, edges in enumerate((around, inside, hole, beside)) for e in edges] + [(9, "point", 13.0, 3.0, None, None), (9, "line", 30.0, 0.0, 31.0, 0.0), (10, "odd", 1.0, 1.0, None, None), (11, "line", 1.0, None, 2.0, 2.0)]
    f = spark.createDataFrame(rows, f"feature_id long, kind string, {EDGE}")
    assert {tuple(r) for r in P.intersecting(f, a, 5.0).collect()} == {(0, 1), (0, 2), (0, 3), (0, 4), (1, 1), (9, 2)}
    assert P.intersecting(f.limit(0), a).count() == 0 and P.line_relations(f, a.limit(0)).count() == 0


def test_distance_to_parts(spark):
    edges = ring((-66.0, 18.0), (-65.9, 18.0), (-65.9, 18.1), (-66.0, 18.1)) + ring((-65.96, 18.04), (-65.94, 18.04), (-65.94, 18.06), (-65.96, 18.06))
    rows = [(1, "polygon", *e) for e in edges] + [(2, "line", -66.0, 18.2, -65.8, 18.2), (3, "point", -65.95, 18.05, None, None), (4, "point", -60.0, 18.0, None, None), (4, "line", -65.99, 18.0, -65.99, 18.0)]
    f = spark.createDataFrame(rows, f"feature_id long, kind string, {EDGE}")
    centres = spark.createDataFrame([(1, -65.98, 18.02), (2, -65.95, 18.05), (3, -65.95, 18.15), (4, None, 18.0)], "id long, lon double, lat double")
    got = {(r["id"], r["feature_id"]): r["distance_m"] for r in P.within_metres(centres, f, 9_000.0).collect()}
    degree = math.pi / 180 * 6371008.8
    assert got[1, 1] == 0.0 and got[2, 3] == 0.0
    # The second centre lies in the hole, a hundredth of a degree from its sides.
    assert got[2, 1] == pytest.approx(0.01 * degree * math.cos(math.radians(18.05)), rel=1e-6)
    assert got[3, 1] == pytest.approx(0.05 * degree, rel=1e-9) and got[3, 2] == pytest.approx(0.05 * degree, rel=1e-9)
    assert got[1, 4] == pytest.approx(math.hypot(0.01 * degree * math.cos(math.radians(18.02)), 0.02 * degree), rel=1e-6)
    assert set(got) == {(1, 1), (1, 3), (1, 4), (2, 1), (2, 3), (2, 4), (3, 1), (3, 2)}


def test_typed_coordinates(spark):
    cases = {
        "18.5, -66.1": (-66.1, 18.5), "-66.1 18.5": (-66.1, 18.5), " 18.5;-66.1 ": (-66.1, 18.5), "40.0, -3.7": (-3.7, 40.0), "100 20": (100.0, 20.0), "95, 100": None, "18.5": None, "": None, None: None, "a, b": None,
        "18°28'20\"N 66°42'56\"W": (-(66 + 42 / 60 + 56 / 3600), 18 + 28 / 60 + 20 / 3600), "66d42m56sW, 18d28m20sN": (-(66 + 42 / 60 + 56 / 3600), 18 + 28 / 60 + 20 / 3600), "18°30'N 66°W": (-66.0, 18.5), "18°N 19°N": None, "95°N 66°W": None, "18.5, -66.1" + " " * 80: (-66.1, 18.5), "1" * 65: None,
    }
    rows = spark.createDataFrame(list(enumerate(cases)), "k long, t string").select("k", C.parse_coordinates(F.col("t")).alias("p")).orderBy("k").collect()
    for r, (text, want) in zip(rows, cases.items(), strict=True):
        if want is None:
            assert r["p"] is None, text
        else:
            assert (r["p"]["lon"], r["p"]["lat"]) == pytest.approx(want, abs=1e-12), text


def test_conic_projection_at_the_published_point_and_back(spark):
    # The example of EPSG guidance note 7-2 for this method, in US survey feet.
    texas = C.ConformalConic(28 + 23 / 60, 30 + 17 / 60, 27 + 50 / 60, -99.0, 2_000_000.0, 0.0, 20_925_832.16, 294.97870)
    one = spark.range(1)
    r = one.select(texas.forward(F.lit(-96.0), F.lit(28.5)).alias("p"), texas.inverse(F.lit(2_963_503.91), F.lit(254_759.80)).alias("q")).first()
    assert (r["p"]["x"], r["p"]["y"]) == pytest.approx((2_963_503.91, 254_759.80), abs=0.006)
    assert (r["q"]["lon"], r["q"]["lat"]) == pytest.approx((-96.0, 28.5), abs=3e-8)
    conic = C.ConformalConic()
    origin = one.select(conic.forward(F.lit(-(66 + 26 / 60)), F.lit(17 + 50 / 60)).alias("p")).first()["p"]
    assert (origin["x"], origin["y"]) == pytest.approx((200_000.0, 200_000.0), abs=1e-6)
    grid = spark.range(400).select((F.lit(-68.5) + F.col("id") % 20 * 0.2).alias("lon"), (F.lit(17.5) + F.floor(F.col("id") / 20) * 0.08).alias("lat"))
    back = grid.withColumn("p", conic.forward(F.col("lon"), F.col("lat"))).withColumn("q", conic.inverse(F.col("p.x"), F.col("p.y")))
    worst = back.agg(F.max(F.greatest(F.abs(F.col("q.lon") - F.col("lon")), F.abs(F.col("q.lat") - F.col("lat"))))).first()[0]
    assert worst < 1e-12 * 100
    s = one.select(C.snapped(F.lit(105.00001), 0.0, 10.0, 0.001).alias("a"), C.snapped(F.lit(110.0004), 0.0, 10.0, 0.001).alias("b")).first()
    assert s["a"]["value"] == 105.00001 and not s["a"]["snap"] and s["b"]["value"] == 110.0 and s["b"]["snap"]
