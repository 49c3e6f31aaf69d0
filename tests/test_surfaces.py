"""Terrain, matching, evidence, distances, profiles and binary readers against plain versions and known answers."""

import io
import math
import random
import sqlite3
import struct
import zipfile

import numpy as np
import pytest

from terravane.functions import geodesy
from terravane.operators import evidence, matching, profiles, terrain
from terravane.sources import binary


def raster(spark, a):
    rows = [(i, j, None if math.isnan(v) else float(v)) for (i, j), v in np.ndenumerate(a)]
    return spark.createDataFrame(rows, "row long, col long, value double")


def grid(df, name, shape):
    out = np.full(shape, np.nan)
    for r in df.collect():
        out[r["row"], r["col"]] = np.nan if r[name] is None else r[name]
    return out


def holes(seed=3, shape=(19, 23), share=0.05):
    rng = np.random.default_rng(seed)
    a = rng.normal(0, 10, shape)
    a[rng.random(shape) < share] = np.nan
    return a


def plain_gradient(a, dx, dy):
    n, m = a.shape
    out = np.full((2, n, m), np.nan)
    k = [(-1, -1, -1, -1), (-1, 0, 0, -2), (-1, 1, 1, -1), (0, -1, -2, 0), (0, 1, 2, 0), (1, -1, -1, 1), (1, 0, 0, 2), (1, 1, 1, 1)]
    at = lambda i, j: a[min(max(i, 0), n - 1), min(max(j, 0), m - 1)]
    for i in range(n):
        for j in range(m):
            if any(math.isnan(at(i + p, j + q)) for p, q in ((0, 0), (1, 0), (-1, 0), (0, 1), (0, -1))):
                continue
            for d, (step, axis) in enumerate(((dx, 2), (dy, 3))):
                total = seen = 0.0
                for x in k:
                    v = at(i + x[0], j + x[1])
                    if not math.isnan(v):
                        total, seen = total + v * x[axis], seen + abs(x[axis])
                out[d, i, j] = total * 8 / seen / (8 * step)
    return out


@pytest.mark.parametrize("tile", [5, 8, 64])
def test_slope_beside_gaps_and_borders(spark, tile):
    a = holes()
    got = terrain.slope(raster(spark, a), a.shape, 3.0, 2.0, tile=tile)
    gx, gy = plain_gradient(a, 3.0, 2.0)
    np.testing.assert_allclose(grid(got, "dz_dx", a.shape), gx)
    np.testing.assert_allclose(grid(got, "dz_dy", a.shape), gy)
    np.testing.assert_allclose(grid(got, "area_ratio", a.shape), np.sqrt(1 + gx**2 + gy**2))


def test_roughness_relief_and_annulus_beside_gaps(spark):
    a = holes()
    n, m = a.shape
    rough, relief, ring = (np.full(a.shape, np.nan) for _ in range(3))
    for i in range(n):
        for j in range(m):
            if math.isnan(a[i, j]):
                continue
            near = [a[min(max(i + p, 0), n - 1), min(max(j + q, 0), m - 1)] for p in (-1, 0, 1) for q in (-1, 0, 1)]
            near = [v for v in near if not math.isnan(v)]
            rough[i, j] = np.std(near, ddof=1) if len(near) > 1 else 0.0
            box = a[max(i - 2, 0) : i + 3, max(j - 2, 0) : j + 3]
            relief[i, j] = np.nanmax(box) - np.nanmin(box)
            around = [a[p, q] for p in range(n) for q in range(m) if 1 <= (p - i) ** 2 + (q - j) ** 2 <= 9 and not math.isnan(a[p, q])]
            ring[i, j] = a[i, j] - np.mean(around)
    cells = raster(spark, a)
    np.testing.assert_allclose(grid(terrain.roughness(cells, a.shape, tile=7), "roughness", a.shape), rough)
    np.testing.assert_allclose(grid(terrain.relief(cells, a.shape, 2, tile=7), "relief", a.shape), relief)
    np.testing.assert_allclose(grid(terrain.annulus_index(cells, a.shape, 3, tile=7), "index", a.shape), ring)


def test_flat_and_empty_surfaces(spark):
    a = np.full((6, 6), 4.0)
    assert grid(terrain.ruggedness(raster(spark, a), a.shape, 1.0, 1.0), "ruggedness", a.shape).max() < 1e-12
    c = terrain.curvatures(raster(spark, a), a.shape, 1.0, 1.0)
    assert {(r["profile"], r["plan"], r["general"]) for r in c.collect()} == {(0.0, 0.0, 0.0)}
    assert terrain.slope(raster(spark, a).where("false"), a.shape, 1.0, 1.0).count() == 0
    with pytest.raises(ValueError):
        terrain.roughness(raster(spark, a), a.shape, 4)


def test_one_to_one_is_the_walk_by_distance(spark):
    rng = random.Random(5)
    d = [(i, "ab"[i % 2], float(rng.randrange(40)), float(rng.randrange(40))) for i in range(120)] + [(500, "a", None, 1.0)]
    lab = [(i, "ab"[i % 2], float(rng.randrange(40)), float(rng.randrange(40)), float(rng.randrange(1, 9))) for i in range(90)]
    pairs = sorted((math.hypot(x - u, y - v), i, j) for i, c, x, y in d if x is not None for j, k, u, v, r in lab if c == k and math.hypot(x - u, y - v) <= r)
    used_d, used_l, want = set(), set(), set()
    for _, i, j in pairs:
        if i not in used_d and j not in used_l:
            used_d.add(i), used_l.add(j), want.add((i, j))
    dd, ll = spark.createDataFrame(d, "d long, class string, x double, y double"), spark.createDataFrame(lab, "l long, class string, x double, y double, radius double")
    near = matching.near_pairs(dd, ll, 5.0)
    assert near.count() == len(pairs)
    found = matching.one_to_one(near)
    assert {(r["d"], r["l"]) for r in found.collect()} == want
    s = {r["class"]: r for r in matching.scores(dd, ll, found).collect()}
    assert sum(r["true_positive"] for r in s.values()) == len(want)
    assert sum(r["false_positive"] for r in s.values()) == len(d) - len(want) and sum(r["false_negative"] for r in s.values()) == len(lab) - len(want)
    assert matching.one_to_one(near.where("false")).count() == 0


def test_copies_match_by_groups(spark):
    rng = random.Random(8)
    spots = [(float(rng.randrange(12)), float(rng.randrange(12))) for _ in range(5)]
    d = [(i, "ab"[rng.randrange(2)], *rng.choice(spots)) for i in range(24)] + [(500, None, 1.0, 1.0), (501, "a", None, 1.0), (None, "a", 1.0, 1.0)]
    lab = [(i, "ab"[rng.randrange(2)], *rng.choice(spots), rng.choice((3.0, 6.0))) for i in range(26)] + [(500, "a", 1.0, 1.0, -1.0)]
    of = lambda d: spark.createDataFrame(d, "d long, class string, x double, y double")
    ll = spark.createDataFrame(lab, "l long, class string, x double, y double, radius double")
    rows = lambda df: sorted(map(tuple, df.collect()))
    for by_class in (True, False):
        at = lambda a, b: math.sqrt((a[2] - b[2]) ** 2 + (a[3] - b[3]) ** 2)
        ready = [(a, b) for a in d for b in lab if a[0] is not None and a[2] is not None and (a[1] == b[1] and a[1] is not None or not by_class)]
        used_d, used_l, want = set(), set(), []
        for far, i, j in sorted((at(a, b), a[0], b[0]) for a, b in ready if at(a, b) <= b[4]):
            if i not in used_d and j not in used_l:
                used_d.add(i), used_l.add(j), want.append((i, j, far))
        assert len(want) > 10 and rows(matching.matched(of(d), ll, 5.0, by_class)) == sorted(want)
    twice = [*d[:6], (3, "a", 2.0, 2.0)]
    assert rows(matching.matched(of(twice), ll, 5.0)) == rows(matching.one_to_one(matching.near_pairs(of(twice), ll, 5.0)))
    assert matching.matched(of(d).where("false"), ll, 5.0).count() == 0


def test_many_copies_need_no_row_for_each_pair(spark):
    """100,000 equal detections and as many labels are ten thousand million pairs."""
    n = 100_000
    d = spark.range(n).selectExpr("id as d", "'a' as class", "1.0D as x", "1.0D as y")
    lab = spark.range(n).selectExpr("id + 7 as l", "'a' as class", "2.0D as x", "1.0D as y", "5.0D as radius")
    got = matching.matched(d, lab, 5.0)
    assert got.count() == n and got.where("l <> d + 7 or distance <> 1.0").count() == 0


def test_box_overlaps_come_once(spark):
    rows = lambda k: [(i, float(x), float(x % 7), float(x + 3), float(x % 7 + 4)) for i, x in enumerate(range(k, 30, 2))]
    b, a = rows(0), rows(1)
    want = {}
    for p in b:
        for q in a:
            w, h = min(p[3], q[3]) - max(p[1], q[1]), min(p[4], q[4]) - max(p[2], q[2])
            if w >= 0 and h >= 0 and w * h / 12.0 >= 0.3:
                want[p[0], q[0]] = 1 - w * h / 12.0
    of = lambda x: spark.createDataFrame(x, "id long, x0 double, y0 double, x1 double, y1 double")
    got = matching.box_overlaps(of(b), of(a), 0.3, 2.5).collect()
    assert len(got) == len(want) and {(r["d"], r["l"]): pytest.approx(r["distance"]) for r in got} == want


def test_decisions_end_with_the_first_terminal_one(spark):
    f = ["field_or_authoritative_record"]
    rows = [(1, 1, "promote", None), (1, 2, "confirm", []), (1, 3, "confirm", f), (1, 4, "reject", f), (1, 5, "hold", None), (2, 1, "guess", f), (2, 2, "reject", None), (2, 3, None, None)]
    got = evidence.decide(spark.createDataFrame(rows, "uid long, ord long, decision string, signals array<string>")).orderBy("uid", "ord").collect()
    assert [r["status"] for r in got] == ["supported_candidate", "supported_candidate", "confirmed", "confirmed", "confirmed", "candidate", "rejected", "rejected"]
    assert [r["reason"] for r in got] == [None, "no field signal", None, "terminal", None, "unknown", None, "unknown"]


def test_lineage_follows_parents_through_cycles(spark):
    s = spark.createDataFrame([("a", "x"), ("b", " r "), ("c", "q"), ("d", "z"), ("e", " ")], "source string, root string")
    p = spark.createDataFrame([("a", "b"), ("a", "c"), ("c", "a"), ("d", "missing"), ("e", None)], "source string, parent string")
    assert {tuple(r) for r in evidence.lineage_roots(s, p).collect()} == {("a", "r"), ("b", "r"), ("c", "r")}


def test_worth_never_exceeds_the_claim(spark):
    src = spark.createDataFrame([(1, "REGISTERED", True), (2, "UNREGISTERED", False), (3, "REGISTERED", False)], "source long, provenance string, direct boolean")
    rows = [
        (1, "DIRECT", "PHYSICAL_OPENING", "FACT", ["survey"], [1], "DIRECT"), (2, "DIRECT", "PHYSICAL_OPENING", "FACT", ["Morphology "], [1], "CANDIDATE"), (3, "DIRECT", "EXISTENCE", "FACT", ["morphology"], [1], "DIRECT"),
        (4, "DIRECT", "EXISTENCE", "FACT", ["survey"], [2], "CANDIDATE"), (5, "DIRECT", "EXISTENCE", "FACT", ["survey"], [3], "SUPPORTING"), (6, "DIRECT", "EXISTENCE", "FACT", ["survey"], [1, 9], "CANDIDATE"),
        (7, "DIRECT", "EXISTENCE", "INFERENCE", ["survey"], [1], "SUPPORTING"), (8, "CONTRADICTED", "EXISTENCE", "FACT", None, None, "CONTRADICTED"), (9, "DIRECT", "EXISTENCE", "FACT", None, [1], "CANDIDATE"), (1, "CANDIDATE", "EXISTENCE", "FACT", ["survey"], [1], "CANDIDATE"),
    ]
    got = evidence.effective_tiers(spark.createDataFrame(rows, "assertion long, tier string, dimension string, claim string, bases array<string>, source_ids array<long>, want string"), src)
    assert got.count() == len(rows) and got.where("effective <> want or effective is null").isEmpty()


def test_ellipsoidal_distances(spark):
    # A quarter of the equator and of a meridian, and nearly opposite points, where great circles stand in.
    rows = [(0.0, 0.0, 90.0, 0.0), (0.0, 0.0, 0.0, 90.0), (0.0, 0.0, 0.0, 0.0), (0.0, 0.0, 179.9, 0.05), (None, 0.0, 1.0, 0.0), (200.0, 0.0, 1.0, 0.0)]
    got = [r[0] for r in spark.createDataFrame(rows, "a double, b double, c double, d double").select(geodesy.ellipsoidal("a", "b", "c", "d")).collect()]
    assert got[0] == pytest.approx(10018754.1714, abs=1e-3) and got[1] == pytest.approx(10001965.7293, abs=1e-3)
    assert got[2] == 0.0 and 1.99e7 < got[3] < 2.01e7 and got[4:] == [None, None]


def test_profiles(spark):
    rows = [(i, f"N{i % 3}", *([0.1] * 3), 0.1, 0.9 if i % 2 else 0.0, 0.1 if i % 2 else 0.9, 0.2, 0.1, 0.5) for i in range(40)]
    v = spark.createDataFrame(rows, ["flight_id", "callsign", *profiles.FEATURES])
    got = profiles.describe(profiles.clusters(v, 2)).collect()
    assert sorted((r["size"], r["label"]) for r in got) == [(20, "Charter / Point-to-Point"), (20, "Search / Patrol Operations")]
    assert profiles.clusters(v.where("false")).count() == 0 and profiles.clusters(v.limit(1)).first()["cluster"] == 0


def dbf_bytes(rows, fields):
    head = b"".join(n.encode().ljust(11, b"\0") + b"C" + bytes(4) + bytes([w]) + bytes(15) for n, w in fields)
    width = 1 + sum(w for _, w in fields)
    body = b"".join(mark + b"".join(v.encode("latin-1").ljust(w) for v, (_, w) in zip(r, fields, strict=True)) for mark, r in rows)
    return struct.pack("<4BIHH20x", 3, 99, 1, 1, len(rows), 33 + len(head), width) + head + b"\r" + body


def shp_bytes(points):
    recs = b"".join(struct.pack(">2I", i + 1, 10) + struct.pack("<I2d", 1, *p) for i, p in enumerate(points))
    return struct.pack(">I", 9994).ljust(100, b"\0") + recs


def test_tables_and_shapes_round_trip(spark, tmp_path):
    data = dbf_bytes([(b" ", ("72001", "Añasco")), (b"*", ("72002", "gone")), (b" ", ("72003", "Aguada"))], [("GEOID", 5), ("NAME", 12)])
    (tmp_path / "t.dbf").write_bytes(data)
    got = binary.dbf(spark, str(tmp_path)).orderBy("record").collect()
    assert [(r["record"], r["fields"]["NAME"]) for r in got] == [(0, "Añasco"), (2, "Aguada")]
    with zipfile.ZipFile(tmp_path / "t.zip", "w") as z:
        z.writestr("t.shp", shp_bytes([(-66.0, 18.0), (-66.1, 18.1), (-66.2, 18.2)])), z.writestr("t.dbf", data)
    got = binary.zipped_shapes(spark, str(tmp_path)).orderBy("record").collect()
    assert [(r["kind"], r["parts"], r["fields"]["GEOID"]) for r in got] == [("Point", [[[-66.0, 18.0]]], "72001"), ("Point", [[[-66.2, 18.2]]], "72003")]
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.dbf").write_bytes(data[:-4])
    with pytest.raises(Exception, match="cut short"):
        binary.dbf(spark, str(tmp_path / "bad")).collect()


def test_polygon_parts(spark):
    ring = [(0.0, 0.0), (0.0, 2.0), (2.0, 2.0), (0.0, 0.0)]
    body = struct.pack("<I4d2I2I", 5, 0, 0, 2, 2, 2, 8, 0, 4) + b"".join(struct.pack("<2d", *p) for p in ring * 2)
    data = struct.pack(">I", 9994).ljust(100, b"\0") + struct.pack(">2I", 1, len(body) // 2) + body + struct.pack(">2I", 2, 2) + struct.pack("<I", 0)
    assert list(binary.shapes(data)) == [("Polygon", [ring, ring]), (None, [])]


def test_packages_and_markup(spark, tmp_path):
    con = sqlite3.connect(tmp_path / "a.gpkg")
    con.execute("CREATE TABLE places (name TEXT, geom BLOB)")
    head = b"GP\0\x01" + struct.pack("<I", 4326)
    point = head + struct.pack("<BI2d", 1, 1, -66.5, 18.2)
    line = head + struct.pack("<BII", 1, 1002, 3) + struct.pack("<9d", 0, 0, 9, 1, 2, 9, 3, 3, 9)
    con.executemany("INSERT INTO places VALUES (?, ?)", [("a", point), ("b", line), ("c", b"GP"), (None, None)])
    con.commit(), con.close()
    rows = binary.package_rows(spark, str(tmp_path), "places")
    got = rows.select("rowid", "fields", binary.package_geometry("geometry").alias("g")).orderBy("rowid").collect()
    assert [(r["fields"].get("name"), r["g"]["kind"], r["g"]["lon"], r["g"]["lat"]) for r in got] == [("a", "Point", -66.5, 18.2), ("b", "LineString", 1.0, 2.0), ("c", None, None, None), (None, None, None, None)]
    (tmp_path / "a.kml").write_text("<kml><Document><Placemark><name>p</name><Point><coordinates>-66.1,18.4,0</coordinates></Point></Placemark><Placemark><name>l</name><LineString><coordinates>1,2 3,4\n5,6</coordinates></LineString></Placemark></Document></kml>")
    got = {r["name"]: (r["kind"], r["points"]) for r in binary.placemarks(spark, str(tmp_path)).collect()}
    assert got == {"p": ("Point", [[-66.1, 18.4]]), "l": ("LineString", [[1.0, 2.0], [3.0, 4.0], [5.0, 6.0]])}
    (tmp_path / "g").mkdir()
    (tmp_path / "g" / "a.gml").write_text("<x><ms:mukey> 12 </ms:mukey><mukey>7</mukey><mukey>12</mukey><mukey></mukey></x>")
    assert sorted(r["value"] for r in binary.element_values(spark, str(tmp_path / "g"), "mukey").collect()) == ["12", "7"]
