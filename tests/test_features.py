"""Corridors against the walk, registrations with planted outliers, scenarios and heights against plain versions."""

import math
import random

import numpy as np
import pytest

from terravane.operators import corridors as K
from terravane.operators import registration as R
from terravane.operators import scenarios as Z


def walk(nodes, gap):
    seeds, out = [], {}
    for n, x, y in sorted(nodes):
        hit = next((s for s, a, b in seeds if math.sqrt((a - x) ** 2 + (b - y) ** 2) <= gap), None)
        out[n] = n if hit is None else hit
        if hit is None:
            seeds.append((n, x, y))
    return out


def test_seeds_equal_the_walk_on_many_sets(spark):
    """100 random sets, told apart by an offset far beyond the gap."""
    rng = random.Random(4)
    nodes = []
    for k in range(100):
        spread = rng.choice([0.5, 2.0, 6.0])
        for i in rng.sample(range(10_000), 30):
            nodes.append((k * 10_000 + i, k * 1_000.0 + rng.uniform(0, spread), rng.uniform(0, spread)))
    got = {r["node"]: r["seed"] for r in K.seeds(spark.createDataFrame(nodes, "node long, x double, y double").repartition(5), 1.0).collect()}
    assert got == walk(nodes, 1.0)


def test_seeds_of_crowds_ties_and_lines(spark):
    crowd = [(i, 5.0 + (i % 7) * 0.01, 5.0) for i in range(700)]
    line = [(1_000 + i, 50.0 + i * 0.9, 0.0) for i in range(12)]
    edge = [(2_000, 90.0, 0.0), (2_001, 91.0, 0.0), (2_002, 92.0, 0.0)]
    got = {r["node"]: r["seed"] for r in K.seeds(spark.createDataFrame([*crowd, *line, *edge, (3_000, None, 1.0)], "node long, x double, y double"), 1.0).collect()}
    assert got == walk(crowd + line + edge, 1.0) | {3_000: 3_000}
    assert K.seeds(spark.createDataFrame([], "node long, x double, y double"), 1.0).count() == 0
    with pytest.raises(ValueError):
        K.seeds(spark.createDataFrame([], "node long, x double, y double"), 0.0)


def test_corridor_measures(spark):
    rows = [(1, 0.0, 0.0, 3.0, None), (2, 0.5, 0.0, None, 4.0), (3, 9.0, 9.0, 1.0, 1.0)]
    (r,) = K.candidates(spark.createDataFrame(rows, "node long, x double, y double, score double, risk double"), 1.0).collect()
    assert tuple(r) == (1, 2, 0.25, 0.0, 1.5, 3.0, 2.0, 4.0)


def control_points(rng, image, n, bad):
    a = np.array([[2e-4, 3e-5, -66.3], [-1e-5, -1.5e-4, 18.3]]) * (1 + image * 0.01)
    out = []
    for i in range(n):
        px, py = rng.uniform(0, 1000), rng.uniform(0, 800)
        lon, lat = a @ np.array([px, py, 1.0]) + rng.normal(0, 2e-6, 2)
        if i < bad:
            lon, lat = lon + rng.uniform(0.01, 0.05), lat - rng.uniform(0.01, 0.05)
        out.append((image, i, float(px), float(py), float(lon), float(lat)))
    return out


@pytest.fixture(scope="module")
def images(spark):
    rng = np.random.default_rng(12)
    rows = [p for k in range(5) for p in control_points(rng, k, 40, 0 if k < 2 else 5)]
    rows += [(90, i, float(i), 2.0 * i, -66.0, 18.0) for i in range(6)] + [(91, 0, 1.0, 2.0, -66.0, 18.0), (91, 1, None, 2.0, -66.0, 18.0)]
    return rows, spark.createDataFrame(rows, "image long, label long, px double, py double, lon double, lat double")


def test_affine_fits_equal_least_squares(images):
    rows, df = images
    got = {r["image"]: r for r in R.registered(df, 10, 5.0, 10.0).collect()}
    for k in range(5):
        own = np.array([r[2:] for r in rows if r[0] == k])
        want, *_ = np.linalg.lstsq(np.c_[own[:, :2], np.ones(len(own))], own[:, 2:], rcond=None)
        assert np.allclose([got[k][c] for c in ("ax", "bx", "cx")], want[:, 0], rtol=1e-9, atol=1e-12)
        assert np.allclose([got[k][c] for c in ("ay", "by", "cy")], want[:, 1], rtol=1e-9, atol=1e-12)
        assert got[k]["certified"] == (k < 2)
    assert got[90]["ax"] is None and not got[90]["certified"] and got[91]["n"] == 1 and got[91]["ax"] is None


def test_outliers_are_rejected(images):
    rows, df = images
    fits, kept = R.trimmed(df.where("image < 5"), 0.8)
    left = {(r["image"], r["label"]) for r in kept.collect()}
    assert not {(k, i) for k in (2, 3, 4) for i in range(5)} & left and len(left) == 5 * 32
    agreed_fits, agreed = R.consensus(df, 3.0, tries=40)
    found = {(r["image"], r["label"]) for r in agreed.collect()}
    assert {(k, i) for k in range(5) for i in range(40) if k < 2 or i >= 5} == {f for f in found if f[0] < 5}
    for r in agreed_fits.where("image < 5").collect():
        assert r["ax"] == pytest.approx(2e-4 * (1 + r["image"] * 0.01), rel=1e-3)
    assert not [f for f in found if f[0] == 91]


def test_scenarios_equal_plain_scores(spark):
    rng = random.Random(6)
    families = ["AQUIFERS_WELLS_SPRINGS", "MINES_QUARRIES_SHAFTS", "GEOLOGY_KARST_CAVES", "INDUSTRIAL_REMEDIATION", "UTILITIES_UNDERGROUND", "HISTORICAL_CORROBORATION", None]
    hits = []
    for _ in range(400):
        f = rng.choice(families)
        asset = rng.choice([None, 1, 2, 3, 4])
        hits.append((rng.randrange(12), f, rng.choice(["a", "b", "c", "d", "", None]), f == families[0], f == families[1], rng.random() < 0.02, f == families[5], asset, None if asset is None else "GROUNDWATER_POINT" if asset < 3 else "MINE_QUARRY_FEATURE"))
    schema = "zone_id long, family string, source string, ground boolean, mine boolean, cave boolean, history boolean, asset long, asset_class string"
    zones = spark.createDataFrame([(i, "MODERATE", "DIRECT", 4.5) for i in range(14)], "zone_id long, relevance string, tier string, score double")
    got = {(r["zone_id"], r["scenario"]): r["score"] for r in Z.scenario_scores(spark.createDataFrame(hits, schema), zones).collect()}
    for name, out in Z.LEFT_OUT.items():
        for z in range(14):
            own = [h for h in hits if h[0] == z and (h[1] or "") not in out]
            water = len({h[7] for h in own if h[3] and h[8] == "GROUNDWATER_POINT"}) + sum(h[3] and h[8] != "GROUNDWATER_POINT" for h in own)
            mines = len({h[7] for h in own if h[4] and h[8] == "MINE_QUARRY_FEATURE"}) + sum(h[4] and h[8] != "MINE_QUARRY_FEATURE" for h in own)
            n = {f: sum(h[1] == f for h in own) for f in families}
            sources = {h[2] for h in own if h[2]}
            total = min(3.0, 3.0 * sum(h[5] for h in own)) + min(2.5, math.log1p(water) * 0.75) + min(2.0, math.log1p(mines) * 0.9) + min(0.75, math.log1p(n["INDUSTRIAL_REMEDIATION"]) * 0.25)
            total += min(0.5, math.log1p(n["UTILITIES_UNDERGROUND"]) * 0.08) + min(0.25, math.log1p(n["HISTORICAL_CORROBORATION"]) * 0.05) + (min(1.0, (len(sources) - 2) * 0.15) if len(sources) > 2 else 0.0)
            assert got[z, name] == pytest.approx(min(10.0, total), abs=6e-4)


def test_ranks_do_not_depend_on_blocks(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, s, rng.randrange(4) / 2) for i in range(200) for s in ("a", "b")]
    want = {}
    for s in ("a", "b"):
        for k, (_, i) in enumerate(sorted(((v, i) for i, t, v in rows if t == s), reverse=True), 1):
            want[i, s] = k
    for block in (7, 65_536):
        monkeypatch.setattr(Z, "BLOCK", block)
        assert {(r["zone_id"], r["scenario"]): r["rank"] for r in Z.ranks(spark.createDataFrame(rows, "zone_id long, scenario string, score double")).collect()} == want


def test_heights_are_moved_or_refused(spark):
    values = [(1, 5.0, "up", "P", -66.0, 18.0, 0.3), (2, 5.0, "down", "M", -66.0, 18.0, 0.3), (3, 5.0, "up", "M", -60.0, 18.0, 0.3), (4, 5.0, "up", "M", None, None, None), (5, 5.0, "up", "A", -66.0, 18.0, None), (6, 5.0, None, "P", -66.0, 18.0, None), (7, None, "up", "P", -66.0, 18.0, None), (8, float("inf"), "up", "P", -66.0, 18.0, None), (9, 1.0, "up", "N", -66.0, 18.0, None), (10, 1.0, "up", None, -66.0, 18.0, None), (11, float("nan"), "up", "P", 0.0, 0.0, None)]
    transforms = [("M", "P", -0.25, "agency", 0.4, -67.0, 17.0, -65.0, 19.0), ("N", "P", 1.0, "one", 0.1, None, None, None, None), ("N", "P", 2.0, "two", 0.1, None, None, None, None), ("P", "X", 9.0, "other", 0.1, None, None, None, None)]
    v = spark.createDataFrame(values, "id long, value double, positive string, datum string, lon double, lat double, uncertainty double")
    t = spark.createDataFrame(transforms, "source string, target string, offset double, authority string, uncertainty double, west double, south double, east double, north double")
    got = {r["id"]: tuple(r)[1:] for r in R.on_common_datum(v, t, "P", ("A",)).collect()}
    refused = {3: "NO_TRANSFORM", 4: "NO_TRANSFORM", 5: "ASSUMED_DATUM", 6: "UNKNOWN_DATUM", 7: "NOT_A_NUMBER", 8: "NOT_A_NUMBER", 9: "AMBIGUOUS", 10: "UNKNOWN_DATUM", 11: "NOT_A_NUMBER"}
    assert {k: (None, None, s, None) for k, s in refused.items()}.items() <= got.items()
    assert got[1] == (5.0, 0.3, "SAME_REFERENCE", None) and got[2][0] == -5.25 and got[2][1] == pytest.approx(0.5) and got[2][2:] == ("TRANSFORMED", "agency")


def test_exports_fill_what_is_missing(spark, tmp_path):
    from terravane.sources import exports as X

    flights = spark.createDataFrame([("f1", "N1", "SJU", "BQN", 18.4, -66.0, 18.5, -67.1, 50), ("f2", None, "SJU", "", 1.0, 2.0, 0.0, -67.0, None)], "flight_id string, callsign string, origin_airport string, destination_airport string, origin_lat double, origin_lon double, dest_lat double, dest_lon double, flight_duration_minutes int")
    images = spark.createDataFrame([("s2", "f1", "N1", "/b", None, 0.0), ("s1", "f1", "N1", "/a", 0.5, 0.8), ("s3", "", "N9", "/c", 0.1, 0.1)], "screenshot_id string, flight_id string, callsign string, image_path string, ocr_confidence double, coordinate_confidence double")
    profiles = spark.createDataFrame([("N1", 7), ("N9", None)], "callsign string, total_flights long")
    alerts = spark.createDataFrame([("a1", "f1"), ("a2", "zz")], "alert_id string, flight_id string")
    tables = {"flights": flights, "screenshots": images, "aircraft_profiles": profiles, "alerts": alerts, "track_points": spark.createDataFrame([(1, "f2")], "id long, flight_id string"), "mission_scores": spark.createDataFrame([("f1", 0.5)], "flight_id string, total_score double")}
    manifest = X.export_all(tables, f"file://{tmp_path}/out")
    assert {r["stream"] for r in manifest.collect()} == {"airports", "route_lines"}
    read = lambda n: spark.read.parquet(f"file://{tmp_path}/out/{n}").collect()
    events = {r["flight_id"]: r for r in read("airspace_events")}
    assert events["f1"]["screenshot_id"] == "s1" and events["f1"]["source_path"] == "/a" and events["f1"]["coordinate_confidence"] == 0.8 and events["f1"]["operator"] == ""
    assert events["f2"]["screenshot_id"] == "" and events["f2"]["coordinate_confidence"] == 0.65 and events["f2"]["flight_duration_minutes"] == 0 and events["f2"]["callsign"] == ""
    assert {r["screenshot_id"]: r["coordinate_confidence"] for r in read("screenshot_evidence")} == {"s1": 0.8, "s2": 0.65, "s3": 0.1}
    assert {r["callsign"]: (r["flight_count"], r["screenshot_id"]) for r in read("aircraft_profiles")} == {"N1": (7, "s1"), "N9": (0, "")}
    assert {r["alert_id"]: r["screenshot_id"] for r in read("anomaly_index")} == {"a1": "s1", "a2": ""} and read("mission_inferences")[0]["total_score"] == 0.5 and read("track_points")[0]["latitude"] == 0.0
    assert [tuple(r)[:4] for r in X.airports(flights, images).orderBy("name").collect()] == [("dest_BQN", "BQN", -67.1, 18.5), ("origin_SJU", "SJU", -66.0, 18.4)]
    (route,) = X.routes(flights, images).collect()
    assert route["flight_id"] == "f1" and [tuple(p) for p in route["points"]] == [(-66.0, 18.4), (-67.1, 18.5)]


def test_ages_and_time_gone_by(spark):
    from pyspark.sql import functions as F

    from terravane.functions import normal

    want = {
        "hace 5 años tiene 40 años": "", "Hace 5 años, dicen que ella tiene ya cumplidos 40 años": "40", "lleva casi 3 años perdida": "", "tiene 12 años": "12", "edad: 7, hace 3 años": "7", "desde hace unos 5 años y 30 años": "30", "por fin a sus 20 años": "", "120 años": "120", "2005 años": "005", "": "",
        "hace mucho tiempo que no se sabe nada, 33 años": "33",
    }
    df = spark.createDataFrame([(t,) for t in want], "t string")
    assert {r["t"]: r["a"] for r in df.select("t", normal.age(F.col("t")).alias("a")).collect()} == want


def test_farthest_places_equal_all_pairs(spark):
    from pyspark.sql import functions as F

    from terravane.operators import linkage

    rng = random.Random(8)
    rows = [(i, f"s{i % 4}", f"k{i % 9}", -66.0 + rng.uniform(-8, 8), 18.0 + rng.uniform(-8, 8)) for i in range(300)] + [(400, "s1", "two", 1.0, 2.0), (401, "s2", "two", None, 2.0), (402, "s1", "one", 1.0, 2.0), (403, "s1", "one", 3.0, 2.0), (404, "s1", None, 1.0, 1.0), (405, "s2", "same", 5.0, 5.0), (406, "s3", "same", 5.0, 5.0)]
    got = {r["id"]: r for r in linkage.linkage_groups(spark.createDataFrame(rows, "id long, source string, k0 string, lon double, lat double"), F.col("k0")).collect()}
    assert set(got) == {*range(300), 400, 401, 405, 406} and got[400]["disagreement_km"] is None and got[405]["disagreement_km"] == 0.0

    def km(a, b):
        p, q = math.radians(b[4] - a[4]) / 2, math.radians(b[3] - a[3]) / 2
        return 2 * 6371.0088 * math.asin(math.sqrt(math.sin(p) ** 2 + math.cos(math.radians(a[4])) * math.cos(math.radians(b[4])) * math.sin(q) ** 2))

    for g in range(9):
        own = [r for r in rows[:300] if r[2] == f"k{g}"]
        assert got[own[0][0]]["disagreement_km"] == pytest.approx(max(km(a, b) for a in own for b in own), abs=6e-4)
        assert got[own[0][0]]["n_rows"] == len(own) and got[own[0][0]]["n_sources"] == len({r[1] for r in own})


def test_contained_names_equal_all_pairs(spark):
    from terravane.operators import linkage

    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abé") for _ in range(rng.randrange(0, 6)))
    projects = [(i, " ".join((word(), word())), rng.choice(["X", "y", "", None])) for i in range(150)] + [(900, None, "x"), (901, "AB", None), (901, "AB", None)]
    references = [(f"r{j}", rng.randrange(20), rng.choice(["x", "Y", ""]), [word(), None, word() + " " + word()]) for j in range(25)]
    plain = lambda t: " ".join((t or "").lower().replace("é", "e").split())
    want = []
    for i, t, m in projects:
        fit = [(o, r) for r, o, m2, names in references if plain(t) and (not plain(m) or plain(m2) == plain(m)) and any(plain(n) and (plain(n) in plain(t) or plain(t) in plain(n)) for n in names)]
        want.append((i, min(fit)[1] if fit else None))
    got = linkage.contained_names(spark.createDataFrame(projects, "id long, name string, municipality string"), spark.createDataFrame(references, "ref_id string, ord long, municipality string, names array<string>"))
    assert sorted(((r["id"], r["ref_id"]) for r in got.collect()), key=repr) == sorted(want, key=repr)
