"""Operators against plain loops and known answers, with nulls, ties, empty tables and boundary points."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from terravane.functions import geo, texts
from terravane.operators import alerts, area, contracts, graph, intake, joins, linkage, raster, timeline, tracks
from terravane.sources import sinks, tables

T0 = dt.datetime(2024, 1, 1)


def points(spark, rows):
    return spark.createDataFrame([(f, i, T0 + dt.timedelta(seconds=s), lon, lat, alt, 50) for f, i, s, lon, lat, alt in rows], "flight_id long, point_id long, ts timestamp_ntz, lon double, lat double, alt_ft long, speed_mph long")


def test_backward_clock_is_one_failure(spark):
    from pyspark.sql import Window

    p = points(spark, [(1, 1, 100, -66.0, 18.0, 500), (1, 2, 40, -66.5, 18.4, 9000), (1, 3, 40, -66.0, 18.0, 500)])
    got = tracks.validate(p, Window.partitionBy("flight_id").orderBy("point_id")).collect()
    assert [(r["idx"], r["check_type"], r["passed"]) for r in got] == [(1, "monotonic_time", False)]
    assert got[0]["measure"] == 60.0


def test_missing_place_skips_the_speed_check(spark):
    p = points(spark, [(1, 1, 0, -66.0, 0.0, 0), (1, 2, 60, -66.0, 18.0, 100), (2, 1, 0, None, None, None), (2, 2, 5, -66.0, 18.0, 7)])
    assert tracks.validate(p).count() == 0
    assert tracks.validate(p.where("false")).count() == 0


def test_hypotheses_follow_the_plain_loop(spark):
    rows = [(1, 1, 0, -66.0, 18.0, 500), (1, 2, 0, -66.1, 18.0, 500), (1, 3, 60, -66.0, 18.001, 500), (1, 4, 120, -65.0, 18.0, 500), (1, 5, 90, -65.0, 18.0, 500), (1, 6, 180, -65.0, 18.0, 9000)]
    got = tracks.hypotheses(points(spark, rows).withColumn("arrival", F.col("point_id"))).orderBy("point_id").collect()
    assert [r["check_type"] for r in got] == ["track_init", "track_duplicate", "track_consistency", "track_consistency", "track_duplicate", "track_consistency"]
    assert [r["passed"] for r in got] == [True, True, True, False, True, False]


@pytest.mark.parametrize("width", [0.01, 0.03])
def test_greedy_duplicates_equal_the_loop(spark, width):
    rng = random.Random(4)
    rows = [(i, round(rng.uniform(0, 1), 3), round(rng.uniform(0, 1), 3)) for i in range(900)] + [(1000 + i, 0.5, 0.5) for i in range(50)] + [(5000, None, 1.0)]
    kept = []
    for o, x, y in rows:
        if x is not None and not any(abs(a - x) <= width and abs(b - y) <= width for _, a, b in kept):
            kept.append((o, x, y))
    got = intake.greedy_duplicates(spark.createDataFrame(rows, "ord long, lon double, lat double"), width)
    assert sorted(r["ord"] for r in got.collect()) == [k[0] for k in kept]


def test_points_on_edges(spark):
    square = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
    hole = [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 2.0), (1.0, 1.0)]
    p = spark.createDataFrame([(1, 0.0, 2.0), (2, 4.0, 4.0), (3, 1.0, 1.5), (4, 1.5, 1.5), (5, 3.0, 3.0), (6, 5.0, 3.0), (7, None, 3.0)], "id long, lon double, lat double")
    inside, ledger = area.select(p, area.polygon([square, hole]))
    assert [r["id"] for r in inside.collect()] == [1, 2, 3, 5]
    assert ledger.first().asDict() == {"matched": 4, "returned": 4, "excluded": 1, "truncated": False}
    edges = [(9, *a, *b) for ring in (square, hole) for a, b in zip(ring, ring[1:])]
    e = spark.createDataFrame(edges, "polygon_id long, ax double, ay double, bx double, by double")
    assert sorted(r["id"] for r in joins.points_in_polygons(p, e).collect()) == [1, 2, 3, 5]
    assert {r["id"]: r["polygon_id"] for r in joins.first_containing(p, e).collect()}[6] is None


def hav(a, b):
    p, q = math.sin(math.radians(b[1] - a[1]) / 2), math.sin(math.radians(b[0] - a[0]) / 2)
    return 2 * geo.EARTH_M * math.asin(math.sqrt(p * p + math.cos(math.radians(a[1])) * math.cos(math.radians(b[1])) * q * q))


def test_nearest_and_within_equal_brute_force(spark):
    rng = random.Random(1)
    a = [(i, rng.uniform(-70, -60), rng.uniform(10, 20)) for i in range(120)] + [(500, 100.0, -40.0)]
    b = [(i, rng.uniform(-67, -66), rng.uniform(17, 18)) for i in range(80)]
    da, db = (spark.createDataFrame(x, "id long, lon double, lat double") for x in (a, b))
    want = {i: min((hav((x, y), (u, v)), j) for j, u, v in b)[1] for i, x, y in a}
    assert {r["id"]: r["other_id"] for r in joins.nearest(da, db).collect()} == want
    pairs = {(i, j) for i, x, y in a for j, u, v in b if hav((x, y), (u, v)) <= 30_000}
    for salts in (1, 3):
        assert {(r["id"], r["other_id"]) for r in joins.within_distance(da, db, 30_000.0, salts).collect()} == pairs
    assert all(r["other_id"] is None for r in joins.nearest(da, db.where("false")).collect())


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 102), (7, 7)], "u long, v long")
    got = {r["node"]: r["root"] for r in graph.components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100}
    assert graph.components(edges.where("false")).count() == 0


def test_names_are_linked_like_brute_force(spark):
    rng = random.Random(2)
    vocabulary = ["ALFA", "BRAVO", "CHARLY", "DELTA", "ECHO", "FOX", "GOLF"]
    a = [(i, " ".join(rng.sample(vocabulary, rng.randint(1, 4)))) for i in range(60)] + [(90, None), (91, "de la inc")]
    b = [(i, " ".join(rng.sample(vocabulary, rng.randint(1, 4)))) for i in range(60)]
    got = {(r["id"], r["other_id"]) for r in linkage.similar_names(*(spark.createDataFrame(x, "id long, name string") for x in (a, b)), 0.6).collect()}
    words = lambda s: set((s or "").split())
    assert got == {(i, j) for i, s in a if i < 90 for j, t in b if len(words(s) & words(t)) / len(words(s) | words(t)) >= 0.6}


def test_time_keys(spark):
    df = spark.createDataFrame([("2024",), ("2024-02",), ("2024-04-05",), ("2024-04-05 06:07",), ("soon",), (None,), ("2024-13",)], "t string")
    got = [tuple(r) for r in df.select(texts.time_key(F.col("t")), texts.time_key(F.col("t"), upper=True)).collect()]
    assert got == [("2024-01-01T00:00:00", "2024-12-31T23:59:59"), ("2024-02-01T00:00:00", "2024-02-29T23:59:59"), ("2024-04-05T00:00:00", "2024-04-05T23:59:59"), ("2024-04-05T06:07:00", "2024-04-05T06:07:59"), (None, None), (None, None), (None, None)]


def test_search_folds_marks(spark):
    layer = spark.createDataFrame([(1, "Mayagüez"), (2, "Bahía de Mayagüez"), (3, None), (4, "Nuevo Mayagüez Sur")], "id long, name string")
    assert [(r["id"], r["rank"]) for r in area.search(layer, "mayaguez", ["name"]).collect()] == [(1, 0), (2, 2), (4, 2)]


def test_grid_binding_shares_edges_and_corners(spark):
    p = spark.createDataFrame([(1, "10", "10"), (2, "250", "10"), (3, "250", "250"), (4, "-1", "5")], "id long, x string, y string").selectExpr("id", "cast(x as decimal(18,3)) x", "cast(y as decimal(18,3)) y")
    got = {r["id"]: r["n"] for r in area.bind_exact(p, 250, 10, 10).groupBy("id").agg(F.count("*").alias("n")).collect()}
    assert got == {1: 1, 2: 2, 3: 4}


def test_shape_of_clouds(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1.0), (0.0, 0.0, 0.0), (1.0, 1.0, 0.0)], "xx double, yy double, xy double")
    assert [r[0] for r in df.select(geo.linearity(F.col("xx"), F.col("yy"), F.col("xy"))).collect()] == [1.0, 0.0, 0.0]


def test_nearness_alone_never_lifts_above_t3(spark):
    c = spark.createDataFrame([("a", "poi", 0.9, "MBIL-3", "no", "no", None, None, None), ("b", "poi", 0.9, "MBIL-3", "yes", "yes", None, None, None), ("c", "poi", 0.1, "MBIL-0", "no", "no", None, None, None)], "id string, kind string, confidence double, nearness string, water string, utility string, corridor_id string, connecting long, alignment double")
    got = {r["id"]: (r["tier"], r["fact_status"], r["review_status"]) for r in intake.tiers(c).collect()}
    assert got == {"a": ("T3", "inferred", "manual_review"), "b": ("T1", "observed", "accepted"), "c": ("T4", "inferred", "rejected")}


def test_epochs_cover_both_sides(spark):
    a, b = (spark.createDataFrame(x, "id long, score double") for x in ([(1, 0.5), (2, 0.5)], [(2, 0.55), (3, 0.2)]))
    got = {r["id"]: (r["score_a"], r["score_b"], r["trend"]) for r in contracts.epochs(a, b).collect()}
    assert got == {1: (0.5, 0.0, "decreasing"), 2: (0.5, 0.55, "stable"), 3: (0.0, 0.2, "increasing")}


def test_alias_states(spark):
    rows = spark.createDataFrame([(1, "San  Juan"), (2, "PONCE"), (3, None)], "id long, raw string")
    aliases = spark.createDataFrame([("san juan", "SJ"), ("San Juan", "SJ"), ("ponce", "P1"), ("Ponce", "P2")], "alias string, canonical string")
    assert {r["id"]: (r["state"], r["canonical"]) for r in linkage.resolve_aliases(rows, aliases).collect()} == {1: ("resolved", "SJ"), 2: ("collision", None), 3: ("unresolved", None)}


def test_posts_keep_the_first_long_one(spark):
    posts = spark.createDataFrame([(1, 1, "short"), (1, 2, "long enough to be kept as the first of them"), (1, 3, "another long text that comes afterwards, too")], "id long, ord long, text string")
    assert [r["ord"] for r in linkage.clean_posts(posts).collect()] == [2]


def test_depressions_fill_to_their_spill_level(spark):
    h = [[9, 9, 9, 9, 9], [9, 2, 3, 5, 9], [9, 3, 1, 4, 6], [9, 9, 9, 9, 9]]
    cells = spark.createDataFrame([(r, c, float(v)) for r, row in enumerate(h) for c, v in enumerate(row)], "row long, col long, value double")
    got = {(r["row"], r["col"]): r["value"] for r in raster.fill(cells).collect()}
    assert got[(1, 1)] == got[(2, 2)] == got[(2, 3)] == 6.0 and got[(0, 0)] == 9.0 and got[(2, 4)] == 6.0


def test_flat_and_tilted_planes(spark):
    cells = spark.range(40 * 40).selectExpr("id div 40 as row", "id % 40 as col", "cast(id % 40 as double) * 10 as value")
    got = {(r["row"], r["col"]): r["value"] for r in raster.slope(cells, 10.0, 10.0, tile=16).collect()}
    assert len(got) == 1600
    assert all(abs(v - 45.0) < 1e-9 if 0 < r < 39 and 0 < c < 39 else v is None for (r, c), v in got.items())


def test_scene_pairs_and_epochs(spark):
    s = spark.createDataFrame([("a", "s1", T0), ("a", "s2", T0 + dt.timedelta(hours=2)), ("a", "s3", T0 + dt.timedelta(days=40)), ("b", "x", T0)], "site string, scene_id string, ts timestamp_ntz")
    got = {(r["before"], r["after"], r["pair_kind"], r["epoch"]) for r in timeline.epoch(timeline.comparison_pairs(s)).collect()}
    assert got == {("s1", "s2", "consecutive", "SAME_EPOCH"), ("s2", "s3", "consecutive", "CROSS_EPOCH"), ("s1", "s3", "baseline_latest", "CROSS_EPOCH")}


def test_repeated_alerts(spark):
    rows = [(1, "x", "c", T0), (2, "x", "c", T0 + dt.timedelta(hours=24)), (3, "x", "c", T0 + dt.timedelta(hours=48, seconds=1)), (4, "y", "c", T0)]
    a = spark.createDataFrame(rows, "alert_id long, callsign string, category string, ts timestamp_ntz")
    assert sorted(r["alert_id"] for r in alerts.without_repeats(a).collect()) == [1, 3, 4]


def test_package_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", -66.0, 18.0), (2, None, None, None)], "id long, name string, lon double, lat double")
    at = f"file://{tmp_path}/package"
    manifest = sinks.write_package({"rows": df}, at)
    assert {r["state"] for r in tables.verify_files(spark, f"{at}/rows", manifest.where("stream = 'rows'")).where("name like 'part-%'").collect()} == {"ok"}
    back = tables.json_lines(spark, f"{at}/rows", "id long, name string, lon double, lat double")
    assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)
    lines = [r[0] for r in df.select(sinks.feature_json(["id", "name"])).collect()]
    (tmp_path / "layer.geojson").write_text('{"type":"FeatureCollection","features":[' + ",".join(lines) + "]}")
    got = tables.point_features(tables.features(spark, f"file://{tmp_path}/layer.geojson")).orderBy("ord").collect()
    assert [(r["lon"], r["lat"], r["properties"]["id"]) for r in got] == [(-66.0, 18.0, "1"), (None, None, "2")]


def test_streams(spark, tmp_path):
    from terravane.streaming import tracks as stream

    p = points(spark, [(1, 1, 0, -66.0, 18.0, 500), (1, 2, 60, -65.0, 18.0, 500), (2, 1, 0, -66.0, 18.0, 500)])
    p.write.parquet(f"{tmp_path}/in")
    live = spark.readStream.schema(p.schema).parquet(f"{tmp_path}/in")
    q = stream.validate(live).writeStream.format("memory").queryName("checks").option("checkpointLocation", f"{tmp_path}/c1").trigger(availableNow=True).start()
    assert q.awaitTermination(60)
    assert [(r["flight_id"], r["check_type"], r["passed"]) for r in spark.table("checks").collect()] == [(1, "speed", False)]
    a = live.selectExpr("flight_id as callsign", "'c' as category", "cast(ts as timestamp) as ts")
    q = stream.without_repeats(a).writeStream.format("memory").queryName("kept").option("checkpointLocation", f"{tmp_path}/c2").trigger(availableNow=True).start()
    assert q.awaitTermination(60)
    assert sorted(r["callsign"] for r in spark.table("kept").collect()) == [1, 2]


def test_route_corridors_equal_all_pairs(spark, monkeypatch):
    import random
    from collections import Counter

    from pyspark.sql import functions as F

    from terravane.operators import intake

    rng = random.Random(3)
    spot = lambda: (round(rng.uniform(-66.4, -65.9), 2), round(rng.uniform(18.0, 18.4), 2))
    places = [(i, *spot()) for i in range(40)]
    flown = [(*spot(), *spot()) for _ in range(300)]
    want = Counter()
    for ox, oy, dx, dy in flown:
        at = [[i for i, x, y in places if abs(x - px) <= 0.1 and abs(y - py) <= 0.1] for px, py in ((ox, oy), (dx, dy))]
        for a in at[0]:
            for b in at[1]:
                if a != b:
                    want[min(a, b), max(a, b)] += 1
    found = spark.createDataFrame(places, "id long, lon double, lat double")
    flights = spark.createDataFrame([*flown, (None, 1.0, 2.0, 3.0)], "origin_lon double, origin_lat double, dest_lon double, dest_lat double")
    for ends, some, parts in ((1024, 1024, 32_768), (5, 3, 7)):
        monkeypatch.setattr(intake, "END_POINTS", ends)
        monkeypatch.setattr(intake, "PLACES", some)
        monkeypatch.setattr(intake, "PARTED", parts)
        got = {(r["place_a"], r["place_b"]): r["connecting"] for r in intake.corridors(found, flights).collect()}
        assert got == {k: n for k, n in want.items() if n >= 2}
    named = intake.corridors(found.withColumn("id", F.concat(F.lit("p"), F.col("id").cast("string"))), flights)
    assert named.count() == sum(n >= 2 for n in want.values()) and intake.corridors(found.limit(0), flights).count() == 0
