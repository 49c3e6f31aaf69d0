"""Normalised texts, zones, corridors, schemas and roads on small hand-made rows."""

import datetime
import math
import re
import unicodedata

from pyspark.sql import functions as F

from terravane.functions import normal
from terravane.operators import linkage, proximity, validation


def folded(t):
    return "".join(c for c in unicodedata.normalize("NFKD", t or "") if not unicodedata.combining(c)).lower()


def status_by_walk(text):
    t = folded(text)
    for words, name in ((normal.DEAD, "resolved_deceased"), (normal.FOUND, "resolved_alive")):
        if any(not re.search(normal.DENIED, t[max(0, m.start() - 24) : m.start()]) for m in re.finditer(words, t)):
            return name
    return "active"


TEXTS = [
    None, "", "Fue hallada sana y salva", "no ha sido localizada", "encontrado fallecido en Ponce", "no fue vista pero luego de una semana entera fue encontrada",
    "Aún no la han encontrado", "hallado sin vida", "Cadáver; sin vida", "jamás encontrado. Resuelto", "x" * 5000 + " con vida", "encontrada encontrada no encontrada",
]


def test_status(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id int, text string")
    got = {r.id: r.s for r in df.select("id", normal.case_status(F.col("text")).alias("s")).collect()}
    assert got == {i: status_by_walk(t) for i, t in enumerate(TEXTS)}
    assert set(got.values()) == {"active", "resolved_alive", "resolved_deceased"}


def test_age(spark):
    want = {None: "", "": "", "Edad: 34": "34", "tiene 12 años": "12", "desapareció hace unos 5 años": "", "lleva 3 años; tiene 40 años": "40", "hace 5 años, edad 7": "7"}
    df = spark.createDataFrame([(t,) for t in want], "text string")
    assert {r.text: r.a for r in df.select("text", normal.age(F.col("text")).alias("a")).collect()} == want


def test_road_texts(spark):
    rows = [("Carr. 3 Km 5 Hm 2", 5.2), ("K.M. 12,45", 12.45), ("kilómetro 7", 7.0), ("Km", None), ("", None), (None, None)]
    df = spark.createDataFrame(rows, "text string, want double")
    assert all(r.got == r.want for r in df.withColumn("got", normal.kilometre(F.col("text"))).collect())
    df = spark.createDataFrame([("0003r",), ("191",), ("000",), ("3RR",), (None,)], "n string")
    got = [tuple(r.p) for r in df.select(normal.road_parts(F.col("n")).alias("p")).collect()]
    assert got == [("3", "R", True), ("191", "", False), ("0", "", False), ("", "", False), ("", "", False)]
    bands = spark.createDataFrame([("99",), ("100",), ("9999",), ("10000",), ("0",), ("x",), (None,)], "n string").select(normal.road_band(F.col("n")).alias("b")).collect()
    assert [r.b for r in bands] == ["primary_band", "secondary_band", "tertiary_band", "unknown", "unknown", "unknown", "unknown"]


def test_conflicts_of_unnamed_roads(spark):
    schema = "route string, place string, source string, name string, class string"
    rows = [("1", None, "A", "x", None), ("1", None, "B", "y", None), (None, "p", "A", "x", None), ("", "p", "B", "y", None), ("2", "p", "A", None, None), ("2", "p", "B", "y", None), ("3", "p", "A", "x", None), ("3", "p", "A", "y", None)]
    got = linkage.road_conflicts(spark.createDataFrame(rows, schema)).collect()
    assert [(r.route, r.place, r.value_a, r.value_b) for r in got] == [("1", None, "x", "y")]
    assert linkage.road_conflicts(spark.createDataFrame([], schema)).count() == 0


def test_zones(spark):
    at = spark.createDataFrame([(1, -66.0, 18.0), (2, -66.0, 18.0 + 1 / 60), (3, None, 18.0), (1, -66.0, 18.0)], "id long, lon double, lat double")
    zones = spark.createDataFrame([(9, -66.0, 18.0, 0.5), (8, -66.0, 18.0, 1.5), (7, -66.0, 18.0, None)], "id long, lon double, lat double, radius_nm double")
    got = sorted((r.id, r.feature_id) for r in proximity.zone_entries(at, zones, 2.0).collect())
    assert got == [(1, 8), (1, 8), (1, 9), (1, 9), (2, 8)]


def test_corridors(spark):
    at = spark.createDataFrame([(1, -66.0, 18.0), (1, None, None), (1, None, None), (2, -66.0, 18.0), (2, -60.0, 10.0)], "flight_id long, lon double, lat double")
    line = (-66.5, 18.0, -65.5, 18.0)
    got = [(r.flight_id, r.n_inside, r.n_points) for r in proximity.corridors_flown(at, [("c", line, 2.0)], least=0.4).collect()]
    assert got == [(2, 1, 2)]
    d = at.where("lon = -66.0").select(proximity.line_distance_nm(F.lit(-66.0), F.lit(18.5), line, True).alias("d"), proximity.line_distance_nm(F.lit(-66.0), F.lit(18.5), line).alias("e")).first()
    assert abs(d.d - 30.02) < 0.01 and abs(d.e - d.d * math.cos(math.radians(66))) < 0.01
    point = at.limit(1).select(proximity.line_distance_nm(F.lit(-66.0), F.lit(18.5), (-66.0, 18.0, -66.0, 18.0), True).alias("d")).first()
    assert abs(point.d - 30.02) < 0.01


def test_hours_and_unknown_values(spark):
    rows = [(1, "PREPA", "2024-01-01T06:59:00+05:00", 1, None, None), (2, "PREPA", "2024-01-01T18:00:00Z", None, "H125", 101), (3, "PREPA", None, 481, "H125", 1), (4, None, "nonsense", None, None, None), (5, "PREPA", "nonsense", 480, "H125", 100)]
    got = sorted((r.flight_id, r.kind) for r in proximity.unusual(spark.createDataFrame(rows, "flight_id long, operator string, takeoff string, minutes long, aircraft_type string, n_images long")).collect())
    assert got == [(1, "unusual_time"), (2, "potential_clustering_error"), (3, "unusual_duration"), (5, "unparseable_takeoff_time")]


def test_review_queue(spark):
    rules = [validation.Rule("a", "null_field"), validation.Rule("a", "maximum", 5), validation.Rule("errors_of", "maxLength", 2)]
    r = spark.createDataFrame([("x", 1, "ab"), ("y", 9, "abc"), ("z", None, None), ("z", None, None), (None, 7, "")], "id string, a long, errors_of string")
    good, bad = validation.split(r, rules)
    assert [x.id for x in good.collect()] == ["x"] and good.columns == r.columns
    now = F.lit(datetime.datetime(2024, 1, 2)).cast("timestamp_ntz")
    new = validation.queue_rows(bad, "s", ["id"], now)
    empty = new.limit(0)
    key = lambda df: sorted((x.record_id, x.field, x.error_type) for x in df.collect())
    want = [("", "a", "maximum"), ("y", "a", "maximum"), ("y", "errors_of", "maxLength"), ("z", "a", "null_field")]
    first = validation.merged(empty, new, now)
    assert key(first) == want
    assert key(validation.merged(first, new, now)) == want
    old = first.withColumn("routed_at", F.lit(datetime.datetime(2023, 12, 31, 23)).cast("timestamp_ntz"))
    assert key(validation.merged(old, new, now)) == sorted(want * 2)
    assert validation.merged(first, empty, now).count() == 4
