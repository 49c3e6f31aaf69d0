"""Queries over normalised texts, roads, tiles, tracks near features, and the review queue of a schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed, geo, normal
from ..operators import joins, linkage, proximity, shapes, validation
from ..sources.tables import table
from .common import POINTS, hav_sql, points, rounded, site_sql, sites

SQL: dict[str, str] = {}


def _of(values, k):
    return F.element_at(F.array(*map(F.lit, values)), (k % len(values) + 1).cast("int"))


def _text(k):
    return k.cast("string")


def _zones(spark: SparkSession, sf: str) -> DataFrame:
    return sites(spark, sf, "supplier").select("id", "lon", "lat", (F.col("id") % 4 * 0.5 + 0.5).alias("radius_nm"))


def zone_entries(spark: SparkSession, sf: str) -> DataFrame:
    at = points(spark, sf).select(F.col("point_id").alias("id"), "lon", "lat")
    return rounded(proximity.zone_entries(at, _zones(spark, sf), 2.0), "distance_nm")


SQL["zone_entries"] = f"""WITH {POINTS}, {site_sql("supplier")}, d AS (SELECT point_id AS id, s.id AS feature_id, 0.5 + s.id%4*0.5 AS radius, {hav_sql("p.lon", "p.lat", "s.lon", "s.lat", geo.EARTH_NM)} AS d
 FROM pts p JOIN sites s ON abs(p.lat-s.lat) < 0.05 AND abs(p.lon-s.lon) < 0.05) SELECT id, feature_id, round(d,6) AS distance_nm FROM d WHERE d <= radius"""


def near_features(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(proximity.near_features(sites(spark, sf).select("id", "lon", "lat"), sites(spark, sf, "supplier").select("id", "lon", "lat"), 2.0), "distance_nm")


SQL["near_features"] = f"""WITH {site_sql()}, {site_sql("supplier", "others")}, d AS (SELECT a.id, b.id AS feature_id, {hav_sql("a.lon", "a.lat", "b.lon", "b.lat", geo.EARTH_NM)} AS d
 FROM sites a JOIN others b ON abs(a.lat-b.lat) < 0.05 AND abs(a.lon-b.lon) < 0.05) SELECT id, feature_id, round(d,6) AS distance_nm FROM d WHERE d <= 2.0"""


def corridors_flown(spark: SparkSession, sf: str) -> DataFrame:
    return proximity.corridors_flown(points(spark, sf), fixed.CORRIDORS)


SQL["corridors_flown"] = f"""WITH {POINTS}, c AS (SELECT * FROM (VALUES {", ".join(f"('{n}', {x1}::DOUBLE, {y1}::DOUBLE, {x2}::DOUBLE, {y2}::DOUBLE, {w}::DOUBLE)" for n, (x1, y1, x2, y2), w in fixed.CORRIDORS)}) v(corridor, x1, y1, x2, y2, w)),
 t AS (SELECT *, greatest(0.0, least(1.0, ((lon-x1)*(x2-x1)+(lat-y1)*(y2-y1))/((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1)))) AS t FROM pts, c), n AS (SELECT *, x1+t*(x2-x1) AS x, y1+t*(y2-y1) AS y FROM t),
 g AS (SELECT flight_id, corridor, count(*) AS n_points, count(*) FILTER (WHERE {hav_sql("lat", "lon", "y", "x", geo.EARTH_NM)} <= w/2+1.0) AS n_inside FROM n GROUP BY ALL)
 SELECT flight_id, n_points, corridor, n_inside FROM g WHERE n_inside > n_points*0.3"""


def unusual_flights(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    takeoff = F.when(k % 11 == 0, "at noon").when(k % 13 == 0, "").otherwise(F.concat(F.lit("2024-03-05T"), F.lpad(_text(k % 24), 2, "0"), F.lit(":15:00Z")))
    f = table(spark, sf, "orders").select(k.alias("flight_id"), _of(["PREPA", "USCG", "FURA"], k).alias("operator"), takeoff.alias("takeoff"), (F.floor("o_totalprice").cast("long") % 700).alias("minutes"), _of(["H125", "C172"], F.col("o_custkey")).alias("aircraft_type"), (k % 110).alias("n_images"))
    return proximity.unusual(f)


SQL["unusual_flights"] = """WITH f AS (SELECT o_orderkey AS k, o_orderkey%3 = 0 AS power, o_custkey%2 = 0 AS heli, CAST(floor(o_totalprice) AS BIGINT)%700 AS minutes FROM orders)
 SELECT k AS flight_id, 'unusual_time' AS kind, 'low' AS severity FROM f WHERE power AND k%11 <> 0 AND k%13 <> 0 AND (k%24 < 7 OR k%24 > 18)
 UNION ALL SELECT k, 'unparseable_takeoff_time', 'low' FROM f WHERE power AND k%11 = 0 UNION ALL SELECT k, 'unusual_duration', 'medium' FROM f WHERE heli AND minutes > 480
 UNION ALL SELECT k, 'potential_clustering_error', 'low' FROM f WHERE k%110 > 100"""


def road_refs(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    tail = F.when(k % 3 == 0, F.concat(F.lit(" Km "), _text(k % 120), F.lit(","), _text(k % 10))).when(k % 3 == 1, F.concat(F.lit(" Kilómetro "), _text(k % 90), F.lit(" Hm "), _text(k % 9))).otherwise("")
    number = F.concat(F.lit("0"), _text(k % 1200), F.when(k % 7 == 0, "r").otherwise(""))
    r = table(spark, sf, "customer").select(k.alias("id"), F.concat(F.lit("Carr. "), number, tail).alias("text"), normal.road_parts(number).alias("p"), _of(["Primaria Urbana", "Secundaria", "rural", "Expreso"], k).alias("class"))
    return r.select("id", "p.base", "p.suffix", "p.is_ramal", normal.road_band(F.col("p.base")).alias("band"), normal.kilometre(F.col("text")).alias("km"), normal.road_class(F.col("class")).alias("network"), normal.road_id(F.lit("TIGER_ROADS"), _text(F.col("id")), F.col("p.base"), F.lit(None).cast("string")).alias("road_id"))


SQL["road_refs"] = """WITH r AS (SELECT c_custkey AS id, CAST(c_custkey%1200 AS VARCHAR) AS base, c_custkey%1200 AS n, c_custkey%7 = 0 AS ramal, c_custkey AS k FROM customer)
 SELECT id, base, CASE WHEN ramal THEN 'R' ELSE '' END AS suffix, ramal AS is_ramal, CASE WHEN n BETWEEN 1 AND 99 THEN 'primary_band' WHEN n BETWEEN 100 AND 299 THEN 'secondary_band' WHEN n >= 300 THEN 'tertiary_band' ELSE 'unknown' END AS band,
 CASE k%3 WHEN 0 THEN round(k%120 + (k%10)/10.0::DOUBLE, 3) WHEN 1 THEN round(k%90 + (k%9)/10.0::DOUBLE, 3) END AS km, ['primary','secondary','tertiary',''][k%4+1] AS network,
 'road:tiger:' || substr(sha1('TIGER_ROADS|' || k || '|' || base || '|'), 1, 16) AS road_id FROM r"""


def road_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    r = table(spark, sf, "orders").select(_text(F.col("o_custkey") % 350).alias("route"), (k % 10).alias("place"), _of(["DTOP_ROUTE_DATA", "OSM_ROADS", "TIGER_ROADS"], k).alias("source"), F.concat(F.lit("ROAD "), _text(k % 4)).alias("name"), _of(["Primaria Urbana", "Secundaria", "rural", "Expreso"], k).alias("class"))
    return linkage.road_conflicts(r)


SQL["road_conflicts"] = """WITH r AS (SELECT o_custkey%350 AS n, CAST(o_custkey%350 AS VARCHAR) AS route, o_orderkey%10 AS place, ['DTOP_ROUTE_DATA','OSM_ROADS','TIGER_ROADS'][o_orderkey%3+1] AS source, 'ROAD ' || o_orderkey%4 AS name,
 ['Primaria Urbana','Secundaria','rural','Expreso'][o_orderkey%4+1] AS class, ['primary','secondary','tertiary',''][o_orderkey%4+1] AS said FROM orders),
 b AS (SELECT *, CASE WHEN n BETWEEN 1 AND 99 THEN 'primary_band' WHEN n BETWEEN 100 AND 299 THEN 'secondary_band' WHEN n >= 300 THEN 'tertiary_band' ELSE 'unknown' END AS band FROM r WHERE source = 'DTOP_ROUTE_DATA')
 SELECT 'ROUTE_NAME_VARIANCE_BY_SOURCE' AS kind, route, place, min(source) AS source_a, max(source) AS source_b, min(name) AS value_a, max(name) AS value_b, 'MEDIUM' AS severity FROM r GROUP BY route, place HAVING count(DISTINCT name) > 1 AND count(DISTINCT source) > 1
 UNION ALL SELECT 'ROUTE_BAND_CLASS_DIVERGENCE', route, place, 'ROUTE_NUMBER_BAND', source, band, class, 'LOW' FROM b WHERE said <> '' AND band <> 'unknown' AND NOT starts_with(band, said)"""


def identities(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    tail = F.when(k % 6 == 0, F.concat(F.lit(" n"), _text(k), F.lit(" ab"))).when(k % 6 == 1, " Private ").when(k % 6 == 2, "N/A").when(k % 6 == 3, F.concat(F.lit("Cessna "), _text(k))).when(k % 6 == 4, F.concat(F.lit("n-"), _text(k), F.lit("é.x")))
    c = table(spark, sf, "customer").select(k.alias("id"), tail.alias("tail"))
    return c.select("id", normal.identity(F.col("tail"))["status"].alias("status"), normal.identity(F.col("tail"))["canonical"].alias("canonical"), normal.registration(F.col("tail")).alias("registration"), normal.namespaced(F.col("tail"), "sw").alias("name"), normal.has_namespace(F.col("tail"), "sw").alias("has_namespace"))


SQL["identities"] = """WITH c AS (SELECT c_custkey AS id, c_custkey%6 AS m, CAST(c_custkey AS VARCHAR) AS k FROM customer)
 SELECT id, CASE m WHEN 0 THEN 'tail_candidate' WHEN 3 THEN 'unresolved_text' WHEN 4 THEN 'tail_candidate' ELSE 'masked_or_unresolved' END AS status, CASE m WHEN 0 THEN 'N' || k || 'AB' WHEN 3 THEN 'Cessna ' || k WHEN 4 THEN 'N-' || k || 'É.X' END AS canonical,
 CASE m WHEN 0 THEN 'N' || k || 'AB' WHEN 1 THEN 'PRIVATE' WHEN 2 THEN 'NA' WHEN 3 THEN 'CESSNA' || k WHEN 4 THEN 'N' || k || 'EX' ELSE '' END AS registration,
 CASE m WHEN 0 THEN 'sw:n' || k || ' ab' WHEN 1 THEN 'sw:Private' WHEN 2 THEN 'sw:N/A' WHEN 3 THEN 'sw:Cessna ' || k WHEN 4 THEN 'sw:n-' || k || 'é.x' END AS name, false AS has_namespace FROM c"""


def tile_frames(spark: SparkSession, sf: str) -> DataFrame:
    x, y = geo.xyz_tile(F.col("lon"), F.col("lat"), 12)
    t = sites(spark, sf).select(x.alias("x"), y.alias("y")).distinct()
    x, y = F.col("x"), F.col("y")
    out = dict(zip(("corner_lon", "corner_lat"), geo.tile_corner(x, y, 12), strict=True)) | dict(zip(("center_lon", "center_lat"), geo.tile_center(x, y, 12), strict=True)) | dict(zip(("west", "south", "east", "north"), geo.tile_bounds_mercator(x, y, 12), strict=True))
    around = geo.tile_neighbors(x, y, 12)
    return t.select("x", "y", *(F.round(c, 6).alias(n) for n, c in out.items()), F.size(around).cast("long").alias("n_around"), F.size(geo.tile_neighbors(x * 0, y, 12, False)).cast("long").alias("n_at_edge"))


SQL["tile_frames"] = f"""WITH {site_sql()}, t AS (SELECT DISTINCT CAST(floor((lon+180.0)/360.0*4096.0) AS BIGINT) AS x, CAST(floor((1.0-ln(tan(radians(lat))+1.0/cos(radians(lat)))/pi())/2.0*4096.0) AS BIGINT) AS y FROM sites),
 u AS (SELECT *, degrees(atan(sinh(pi()*(1.0-2.0*y/4096.0)))) AS top, degrees(atan(sinh(pi()*(1.0-2.0*(y+1)/4096.0)))) AS bottom, x/4096.0*360.0-180.0 AS l, (x+1)/4096.0*360.0-180.0 AS r, 2*{geo.MERCATOR_HALF}::DOUBLE/4096 AS s FROM t)
 SELECT x, y, round(l,6) AS corner_lon, round(top,6) AS corner_lat, round((l+r)/2,6) AS center_lon, round((top+bottom)/2,6) AS center_lat, round(x*s-{geo.MERCATOR_HALF}::DOUBLE,6) AS west, round({geo.MERCATOR_HALF}::DOUBLE-y*s-s,6) AS south,
 round(x*s-{geo.MERCATOR_HALF}::DOUBLE+s,6) AS east, round({geo.MERCATOR_HALF}::DOUBLE-y*s,6) AS north, 8::BIGINT AS n_around, 3::BIGINT AS n_at_edge FROM u"""


def image_boxes(spark: SparkSession, sf: str) -> DataFrame:
    at = sites(spark, sf).select("id", (F.col("lon") + F.col("id") % 3).alias("lon"), "lat")
    box = geo.box_around(F.col("lon"), F.col("lat"), 0.5)
    inside = geo.clamped(box, geo.IMAGE_BOX)
    return at.select("id", geo.boxes_meet(box, [F.lit(v) for v in geo.IMAGE_BOX]).alias("meets"), *(F.round(c, 6).alias(n) for c, n in zip(inside, ("west", "south", "east", "north"), strict=True)))


SQL["image_boxes"] = f"""WITH {site_sql()}, p AS (SELECT id, lon + id%3 AS lon, lat FROM sites) SELECT id, lon+0.5 >= -68.2 AND lon-0.5 <= -65.1 AND lat+0.5 >= 17.8 AND lat-0.5 <= 18.7 AS meets,
 round(least(greatest(lon-0.5, -68.2::DOUBLE), -65.1::DOUBLE),6) AS west, round(least(greatest(lat-0.5, 17.8::DOUBLE), 18.7::DOUBLE),6) AS south, round(least(greatest(lon+0.5, -68.2::DOUBLE), -65.1::DOUBLE),6) AS east, round(least(greatest(lat+0.5, 17.8::DOUBLE), 18.7::DOUBLE),6) AS north FROM p"""


RULES = [
    validation.Rule("mission", "enum", ["1-URGENT", "2-HIGH", "3-MEDIUM"]),
    validation.Rule("price", "minimum", 50_000),
    validation.Rule("price", "maximum", 300_000),
    validation.Rule("callsign", "null_field"),
    validation.Rule("callsign", "pattern", "^N[0-9]+$"),
    validation.Rule("callsign", "minLength", 3),
]


def review_queue(spark: SparkSession, sf: str) -> DataFrame:
    """What a batch of orders adds to a queue that has some of the same errors, a part of them more than a day old."""
    k = F.col("o_orderkey")
    now = F.lit("2024-03-05 12:00:00").cast("timestamp_ntz")
    r = table(spark, sf, "orders").select(k.alias("flight_id"), F.when(k % 9 == 0, None).when(k % 7 == 0, "X1").otherwise(F.concat(F.lit("N"), _text(F.col("o_custkey")))).alias("callsign"), F.col("o_orderpriority").alias("mission"), F.floor("o_totalprice").cast("long").alias("price"))
    _, bad = validation.split(r, RULES)
    new = validation.queue_rows(bad, "flight", ["flight_id"], now)
    old = new.where("record_id % 4 < 2").withColumn("routed_at", now - F.make_dt_interval(F.lit(0), F.when(F.col("record_id") % 4 == 0, 5).otherwise(30)))
    return validation.merged(old, new, now).select("record_id", "field", "error_type", "suggested_fix", (F.col("routed_at") == now).alias("is_new"))


SQL["review_queue"] = """WITH r AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey%9 = 0 THEN NULL WHEN o_orderkey%7 = 0 THEN 'X1' ELSE 'N' || o_custkey END AS callsign, o_orderpriority AS mission, CAST(floor(o_totalprice) AS BIGINT) AS price FROM orders),
 e AS (SELECT k, 'mission' AS field, 'enum' AS error_type, 'use an allowed enum value' AS suggested_fix FROM r WHERE mission NOT IN ('1-URGENT','2-HIGH','3-MEDIUM')
 UNION ALL SELECT k, 'price', 'minimum', 'increase the value to meet the minimum' FROM r WHERE price < 50000 UNION ALL SELECT k, 'price', 'maximum', 'decrease the value to meet the maximum' FROM r WHERE price > 300000
 UNION ALL SELECT k, 'callsign', 'null_field', 'field is required — supply a non-null value (T2-19)' FROM r WHERE callsign IS NULL UNION ALL SELECT k, 'callsign', 'pattern', 'match the required pattern' FROM r WHERE NOT regexp_full_match(callsign, 'N[0-9]+')
 UNION ALL SELECT k, 'callsign', 'minLength', 'provide a longer value' FROM r WHERE length(callsign) < 3)
 SELECT CAST(k AS VARCHAR) AS record_id, field, error_type, suggested_fix, false AS is_new FROM e WHERE k%4 < 2 UNION ALL SELECT CAST(k AS VARCHAR), field, error_type, suggested_fix, true FROM e WHERE k%4 <> 0"""


def postal_designations(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    raw = F.when(k % 4 == 0, F.concat(F.lit(" hc  "), _text(k % 90), F.lit("\tBox "), _text(k))).when(k % 4 == 1, F.concat(F.lit("RR "), _text(k % 90), F.lit("b"))).when(k % 4 == 2, F.concat(F.lit("Rural Route HC "), _text(k % 90), F.lit(" 12"))).otherwise(F.concat(F.lit("Calle "), _text(k)))
    c = table(spark, sf, "customer").select(k.alias("id"), normal.designation(raw).alias("d"))
    return c.select("id", "d.*", normal.binding_eligible(F.col("d.state"), _of(["USPS", "none"], F.col("id")), F.when(F.col("id") % 5 != 0, "r1"), F.lit(" s")).alias("eligible"))


SQL["postal_designations"] = """WITH c AS (SELECT c_custkey AS id, c_custkey%4 AS m, CAST(c_custkey%90 AS VARCHAR) AS n FROM customer)
 SELECT id, CASE m WHEN 1 THEN 'RR' WHEN 3 THEN NULL ELSE 'HC' END AS kind, CASE m WHEN 1 THEN n || 'B' WHEN 3 THEN NULL ELSE n END AS route, CASE m WHEN 0 THEN CAST(id AS VARCHAR) WHEN 2 THEN '12' END AS box,
 CASE m WHEN 0 THEN 'HC ' || n || ' BOX ' || id WHEN 1 THEN 'RR ' || n || 'B' WHEN 2 THEN 'HC ' || n || ' BOX 12' END AS normalized, ['candidate','candidate','ambiguous','unrecognized'][m+1] AS state, m < 2 AND id%2 = 0 AND id%5 <> 0 AS eligible FROM c"""


def turn_texts(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "conversations")
    return c.select("conv_id", "turn", F.md5(normal.clean_query(F.col("text"), 100)).alias("query_md5"), F.md5(normal.cut_context(F.col("text"), 50)).alias("context_md5"))


SQL["turn_texts"] = r"""SELECT conv_id, turn, md5(substr(regexp_replace(regexp_replace(text, '[\x00-\x08\x0B-\x1F]', '', 'g'), '^\s+|\s+$', '', 'g'), 1, 100)) AS query_md5,
 md5(CASE WHEN length(text) > 50 THEN substr(text, 1, 50) || chr(10) || '... [context truncated]' ELSE text END) AS context_md5 FROM conversations"""


CASES = ["Fue hallada sana y salva, edad {a}", "No ha sido localizada; tiene {a} años", "Encontrado fallecido tras buscarlo hace {b} años", "Lleva casi {b} años perdida, dijo ayer su madre; cumplía {a} años", "Aún no la han encontrado", "Cadáver hallado. Edad: {a}", "Desapareció hace {b} años tiene {a} años", "Desde hace unos {b} años; el joven de {a} años, o {b} años"]
STATES = ["resolved_alive", "active", "resolved_deceased", "active", "active", "resolved_deceased", "active", "active"]


def case_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Status and age of reports whose sentences name one or two numbers of years."""
    k = F.col("c_custkey")
    text = F.when(k % 9 < 8, F.element_at(F.array(*map(F.lit, CASES)), (k % 9 % 8 + 1).cast("int")))
    text = F.replace(F.replace(text, F.lit("{a}"), _text(k % 97)), F.lit("{b}"), _text(k % 31))
    c = table(spark, sf, "customer").select(k.alias("id"), text.alias("text"))
    return c.select("id", normal.case_status(F.col("text")).alias("status"), normal.age(F.col("text")).alias("age"))


# The rule for years is computed: all numbers of years in turn, and for each what stands in the 30 characters before it.
SQL["case_fields"] = f"""WITH c AS (SELECT c_custkey AS id, CASE WHEN c_custkey%9 < 8 THEN replace(replace({CASES}[c_custkey%9+1], '{{a}}', CAST(c_custkey%97 AS VARCHAR)), '{{b}}', CAST(c_custkey%31 AS VARCHAR)) END AS t FROM customer),
 p AS (SELECT id, lower(strip_accents(t)) AS t, regexp_split_to_array(lower(strip_accents(t)), '[0-9]{{1,3}}\\s*anos') AS h, regexp_extract_all(lower(strip_accents(t)), '[0-9]{{1,3}}\\s*anos') AS m FROM c),
 w AS (SELECT id, i, regexp_extract(m[i], '[0-9]+') AS n, right(list_reduce(list_prepend('', list_transform(range(1, i+1), lambda j: h[j] || CASE WHEN j < i THEN m[j] ELSE '' END)), lambda x, y: x || y), 30) AS before FROM (SELECT *, unnest(range(1, len(m)+1)) AS i FROM p)),
 a AS (SELECT id, min_by(n, i) AS n FROM w WHERE NOT regexp_matches(before, '\\b(hace|lleva|desde|por)\\b(\\s+\\w+){{0,3}}\\s*$') GROUP BY id)
 SELECT id, CASE WHEN t IS NULL THEN 'active' ELSE {STATES}[id%9+1] END AS status, CASE WHEN t IS NULL THEN '' WHEN regexp_matches(t, 'edad\\s*:?\\s*[0-9]') THEN regexp_extract(t, 'edad\\s*:?\\s*([0-9]{{1,3}})', 1) ELSE coalesce(a.n, '') END AS age FROM p LEFT JOIN a USING (id)"""


def polygon_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as boxes on a grid of whole numbers, against themselves in other sizes."""
    k, q = F.col("s_suppkey"), lambda m, n: F.floor((F.col("s_suppkey") * m % n) / 20).cast("double")
    at = table(spark, sf, "supplier").select(k.alias("polygon_id"), q(37, 1800).alias("x0"), q(53, 700).alias("y0"))
    boxed = lambda w, h: joins.boxes_as_edges(at.withColumns({"x1": F.col("x0") + w, "y1": F.col("y0") + h}))
    return shapes.relations(boxed(F.col("polygon_id") % 3 + 1, F.lit(2)), boxed(F.lit(2), F.col("polygon_id") % 4 + 1), 4.0)


SQL["polygon_pairs"] = """WITH p AS (SELECT s_suppkey AS id, (s_suppkey*37%1800)//20 AS x, (s_suppkey*53%700)//20 AS y FROM supplier), a AS (SELECT id, x AS x0, y AS y0, x+id%3+1 AS x1, y+2 AS y1 FROM p), b AS (SELECT id, x AS x0, y AS y0, x+2 AS x1, y+id%4+1 AS y1 FROM p),
 j AS (SELECT a.id, b.id AS other_id, a.x0 < b.x1 AND b.x0 < a.x1 AND a.y0 < b.y1 AND b.y0 < a.y1 AS shared, a.x0 <= b.x0 AND a.y0 <= b.y0 AND a.x1 >= b.x1 AND a.y1 >= b.y1 AS has, b.x0 <= a.x0 AND b.y0 <= a.y0 AND b.x1 >= a.x1 AND b.y1 >= a.y1 AS isin
 FROM a JOIN b ON a.x0 <= b.x1 AND b.x0 <= a.x1 AND a.y0 <= b.y1 AND b.y0 <= a.y1) SELECT id, other_id, true AS intersects, has AS contains, isin AS within, NOT shared AS touches, false AS crosses, shared AND NOT has AND NOT isin AS overlaps FROM j"""


QUERIES = {f.__name__: f for f in (zone_entries, near_features, corridors_flown, unusual_flights, road_refs, road_conflicts, identities, tile_frames, image_boxes, review_queue, postal_designations, turn_texts, case_fields, polygon_pairs)}
