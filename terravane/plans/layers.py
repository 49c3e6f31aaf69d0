"""Queries over layers: candidates and their intake, areas, joins and grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed, geo
from ..functions.texts import time_key
from ..operators import area as R
from ..operators import intake as I
from ..operators import joins as J
from ..sources.tables import table
from .common import FLIGHTS, POINTS, flights, hav_sql, near_sql, points, rounded, rounded_half, site_sql, sites

SQL: dict[str, str] = {}


def _class_sql(lon: str, lat: str) -> str:
    x0, y0, x1, y1 = fixed.REGION
    km = f"({near_sql(lon, lat, fixed.MUNICIPAL_CENTRES)}*111.0)"
    return f"CASE WHEN NOT ({lon} BETWEEN {x0} AND {x1} AND {lat} BETWEEN {y0} AND {y1}) THEN 'MBIL-X' WHEN {km} < 5.0 THEN 'MBIL-3' WHEN {km} < 10.0 THEN 'MBIL-2' WHEN {km} < 15.0 THEN 'MBIL-1' ELSE 'MBIL-0' END"


def ilap_pins(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(I.places(points(spark, sf)), "lon", "lat", "loiter", "recurrence", "alignment", "confidence").drop("priority")


_PINS = f"""{POINTS}, cells AS (SELECT CAST(trunc(lat/0.05) AS BIGINT) AS lat_cell, CAST(trunc(lon/0.05) AS BIGINT) AS lon_cell, count(*) AS n_points, count(DISTINCT flight_id) AS n_flights,
 avg(lon) AS lon, avg(lat) AS lat, avg(CASE WHEN speed_mph < 50 THEN 1.0 ELSE 0.0 END) AS loiter, var_pop(lat) AS xx, var_pop(lon) AS yy, covar_pop(lat,lon) AS xy FROM pts GROUP BY 1, 2
 HAVING count(*) >= 3 AND count(DISTINCT flight_id) >= 2),
 pins0 AS (SELECT *, least(1.0::DOUBLE, n_flights/10.0::DOUBLE) AS recurrence, CASE WHEN xx+yy <= 0 THEN 0.0::DOUBLE ELSE greatest(0.0, least(1.0, 2.0*sqrt(greatest(0.0, ((xx-yy)/2.0)*((xx-yy)/2.0)+xy*xy))/(xx+yy))) END AS alignment,
 {_class_sql("lon", "lat")} AS nearness FROM cells),
 pins AS (SELECT *, 0.30*recurrence + 0.25*loiter + 0.20*alignment + 0.15*0.2 + 0.10*(CASE nearness WHEN 'MBIL-3' THEN 1.0 WHEN 'MBIL-2' THEN 0.75 WHEN 'MBIL-1' THEN 0.5 ELSE 0.0 END) AS confidence FROM pins0)"""
SQL["ilap_pins"] = f"""WITH {_PINS} SELECT lat_cell, lon_cell, n_points, n_flights, round(lon,6) AS lon, round(lat,6) AS lat, round(loiter,6) AS loiter, round(recurrence,6) AS recurrence,
 round(alignment,6) AS alignment, nearness, round(confidence,6) AS confidence FROM pins"""


def route_edges(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(I.route_edges(flights(spark, sf)), "mean_minutes", "confidence")


_EDGES = f"""{FLIGHTS}, e1 AS (SELECT origin, dest, callsign, count(*) AS n, sum(minutes) AS m FROM flights WHERE origin <> dest GROUP BY ALL),
 e2 AS (SELECT *, row_number() OVER (PARTITION BY origin, dest ORDER BY n DESC, callsign) AS r FROM e1),
 edges AS (SELECT origin, dest, CAST(sum(n) AS BIGINT) AS n_flights, CAST(sum(m) AS DOUBLE)/sum(n) AS mean_minutes, max(callsign) FILTER (r = 1) AS callsign, least(1.0::DOUBLE, sum(n)/5.0::DOUBLE) AS confidence FROM e2 GROUP BY 1, 2)"""
SQL["route_edges"] = f"WITH {_EDGES} SELECT origin, dest, n_flights, round(mean_minutes,6) AS mean_minutes, callsign, round(confidence,6) AS confidence FROM edges"


def _ends(spark: SparkSession, sf: str) -> DataFrame:
    return sites(spark, sf, "supplier").select("id", "lon", "lat")


def route_corridors(spark: SparkSession, sf: str) -> DataFrame:
    return I.spelled_corridors(rounded(I.corridor_groups(_ends(spark, sf), flights(spark, sf)), "lon", "lat"))


SQL["route_corridors"] = f"""WITH {FLIGHTS}, {site_sql("supplier")},
 o AS (SELECT flight_id, id AS origin FROM flights f JOIN sites s ON abs(f.origin_lon-s.lon) <= 0.1 AND abs(f.origin_lat-s.lat) <= 0.1),
 d AS (SELECT flight_id, id AS dest FROM flights f JOIN sites s ON abs(f.dest_lon-s.lon) <= 0.1 AND abs(f.dest_lat-s.lat) <= 0.1),
 p AS (SELECT least(o.origin,d.dest) AS place_a, greatest(o.origin,d.dest) AS place_b, count(*) AS connecting FROM o JOIN d USING (flight_id) WHERE o.origin <> d.dest GROUP BY 1, 2 HAVING count(*) >= 2),
 m AS (SELECT place_a, place_b, (a.lon+b.lon)/2.0 AS lon, (a.lat+b.lat)/2.0 AS lat, connecting FROM p JOIN sites a ON a.id=place_a JOIN sites b ON b.id=place_b)
 SELECT place_a, place_b, round(lon,6) AS lon, round(lat,6) AS lat, connecting, CASE WHEN connecting >= 5 THEN 'HIGH' WHEN connecting >= 3 THEN 'MEDIUM' ELSE 'LOW' END AS label, {_class_sql("lon", "lat")} AS nearness FROM m"""


def _others(spark: SparkSession, sf: str) -> DataFrame:
    """Places, flights and sites as one relation."""
    none = lambda t: F.lit(None).cast(t)
    pins = I.places(points(spark, sf)).select(F.concat_ws("_", F.lit("P"), F.col("lat_cell").cast("string"), F.col("lon_cell").cast("string")).alias("id"), F.lit("poi").alias("kind"), "lon", "lat", "confidence", none("string").alias("corridor_id"), none("long").alias("connecting"), none("double").alias("alignment"))
    f = flights(spark, sf)
    paths = f.select(F.concat(F.lit("F_"), F.col("flight_id").cast("string")).alias("id"), F.lit("ilap").alias("kind"), F.col("origin_lon").alias("lon"), F.col("origin_lat").alias("lat"), ((F.col("flight_id") % 100) / 100.0).alias("confidence"), F.concat(F.lit("ILAP_"), F.col("flight_id").cast("string")).alias("corridor_id"), none("long").alias("connecting"), ((F.col("flight_id") % 100) / 100.0).alias("alignment"))
    s = sites(spark, sf).select(F.concat(F.lit("S_"), F.col("id").cast("string")).alias("id"), F.lit("poi").alias("kind"), "lon", "lat", ((F.col("id") % 97) / 97.0).alias("confidence"), none("string").alias("corridor_id"), none("long").alias("connecting"), none("double").alias("alignment"))
    return pins.unionByName(paths).unionByName(s)


def _corridor(place_a: Column, place_b: Column) -> list[Column]:
    """A corridor as a candidate; its two places may be any of those at its ends, as all numbers stand for the same."""
    both = lambda sep, *more: F.concat_ws(sep, *more, place_a.cast("string"), place_b.cast("string"))
    return [both("_", F.lit("C")).alias("id"), F.lit("corridor").alias("kind"), F.col("lon"), F.col("lat"), F.least(F.lit(1.0), F.col("connecting") / 5.0).alias("confidence"), both("|").alias("corridor_id"), F.col("connecting"), F.lit(None).cast("double").alias("alignment")]


def _counted(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates with n_rows: one row for all corridors between two coordinates."""
    pairs = I.corridor_classes(_ends(spark, sf), flights(spark, sf))
    return _others(spark, sf).withColumn("n_rows", F.lit(1).cast("long")).unionByName(pairs.select(*_corridor(F.col("a"), F.col("b")), F.col("n_pairs").alias("n_rows")))


def intake(spark: SparkSession, sf: str) -> DataFrame:
    def judged(c: DataFrame) -> DataFrame:
        return I.tiers(I.context(c.withColumn("confidence", F.round("confidence", 4)))).withColumn("boundary_m", F.round("boundary_m", 1))

    names = ["id", "kind", "confidence", "nearness", "water", "utility", "terrain", "role", "assertion", "boundary_m", "corridor_flag", "tier", "fact_status", "review_status"]
    # Corridors between the same two coordinates are judged once and spelled out last.
    groups = I.corridor_groups(_ends(spark, sf), flights(spark, sf))
    pairs = judged(groups.select("a", "b", "alone", *_corridor(F.get("a", F.lit(0)), F.get("b", F.lit(0)))))
    rows = I.spelled_corridors(pairs.select("a", "b", "alone", *names[1:])).select(F.concat_ws("_", F.lit("C"), F.col("place_a").cast("string"), F.col("place_b").cast("string")).alias("id"), *names[1:])
    return judged(_others(spark, sf)).select(*names).unionByName(rows)


def _terrain_sql() -> str:
    box = lambda b: f"(lon BETWEEN {b[0]} AND {b[2]} AND lat BETWEEN {b[1]} AND {b[3]})"
    return f"CASE WHEN NOT lat BETWEEN {fixed.REGION[1]} AND {fixed.REGION[3]} THEN 'offshore' WHEN {' OR '.join(map(box, fixed.TOWNS))} THEN 'urban' WHEN lon <= {fixed.REGION[0]} OR lon >= {fixed.REGION[2]} THEN 'coastal' ELSE 'inland' END"


_CORR = SQL["route_corridors"].split("SELECT place_a, place_b, round")[0].replace("WITH ", "", 1).replace(FLIGHTS + ",", "", 1)
_CAND = f"""{_PINS}, {FLIGHTS}, {_CORR}, {site_sql("customer", "cust")},
 cand0 AS (SELECT 'P_' || CAST(lat_cell AS VARCHAR) || '_' || CAST(lon_cell AS VARCHAR) AS id, 'poi' AS kind, lon, lat, confidence, NULL::VARCHAR AS corridor_id, NULL::BIGINT AS connecting, NULL::DOUBLE AS alignment FROM pins UNION ALL
 SELECT 'F_' || CAST(flight_id AS VARCHAR), 'ilap', origin_lon, origin_lat, (flight_id%100)/100.0::DOUBLE, 'ILAP_' || CAST(flight_id AS VARCHAR), NULL, (flight_id%100)/100.0::DOUBLE FROM flights UNION ALL
 SELECT 'C_' || CAST(place_a AS VARCHAR) || '_' || CAST(place_b AS VARCHAR), 'corridor', lon, lat, least(1.0::DOUBLE, connecting/5.0::DOUBLE), CAST(place_a AS VARCHAR) || '|' || CAST(place_b AS VARCHAR), connecting, NULL FROM m UNION ALL
 SELECT 'S_' || CAST(id AS VARCHAR), 'poi', lon, lat, (id%97)/97.0::DOUBLE, NULL, NULL, NULL FROM cust),
 cand AS (SELECT * REPLACE (round(confidence,4) AS confidence), {_class_sql("lon", "lat")} AS nearness, CASE WHEN {near_sql("lon", "lat", fixed.WATER)} <= 0.08 THEN 'yes' ELSE 'no' END AS water,
 CASE WHEN {near_sql("lon", "lat", fixed.UTILITY)} <= 0.05 THEN 'yes' ELSE 'no' END AS utility, {_terrain_sql()} AS terrain,
 CASE kind WHEN 'ilap' THEN 'path' WHEN 'corridor' THEN 'edge' WHEN 'aasb_edge' THEN 'airport_link' ELSE 'node' END AS role,
 CASE WHEN kind = 'aasb_edge' OR regexp_matches(upper(coalesce(corridor_id,'')), '{"|".join(fixed.AIRPORTS)}') THEN 'public_record' ELSE 'derived_observation' END AS assertion,
 round({near_sql("lon", "lat", fixed.MUNICIPAL_CENTRES)}*111000.0,1) AS boundary_m FROM cand0),
 t1 AS (SELECT *, kind = 'corridor' AND nearness IN ('MBIL-2','MBIL-3') AS corridor_flag, (water='yes')::INT + (utility='yes')::INT + (corridor_id IS NOT NULL)::INT AS n_other FROM cand),
 t2 AS (SELECT *, CASE WHEN confidence >= 0.65 AND n_other + (nearness IN ('MBIL-1','MBIL-2','MBIL-3'))::INT >= 2 THEN 'T1' WHEN kind='corridor' AND coalesce(connecting,0) >= 2 THEN 'T3'
 WHEN confidence >= 0.40 OR coalesce(alignment,0.0) > 0.5 THEN 'T2' ELSE 'T4' END AS base FROM t1),
 t3 AS (SELECT *, CASE WHEN n_other = 0 AND nearness IN ('MBIL-2','MBIL-3') AND base IN ('T1','T2') THEN 'T3' ELSE base END AS tier FROM t2),
 tiered AS (SELECT *, CASE WHEN confidence >= 0.65 AND n_other >= 2 THEN 'observed' ELSE 'inferred' END AS fact_status,
 CASE WHEN tier IN ('T1','T2') THEN 'accepted' WHEN tier = 'T4' AND confidence < 0.25 THEN 'rejected' ELSE 'manual_review' END AS review_status FROM t3)"""
SQL["intake"] = f"WITH {_CAND} SELECT id, kind, confidence, nearness, water, utility, terrain, role, assertion, boundary_m, corridor_flag, tier, fact_status, review_status FROM tiered"


def gap_audit(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(I.gap_audit(I.context(_counted(spark, sf))), "share_mbil_0")


SQL["gap_audit"] = f"""WITH {_CAND} SELECT count(*) AS total, count(*) FILTER (corridor_id IS NULL AND kind = 'poi') AS isolated, count(*) FILTER (water='no' AND utility='no') AS no_water_or_utility,
 count(*) FILTER (kind='ilap' AND coalesce(alignment,0.0) < 0.3) AS unclustered, count(*) FILTER (nearness='MBIL-0') AS mbil_0, round(count(*) FILTER (nearness='MBIL-0')/count(*)::DOUBLE,6) AS share_mbil_0 FROM tiered"""


def tier_distribution(spark: SparkSession, sf: str) -> DataFrame:
    c = I.tiers(I.context(_counted(spark, sf).withColumn("confidence", F.round("confidence", 4))))
    return I.distribution(c, ["tier", "nearness", "terrain", "review_status"])


SQL["tier_distribution"] = f"WITH {_CAND} " + " UNION ALL ".join(f"SELECT '{c}' AS field, {c} AS value, count(*) AS n FROM tiered GROUP BY {c}" for c in ("tier", "nearness", "terrain", "review_status"))


def intake_greedy_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Greedy, so without SQL; tests/test_operators.py holds it against a plain loop."""
    return I.greedy_duplicates(sites(spark, sf).select(F.col("id").alias("ord"), "lon", "lat"), 0.0101)


RING = [(-67.0, 18.0), (-66.0, 17.95), (-65.8, 18.3), (-66.4, 18.5), (-66.9, 18.4), (-67.0, 18.0)]
HOLE = [(-66.5, 18.15), (-66.3, 18.15), (-66.3, 18.3), (-66.5, 18.3), (-66.5, 18.15)]


def aoi_bbox(spark: SparkSession, sf: str) -> DataFrame:
    return R.select(sites(spark, sf), R.box((-66.5, 18.0, -66.0, 18.4)))[0].select("id", "lon", "lat")


SQL["aoi_bbox"] = f"WITH {site_sql()} SELECT id, lon, lat FROM sites WHERE lon BETWEEN -66.5 AND -66.0 AND lat BETWEEN 18.0 AND 18.4 ORDER BY id LIMIT 500"


def aoi_radius(spark: SparkSession, sf: str) -> DataFrame:
    return R.select(sites(spark, sf), R.circle(-66.1, 18.4, 20_000.0))[0].select("id", "lon", "lat")


SQL["aoi_radius"] = f"WITH {site_sql()} SELECT id, lon, lat FROM sites WHERE {hav_sql('lon', 'lat', '-66.1', '18.4', geo.EARTH_M)} <= 20000.0 ORDER BY id LIMIT 500"


def _inside_sql(ring) -> str:
    parts = []
    for (ax, ay), (bx, by) in zip(ring, ring[1:], strict=False):
        if ay != by:
            parts.append(f"(CASE WHEN ({ay} > lat) <> ({by} > lat) AND lon < {ax} + (lat-({ay}))*({bx}-({ax}))::DOUBLE/({by}-({ay})) THEN 1 ELSE 0 END)")
    return f"(({' + '.join(parts)}) % 2 = 1)"


def aoi_polygon(spark: SparkSession, sf: str) -> DataFrame:
    """Boundary points belong to the area; the ring's points are off the sites' lattice, so SQL needs no edge case."""
    return R.select(sites(spark, sf).withColumns({"lon": F.col("lon") + 0.00037, "lat": F.col("lat") + 0.00041}), R.polygon([RING, HOLE]), limit=100_000)[0].select("id")


SQL["aoi_polygon"] = f"WITH {site_sql('customer', 's0')}, sites AS (SELECT id, lon + 0.00037 AS lon, lat + 0.00041 AS lat FROM s0) SELECT id FROM sites WHERE {_inside_sql(RING)} AND NOT {_inside_sql(HOLE)} ORDER BY id LIMIT 100000"


def aoi_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Matched, returned and excluded in an area and a time given as partial dates."""
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    layer = o.select(k.alias("id"), geo.key_lon(k).alias("lon"), F.when(k % 11 != 0, geo.key_lat(k)).alias("lat"), F.when(k % 13 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("unknown").alias("seen"))
    return R.select(layer, R.box((-66.5, 18.0, -66.0, 18.4)), "seen", "1996", "1998-02")[1]


SQL["aoi_ledger"] = """WITH l AS (SELECT o_orderkey AS id, -67.3 + CAST((o_orderkey*37)%1800 AS DOUBLE)/1000.0 AS lon, CASE WHEN o_orderkey % 11 <> 0 THEN 17.9 + CAST((o_orderkey*53)%700 AS DOUBLE)/1000.0 END AS lat,
 CASE WHEN o_orderkey % 13 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00' END AS k FROM orders),
 u AS (SELECT *, lat IS NOT NULL AND k IS NOT NULL AS usable FROM l), h AS (SELECT *, usable AND k >= '1996-01-01T00:00:00' AND k <= '1998-02-29T23:59:59' AND lon BETWEEN -66.5 AND -66.0 AND lat BETWEEN 18.0 AND 18.4 AS hit FROM u)
 SELECT count(*) FILTER (hit) AS matched, least(count(*) FILTER (hit), 500) AS returned, count(*) FILTER (NOT usable) AS excluded, count(*) FILTER (hit) > 500 AS truncated FROM h"""


def identify(spark: SparkSession, sf: str) -> DataFrame:
    return R.identify(sites(spark, sf), -66.2, 18.3, 15_000.0).select("id", F.round("distance_m", 4).alias("distance_m"))


SQL["identify"] = f"WITH {site_sql()}, d AS (SELECT id, {hav_sql('lon', 'lat', '-66.2', '18.3', geo.EARTH_M)} AS d FROM sites) SELECT id, round(d,4) AS distance_m FROM d WHERE d <= 15000.0 ORDER BY d, id LIMIT 10"


def search_rank(spark: SparkSession, sf: str) -> DataFrame:
    layer = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), "p_name", "p_type")
    return R.search(layer, "ring", ["p_name", "p_type"], limit=100)


SQL["search_rank"] = """WITH f AS (SELECT p_partkey AS id, 0 AS i, 'p_name' AS field, p_name AS value FROM part UNION ALL SELECT p_partkey, 1, 'p_type', p_type FROM part),
 r AS (SELECT *, CASE WHEN lower(value) = 'ring' THEN 0 WHEN starts_with(lower(value),'ring') THEN 1 WHEN contains(' ' || lower(value), ' ring') THEN 2 WHEN contains(lower(value),'ring') THEN 3 END AS rank FROM f),
 b AS (SELECT * FROM r WHERE rank IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY rank, i) = 1) SELECT id, rank, field, value FROM b ORDER BY rank, id LIMIT 100"""


def summarize(spark: SparkSession, sf: str) -> DataFrame:
    return R.summarize(table(spark, sf, "part"), ["p_type", "p_brand"])


SQL["summarize"] = "SELECT 'p_type' AS field, coalesce(nullif(p_type,''),'(missing)') AS value, count(*) AS n FROM part GROUP BY ALL UNION ALL SELECT 'p_brand', coalesce(nullif(p_brand,''),'(missing)'), count(*) FROM part GROUP BY ALL"


def time_filter_partial(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    said = F.when(k % 3 == 0, F.substring(day, 1, 4)).when(k % 3 == 1, F.substring(day, 1, 7)).otherwise(day)
    return table(spark, sf, "orders").select(k.alias("id"), time_key(said).alias("lower"), time_key(said, upper=True).alias("upper"))


SQL["time_filter_partial"] = """WITH s AS (SELECT o_orderkey AS id, strftime(o_orderdate,'%Y') AS y, CASE WHEN o_orderkey%3 > 0 THEN strftime(o_orderdate,'%m') END AS m, CASE WHEN o_orderkey%3 = 2 THEN strftime(o_orderdate,'%d') END AS d FROM orders)
 SELECT id, y || '-' || coalesce(m,'01') || '-' || coalesce(d,'01') || 'T00:00:00' AS lower,
 y || '-' || coalesce(m,'12') || '-' || coalesce(d, CASE coalesce(m,'12') WHEN '02' THEN '29' WHEN '04' THEN '30' WHEN '06' THEN '30' WHEN '09' THEN '30' WHEN '11' THEN '30' ELSE '31' END) || 'T23:59:59' AS upper FROM s"""


def _boxes(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("n_nationkey")
    x, y = F.lit(-67.30005) + ((k % 5) * 360).cast("double") / 1000.0, F.lit(17.90005) + (F.floor(k / 5) * 140).cast("double") / 1000.0
    return table(spark, sf, "nation").select(k.alias("polygon_id"), x.alias("x0"), y.alias("y0"), (x + 0.4).alias("x1"), (y + 0.2).alias("y1"))


_BOXES = "boxes AS (SELECT n_nationkey AS polygon_id, -67.30005 + CAST((n_nationkey%5)*360 AS DOUBLE)/1000.0 AS x0, 17.90005 + CAST((n_nationkey//5)*140 AS DOUBLE)/1000.0 AS y0 FROM nation)"
_IN = "s.lon >= b.x0 AND s.lon <= b.x0 + 0.4 AND s.lat >= b.y0 AND s.lat <= b.y0 + 0.2"


def pip_join(spark: SparkSession, sf: str) -> DataFrame:
    return J.points_in_polygons(sites(spark, sf), J.boxes_as_edges(_boxes(spark, sf)))


SQL["pip_join"] = f"WITH {site_sql()}, {_BOXES} SELECT s.id, b.polygon_id FROM sites s JOIN boxes b ON {_IN}"


def match_sites_left(spark: SparkSession, sf: str) -> DataFrame:
    return J.first_containing(sites(spark, sf, "supplier"), J.boxes_as_edges(_boxes(spark, sf).withColumns({"x1": F.col("x0") + 0.3, "y1": F.col("y0") + 0.1})))


SQL["match_sites_left"] = f"WITH {site_sql('supplier')}, {_BOXES} SELECT s.id, min(b.polygon_id) AS polygon_id FROM sites s LEFT JOIN boxes b ON {_IN.replace('0.4', '0.3').replace('0.2', '0.1')} GROUP BY s.id"


def within_distance(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(J.within_distance(sites(spark, sf), sites(spark, sf, "supplier"), 3_000.0), "distance_m", places=4)


SQL["within_distance"] = f"""WITH {site_sql()}, {site_sql("supplier", "supp")}, d AS (SELECT s.id, t.id AS other_id, {hav_sql("s.lon", "s.lat", "t.lon", "t.lat", geo.EARTH_M)} AS d FROM sites s, supp t)
 SELECT id, other_id, round(d,4) AS distance_m FROM d WHERE d <= 3000.0"""


def nearest_one(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(J.nearest(sites(spark, sf), sites(spark, sf, "supplier")), "distance_m", places=4).select("id", "distance_m")


SQL["nearest_one"] = f"""WITH {site_sql()}, {site_sql("supplier", "supp")} SELECT s.id, round(min({hav_sql("s.lon", "s.lat", "t.lon", "t.lat", geo.EARTH_M)}),4) AS distance_m FROM sites s, supp t GROUP BY s.id"""


def grid_v1_cells(spark: SparkSession, sf: str) -> DataFrame:
    return R.grid_cells(sites(spark, sf), -67.25005, 18.55005, 0.0125, 40, 120)


SQL["grid_v1_cells"] = f"""WITH {site_sql()}, c AS (SELECT id, CAST(floor((18.55005-lat)/0.0125) AS BIGINT) AS r, CAST(floor((lon+67.25005)/0.0125) AS BIGINT) AS c FROM sites)
 SELECT id, CASE WHEN r BETWEEN 0 AND 39 AND c BETWEEN 0 AND 119 THEN 'R' || CAST(r AS VARCHAR) || '_C' || CAST(c AS VARCHAR) END AS cell_id FROM c"""


def _projected(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("id")
    return sites(spark, sf).select("id", ((k * 37) % 1800 * 100).cast("decimal(18,3)").alias("x"), ((k * 53) % 700 * 100).cast("decimal(18,3)").alias("y"))


def grid_v2_bind(spark: SparkSession, sf: str) -> DataFrame:
    return R.bind_exact(_projected(spark, sf), 250, 720, 280)


_V2 = """xy AS (SELECT c_custkey AS id, (c_custkey*37)%1800*100 AS x, (c_custkey*53)%700*100 AS y FROM customer),
 cx AS (SELECT id, x//250 AS col, y FROM xy UNION ALL SELECT id, x//250-1, y FROM xy WHERE x%250=0),
 cells AS (SELECT id, col, y//250 AS row FROM cx UNION ALL SELECT id, col, y//250-1 FROM cx WHERE y%250=0)"""
SQL["grid_v2_bind"] = f"WITH {_V2} SELECT id, col, row FROM cells WHERE col BETWEEN 0 AND 719 AND row BETWEEN 0 AND 279"


def grid_v2_parent(spark: SparkSession, sf: str) -> DataFrame:
    return R.coarser(R.bind_exact(_projected(spark, sf), 250, 720, 280).select("col", "row").distinct(), 2)


SQL["grid_v2_parent"] = f"WITH {_V2}, d AS (SELECT DISTINCT col, row FROM cells WHERE col BETWEEN 0 AND 719 AND row BETWEEN 0 AND 279) SELECT col//2 AS col, row//2 AS row, count(*) AS n_children FROM d GROUP BY 1, 2"


def grid_v2_neighbors(spark: SparkSession, sf: str) -> DataFrame:
    return R.neighbours(R.bind_exact(_projected(spark, sf), 2000, 90, 35).select("col", "row").distinct(), 90, 35)


SQL["grid_v2_neighbors"] = f"""WITH {_V2.replace("250", "2000")}, d AS (SELECT DISTINCT col, row FROM cells WHERE col BETWEEN 0 AND 89 AND row BETWEEN 0 AND 34)
 SELECT col, row, col+i AS n_col, row+j AS n_row FROM d, (SELECT unnest([-1,0,1])::BIGINT AS i) a, (SELECT unnest([-1,0,1])::BIGINT AS j) b WHERE (i<>0 OR j<>0) AND col+i BETWEEN 0 AND 89 AND row+j BETWEEN 0 AND 34"""


def context_grid(spark: SparkSession, sf: str) -> DataFrame:
    return R.roll_up(sites(spark, sf).withColumns({"lon": F.col("lon") + 0.0005, "lat": F.col("lat") + 0.0005}), "balance", 2)


SQL["context_grid"] = f"""WITH {site_sql()} SELECT CAST(floor((lon+0.0005)*100) AS BIGINT) AS lon_cell, CAST(floor((lat+0.0005)*100) AS BIGINT) AS lat_cell, count(*) AS n, CAST(sum(CAST(balance AS DECIMAL(28,2))) AS DOUBLE) AS total FROM sites GROUP BY 1, 2"""


def xyz_tiles(spark: SparkSession, sf: str) -> DataFrame:
    x, y = geo.xyz_tile(F.col("lon"), F.col("lat"), 15)
    return sites(spark, sf).select("id", x.alias("x"), y.alias("y"))


SQL["xyz_tiles"] = f"""WITH {site_sql()} SELECT id, CAST(floor((lon+180.0)/360.0*32768.0) AS BIGINT) AS x, CAST(floor((1.0-ln(tan(radians(lat))+1.0/cos(radians(lat)))/pi())/2.0*32768.0) AS BIGINT) AS y FROM sites"""


def page_after(spark: SparkSession, sf: str) -> DataFrame:
    return R.page(sites(spark, sf), 40, 25).select("id", "name")


SQL["page_after"] = f"WITH {site_sql()} SELECT id, name FROM sites WHERE id > 40 ORDER BY id LIMIT 25"


def ranked_targets(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("id")).agg(F.max("l_discount").alias("max_score"), F.avg("l_quantity").alias("mean_risk"), F.count(F.lit(1)).alias("n_nodes"))
    score = rounded_half(0.5 * F.col("max_score") + 0.3 * F.col("mean_risk") / 100.0 + 0.2 * F.least(F.col("n_nodes") / 20.0, F.lit(1.0)), 4)
    return R.rank(rows, score).select("id", "rank_score", F.col("rank").cast("long").alias("rank"))


SQL["ranked_targets"] = """WITH g AS (SELECT l_suppkey AS id, round(0.5*max(l_discount)+0.3*avg(l_quantity)/100.0+0.2*least(count(*)/20.0::DOUBLE,1.0),4) AS rank_score FROM lineitem GROUP BY 1)
 SELECT id, rank_score, row_number() OVER (ORDER BY rank_score DESC, id) AS rank FROM g"""


def vector_topk(spark: SparkSession, sf: str) -> DataFrame:
    return R.nearest_vectors(table(spark, sf, "embeddings"), [((i * 7) % 11 - 5) / 5.0 for i in range(64)], 20)


SQL["vector_topk"] = """WITH q AS (SELECT [((i*7)%11-5)/5.0::DOUBLE for i in range(64)] AS q), v AS (SELECT vec_id, [x::DOUBLE for x in embedding] AS e FROM embeddings)
 SELECT vec_id, round(list_cosine_similarity(e,q),4) AS score FROM v, q ORDER BY score DESC, vec_id LIMIT 20"""

QUERIES = {
    f.__name__: f
    for f in (
        ilap_pins, route_edges, route_corridors, intake, gap_audit, tier_distribution, intake_greedy_dedup, aoi_bbox, aoi_radius, aoi_polygon, aoi_ledger, identify, search_rank, summarize, time_filter_partial,
        pip_join, match_sites_left, within_distance, nearest_one, grid_v1_cells, grid_v2_bind, grid_v2_parent, grid_v2_neighbors, context_grid, xyz_tiles, page_after, ranked_targets, vector_topk,
    )
}
