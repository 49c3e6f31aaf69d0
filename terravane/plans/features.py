"""Queries over features and areas, corridors, scenarios, registrations, projections and heights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import coordinates as C
from ..operators import corridors as K
from ..operators import linkage as L
from ..operators import parts as P
from ..operators import registration as R
from ..operators import scenarios as Z
from ..operators import vectortiles as V
from ..sources import exports as X
from ..sources.tables import table
from .common import FLIGHTS, flights, rounded, site_sql, sites

SQL: dict[str, str] = {}
_EDGE = ("ax", "ay", "bx", "by")


def _edges(df: DataFrame, id_col: str, name: str, *places: tuple[float, float]) -> DataFrame:
    """Edges between places given as steps from a site."""
    e = [F.struct(*((F.col("lon" if k % 2 == 0 else "lat") + F.lit(v)).alias(n) for k, (n, v) in enumerate(zip(_EDGE, (*a, *b), strict=True)))) for a, b in zip(places, places[1:], strict=False)]
    return df.select(F.col(id_col).alias(name), F.explode(F.array(*e)).alias("e")).select(name, "e.*")


def _areas(spark: SparkSession, sf: str) -> DataFrame:
    """supplier as triangles."""
    return _edges(sites(spark, sf, "supplier"), "id", "area_id", (0.0, 0.0), (0.05, 0.0), (0.0, 0.04), (0.0, 0.0))


def _features(spark: SparkSession, sf: str) -> DataFrame:
    """customer as points and bent lines."""
    s = sites(spark, sf)
    lines = _edges(s.where("id % 3 <> 0"), "id", "feature_id", (0.001, 0.0005), (0.031, 0.0105), (0.031, -0.0195)).withColumn("kind", F.lit("line"))
    none = F.lit(None).cast("double")
    points = s.where("id % 3 = 0").select(F.col("id").alias("feature_id"), (F.col("lon") + 0.0007).alias("ax"), (F.col("lat") + 0.0004).alias("ay"), none.alias("bx"), none.alias("by"), F.lit("point").alias("kind"))
    return lines.unionByName(points)


def area_features(spark: SparkSession, sf: str) -> DataFrame:
    """How each point and line lies to the areas that it meets."""
    return P.line_relations(_features(spark, sf), _areas(spark, sf), 0.1)


# Areas are convex, so each half plane cuts a stretch off a line, and what is left lies inside.
_CLIP = """e AS (SELECT id, 0.001::DOUBLE AS u0, 0.0005::DOUBLE AS v0, 0.031::DOUBLE AS u1, 0.0105::DOUBLE AS v1 FROM sites WHERE id % 3 <> 0 UNION ALL SELECT id, 0.031, 0.0105, 0.031, -0.0195 FROM sites WHERE id % 3 <> 0
 UNION ALL SELECT id, 0.0007, 0.0004, 0.0007, 0.0004 FROM sites WHERE id % 3 = 0),
 g AS (SELECT e.id, t.id AS area_id, u0 <> u1 OR v0 <> v1 AS long, s.lon + u0 - t.lon AS x0, s.lat + v0 - t.lat AS y0, s.lon + u1 - t.lon AS x1, s.lat + v1 - t.lat AS y1 FROM e JOIN sites s USING (id)
 JOIN tri t ON t.lon BETWEEN s.lon - 0.06 AND s.lon + 0.04 AND t.lat BETWEEN s.lat - 0.06 AND s.lat + 0.02),
 h AS (SELECT *, [y0, x0, 1 - x0/0.05 - y0/0.04] AS f0, [y1, x1, 1 - x1/0.05 - y1/0.04] AS f1 FROM g),
 c AS (SELECT *, list_reduce(list_prepend(0.0, list_transform(list_zip(f0, f1), lambda z: CASE WHEN z[2] > z[1] THEN -z[1]/(z[2]-z[1]) ELSE 0.0 END)), lambda a, b: greatest(a, b)) AS t0,
 list_reduce(list_prepend(1.0, list_transform(list_zip(f0, f1), lambda z: CASE WHEN z[2] < z[1] THEN -z[1]/(z[2]-z[1]) WHEN z[2] = z[1] AND z[1] < 0 THEN -1.0 ELSE 1.0 END)), lambda a, b: least(a, b)) AS t1 FROM h)"""

SQL["area_features"] = f"""WITH {site_sql()}, {site_sql("supplier", "tri")}, {_CLIP},
 r AS (SELECT id AS feature_id, area_id, bool_or(CASE WHEN long THEN t1 - t0 > 1e-9 ELSE t1 >= t0 END) AS inside, bool_or(CASE WHEN long THEN t0 > 1e-9 OR t1 < 1 - 1e-9 ELSE t1 < t0 END) AS outside, bool_or(t1 >= t0) AS meets FROM c GROUP BY ALL)
 SELECT feature_id, area_id, inside AND NOT outside AS within, NOT inside AS touches, inside AND outside AS crosses FROM r WHERE meets"""


def features_near(spark: SparkSession, sf: str) -> DataFrame:
    """Lines and areas within two kilometres of a place, with their distances."""
    lines = _features(spark, sf).where("kind = 'line'")
    areas = _areas(spark, sf).select((-F.col("area_id")).alias("feature_id"), *_EDGE, F.lit("polygon").alias("kind"))
    centres = sites(spark, sf, "supplier").select("id", (F.col("lon") + 0.0103).alias("lon"), (F.col("lat") - 0.0037).alias("lat"))
    return rounded(P.within_metres(centres, lines.unionByName(areas), 2_000.0), "distance_m", places=4)


SQL["features_near"] = f"""WITH {site_sql()}, {site_sql("supplier", "tri")}, f AS (SELECT id AS feature_id, lon+0.001 AS ax, lat+0.0005 AS ay, lon+0.031 AS bx, lat+0.0105 AS b_y FROM sites WHERE id % 3 <> 0
 UNION ALL SELECT id, lon+0.031, lat+0.0105, lon+0.031, lat-0.0195 FROM sites WHERE id % 3 <> 0 UNION ALL SELECT -id, lon, lat, lon+0.05, lat FROM tri UNION ALL SELECT -id, lon+0.05, lat, lon, lat+0.04 FROM tri UNION ALL SELECT -id, lon, lat+0.04, lon, lat FROM tri),
 c AS (SELECT id, lon+0.0103 AS lon, lat-0.0037 AS lat FROM tri), k AS (SELECT pi()/180*6371008.8 AS k),
 m AS (SELECT id, feature_id, (ax-lon)*k*cos(radians(lat)) AS x0, (ay-lat)*k AS y0, (bx-lon)*k*cos(radians(lat)) AS x1, (b_y-lat)*k AS y1 FROM c JOIN f ON f.ax BETWEEN c.lon-0.1 AND c.lon+0.1 AND f.ay BETWEEN c.lat-0.1 AND c.lat+0.1, k),
 d AS (SELECT id, feature_id, sqrt(pow(x0+t*(x1-x0),2)+pow(y0+t*(y1-y0),2)) AS d FROM (SELECT *, least(1.0, greatest(0.0, -(x0*(x1-x0)+y0*(y1-y0))/((x1-x0)*(x1-x0)+(y1-y0)*(y1-y0)))) AS t FROM m)
 UNION ALL SELECT c.id, -t.id, 0.0 FROM c JOIN tri t ON c.lat >= t.lat AND c.lon >= t.lon AND (c.lon-t.lon)/0.05+(c.lat-t.lat)/0.04 <= 1)
 SELECT id, feature_id, round(min(d),4) AS distance_m FROM d GROUP BY ALL HAVING min(d) <= 2000"""


def projected_sites(spark: SparkSession, sf: str) -> DataFrame:
    """Places as a person would type them, read, projected, snapped to a grid of 100 m and projected back."""
    s = sites(spark, sf)
    way = F.col("id") % 4
    dms = lambda c: F.concat(F.floor(F.abs(c)).cast("string"), F.lit("°"), F.floor((F.abs(c) - F.floor(F.abs(c))) * 60).cast("string"), F.lit("'"))
    decimal = lambda c: F.format_string("%.3f", c)
    lon, lat = F.col("lon"), F.col("lat")
    text = F.when(way == 0, F.concat_ws(", ", decimal(lat), decimal(lon))).when(way == 1, F.concat_ws(" ", decimal(lon), decimal(lat))).when(way == 2, F.concat(dms(lat), F.lit("N "), dms(lon), F.lit("W"))).otherwise(F.concat(F.lit("near "), decimal(lat)))
    conic = C.ConformalConic()
    p = s.select("id", C.parse_coordinates(text).alias("p")).withColumn("q", conic.forward(F.col("p.lon"), F.col("p.lat"))).withColumn("x", C.snapped(F.col("q.x"), 0.0, 100.0, 5.0)).withColumn("back", conic.inverse(F.col("q.x"), F.col("q.y")))
    known = F.col("p").isNotNull()
    out = p.select("id", *(F.when(known, F.col(c)).alias(n) for c, n in (("p.lon", "lon"), ("p.lat", "lat"), ("q.x", "x"), ("q.y", "y"), ("x.value", "snapped_x"), ("back.lon", "back_lon"), ("back.lat", "back_lat"))), F.when(known, F.col("x.snap")).alias("snapped"))
    return rounded(rounded(out, "lon", "lat", "back_lon", "back_lat", places=8), "x", "y", "snapped_x", places=4)


_M = "(cos({0})/sqrt(1-pow(ecc*sin({0}),2)))"
_T = "(tan(pi()/4-{0}/2)/pow((1-ecc*sin({0}))/(1+ecc*sin({0})),ecc/2))"
SQL["projected_sites"] = f"""WITH {site_sql()}, typed AS (SELECT id, CASE WHEN id % 4 = 3 THEN NULL WHEN id % 4 = 2 THEN -(floor(abs(lon))+floor((abs(lon)-floor(abs(lon)))*60)/60) ELSE CAST(printf('%.3f', lon) AS DOUBLE) END AS lon,
 CASE WHEN id % 4 = 3 THEN NULL WHEN id % 4 = 2 THEN floor(lat)+floor((lat-floor(lat))*60)/60 ELSE CAST(printf('%.3f', lat) AS DOUBLE) END AS lat FROM sites),
 k AS (SELECT sqrt(f*(2-f)) AS ecc, radians(18+2/60.0::DOUBLE) AS p1, radians(18+26/60.0::DOUBLE) AS p2, radians(17+50/60.0::DOUBLE) AS p0, -(66+26/60.0::DOUBLE) AS l0 FROM (SELECT 1/298.257222101::DOUBLE AS f)),
 n AS (SELECT *, ln({_M.format("p1")}/{_M.format("p2")})/ln({_T.format("p1")}/{_T.format("p2")}) AS n FROM k), g AS (SELECT *, {_M.format("p1")}/(n*pow({_T.format("p1")},n)) AS big FROM n),
 w AS (SELECT id, lon, lat, 6378137.0*big*pow({_T.format("radians(lat)")},n) AS r, 6378137.0*big*pow({_T.format("p0")},n) AS r0, n*radians(lon-l0) AS th FROM typed, g),
 xy AS (SELECT id, lon, lat, 200000+r*sin(th) AS x, 200000+r0-r*cos(th) AS y FROM w), s AS (SELECT *, round_even(x/100,0)*100 AS line FROM xy)
 SELECT id, round(lon,8) AS lon, round(lat,8) AS lat, round(x,4) AS x, round(y,4) AS y, round(CASE WHEN abs(x-line) <= 5 THEN line ELSE x END,4) AS snapped_x, round(lon,8) AS back_lon, round(lat,8) AS back_lat, abs(x-line) <= 5 AS snapped FROM s"""


def corridor_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Groups of places around the earliest of them."""
    s = sites(spark, sf).select(F.col("id").alias("node"), F.col("lon").alias("x"), F.col("lat").alias("y"), (F.col("id") * 31 % 101).cast("double").alias("score"), (F.col("id") * 17 % 97).cast("double").alias("risk"))
    return K.candidates(s, 0.0405)


# The walk itself, a step a place, with the seeds so far as a list.
SQL["corridor_candidates"] = f"""WITH RECURSIVE {site_sql()}, o AS MATERIALIZED (SELECT row_number() OVER (ORDER BY id) AS k, id, lon, lat FROM sites),
 walk AS (SELECT 0::BIGINT AS k, NULL::BIGINT AS node, NULL::BIGINT AS seed, []::STRUCT(i BIGINT, x DOUBLE, y DOUBLE)[] AS seeds
 UNION ALL SELECT k, id, coalesce(hit, id), CASE WHEN hit IS NULL THEN list_append(seeds, {{'i': id, 'x': lon, 'y': lat}}) ELSE seeds END FROM (SELECT o.k, o.id, o.lon, o.lat, w.seeds,
 list_filter(w.seeds, lambda s: sqrt((s.x-o.lon)*(s.x-o.lon)+(s.y-o.lat)*(s.y-o.lat)) <= 0.0405)[1].i AS hit FROM walk w JOIN o ON o.k = w.k + 1))
 SELECT seed, count(*) AS n_nodes, round(avg(lon),6) AS centre_x, round(avg(lat),6) AS centre_y, round(avg(node*31%101),4) AS mean_score, round(max(node*31%101)::DOUBLE,4) AS max_score, round(avg(node*17%97),2) AS mean_risk, round(max(node*17%97)::DOUBLE,2) AS max_risk
 FROM walk JOIN o ON o.id = walk.node GROUP BY seed HAVING count(*) >= 2"""


def scenario_ranks(spark: SparkSession, sf: str) -> DataFrame:
    """customer as zones rated anew on events as evidence, under every scenario."""
    e, k = table(spark, sf, "events"), F.col("event_id")
    fam = F.element_at(F.array(*(F.lit(x) for x in ("AQUIFERS_WELLS_SPRINGS", "UTILITIES_UNDERGROUND", "HISTORICAL_CORROBORATION", "INDUSTRIAL_REMEDIATION", "MINES_QUARRIES_SHAFTS"))), (k % 5 + 1).cast("int"))
    hits = e.select(
        (F.col("user_id") % 1500).alias("zone_id"), fam.alias("family"), (k % 7).cast("string").alias("source"), (k % 5 == 0).alias("ground"), (k % 5 == 4).alias("mine"), (k % 41 == 0).alias("cave"), (k % 5 == 2).alias("history"),
        F.when(k % 3 > 0, k % 11).alias("asset"), F.when(k % 11 < 6, "GROUNDWATER_POINT").otherwise("MINE_QUARRY_FEATURE").alias("asset_class"),
    )
    c = F.col("c_custkey")
    zones = table(spark, sf, "customer").where("c_custkey < 1500").select(c.alias("zone_id"), F.when(c % 2 == 0, "MODERATE").otherwise("LOW").alias("relevance"), F.when(c % 3 == 0, "DIRECT").otherwise("CANDIDATE").alias("tier"), ((c % 70) / 10.0).alias("score"))
    return Z.hardened(hits, zones)


_SCEN = ", ".join(f"('{n}', [{', '.join(repr(x) for x in out)}]::VARCHAR[])" for n, out in Z.LEFT_OUT.items())
SQL["scenario_ranks"] = f"""WITH h AS (SELECT user_id % 1500 AS zone_id, ['AQUIFERS_WELLS_SPRINGS','UTILITIES_UNDERGROUND','HISTORICAL_CORROBORATION','INDUSTRIAL_REMEDIATION','MINES_QUARRIES_SHAFTS'][event_id % 5 + 1] AS fam, event_id % 7 AS src, event_id AS k,
 CASE WHEN event_id % 3 > 0 THEN event_id % 11 END AS asset FROM events), scen(scenario, out) AS (VALUES {_SCEN}),
 z AS (SELECT c_custkey AS zone_id, CASE WHEN c_custkey % 2 = 0 THEN 'MODERATE' ELSE 'LOW' END AS relevance, CASE WHEN c_custkey % 3 = 0 THEN 'DIRECT' ELSE 'CANDIDATE' END AS tier, (c_custkey % 70)/10.0::DOUBLE AS old FROM customer WHERE c_custkey < 1500),
 c AS (SELECT zone_id, scenario, count(DISTINCT CASE WHEN k%5=0 AND asset < 6 THEN asset END) + count(*) FILTER (k%5=0 AND coalesce(asset >= 6, true)) AS g, count(DISTINCT CASE WHEN k%5=4 AND asset >= 6 THEN asset END) + count(*) FILTER (k%5=4 AND coalesce(asset < 6, true)) AS m,
 count(*) FILTER (k%41=0) AS cave, count(*) FILTER (k%5=3) AS ind, count(*) FILTER (k%5=1) AS util, count(*) FILTER (k%5=2) AS hist, count(DISTINCT src) AS srcs FROM h, scen WHERE NOT list_contains(out, fam) GROUP BY ALL),
 s AS (SELECT z.*, scenario, coalesce(g,0) AS g, coalesce(m,0) AS m, round(least(10.0, least(3.0,coalesce(cave,0)*3.0)+least(2.5,ln(1+coalesce(g,0))*0.75)+least(2.0,ln(1+coalesce(m,0))*0.9)+least(0.75,ln(1+coalesce(ind,0))*0.25)+least(0.5,ln(1+coalesce(util,0))*0.08)
 +least(0.25,ln(1+coalesce(hist,0))*0.05)+CASE WHEN srcs >= 3 THEN least(1.0,(srcs-2)*0.15) ELSE 0.0 END),3) AS score FROM (SELECT z.*, scenario FROM z, scen) z LEFT JOIN c USING (zone_id, scenario)),
 r AS (SELECT *, row_number() OVER (PARTITION BY scenario ORDER BY score DESC, zone_id DESC) AS rank FROM s),
 q AS (SELECT zone_id, any_value(relevance) AS relevance, any_value(tier) AS tier, any_value(old) AS old, max(score) FILTER (scenario='BASE') AS s, max(g) FILTER (scenario='BASE') AS g, max(m) FILTER (scenario='BASE') AS m,
 min(score) FILTER (scenario IN ('BASE','NO_UTILITY_HISTORY','NO_UTILITY_HISTORY_INDUSTRIAL')) AS core, min(rank) AS lo, max(rank) AS hi FROM r GROUP BY zone_id)
 SELECT zone_id, s AS new_score, CASE WHEN s >= 7 THEN 'HIGH' WHEN s >= 4 THEN 'MODERATE' WHEN s >= 1.5 THEN 'LOW' ELSE 'VERY_LOW' END AS new_relevance, round(s-old,3)+0.0 AS delta,
 CASE WHEN relevance <> 'MODERATE' THEN 'BASELINE' WHEN s < 4 THEN 'PROVISIONAL' WHEN core < 4 THEN 'THRESHOLD' WHEN tier = 'DIRECT' THEN 'ROBUST' ELSE 'SEMI_ROBUST' END AS sensitivity, g AS groundwater, m AS mine, lo AS rank_min, hi AS rank_max, hi-lo AS rank_span FROM q"""


def image_registrations(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem as control points of an image for each supplier, some of them off."""
    k = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    px, py = (k * 13 % 1000).cast("double"), (k * 29 % 700).cast("double")
    off = (k * 5 % 19 - 9).cast("double") * 1e-5 * F.when(F.col("l_suppkey") % 5 == 0, 20.0).otherwise(1.0)
    points = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("image"), px.alias("px"), py.alias("py"), (F.lit(-66.5) + px * 1e-4 + py * 2e-5 + off).alias("lon"), (F.lit(18.4) - px * 1e-5 - py * 9e-5 - off).alias("lat"))
    out = R.registered(points, 10, 15.0, 30.0)
    return rounded(rounded(out, "ax", "bx", "cx", "ay", "by", "cy", places=7), "rmse_m", "max_error_m", places=3)


SQL["image_registrations"] = """WITH b AS (SELECT l_suppkey AS image, (l_orderkey*7+l_linenumber)::BIGINT AS k FROM lineitem), o AS (SELECT image, (k*13%1000)::DOUBLE AS px, (k*29%700)::DOUBLE AS py, (k*5%19-9)::DOUBLE*1e-5*CASE WHEN image % 5 = 0 THEN 20.0 ELSE 1.0 END AS d FROM b),
 p AS (SELECT image, px, py, -66.5+px*1e-4+py*2e-5+d AS lon, 18.4-px*1e-5-py*9e-5-d AS lat FROM o),
 s AS (SELECT image, count(*) AS n, avg(px) AS mx, avg(py) AS my, avg(lon) AS ml, avg(lat) AS mt, var_pop(px) AS xx, var_pop(py) AS yy, covar_pop(px,py) AS xy, covar_pop(px,lon) AS xl, covar_pop(py,lon) AS yl, covar_pop(px,lat) AS xt, covar_pop(py,lat) AS yt FROM p GROUP BY image),
 f AS (SELECT image, n, mx, my, ml, mt, (xl*yy-yl*xy)/(xx*yy-xy*xy) AS ax, (yl*xx-xl*xy)/(xx*yy-xy*xy) AS bx, (xt*yy-yt*xy)/(xx*yy-xy*xy) AS ay, (yt*xx-xt*xy)/(xx*yy-xy*xy) AS b_y FROM s),
 g AS (SELECT *, ml-ax*mx-bx*my AS cx, mt-ay*mx-b_y*my AS cy FROM f),
 e AS (SELECT image, 2*6371008.8*asin(sqrt(least(1.0, pow(sin(radians(ay*px+b_y*py+cy-lat)/2),2)+cos(radians(lat))*cos(radians(ay*px+b_y*py+cy))*pow(sin(radians(ax*px+bx*py+cx-lon)/2),2)))) AS d FROM p JOIN g USING (image)),
 m AS (SELECT image, sqrt(avg(d*d)) AS rmse, max(d) AS worst FROM e GROUP BY image)
 SELECT image, n, round(ax,7)+0.0 AS ax, round(bx,7)+0.0 AS bx, round(cx,7)+0.0 AS cx, round(ay,7)+0.0 AS ay, round(b_y,7)+0.0 AS "by", round(cy,7)+0.0 AS cy, round(rmse,3) AS rmse_m, round(worst,3) AS max_error_m, n >= 10 AND rmse <= 15 AND worst <= 30 AS certified FROM g JOIN m USING (image)"""


def common_heights(spark: SparkSession, sf: str) -> DataFrame:
    """supplier balances as heights on several datums, moved to one where a transform holds; nation gives the transforms."""
    s, k = sites(spark, sf, "supplier"), F.col("id")
    datum = F.element_at(F.array(F.lit("PRVD02"), F.lit("MLLW"), F.lit("NAVD88"), F.lit("MSL_ASSUMED"), F.lit(None).cast("string")), (k % 5 + 1).cast("int"))
    values = s.select("id", F.col("balance").cast("double").alias("value"), F.when(k % 7 == 0, "down").otherwise("up").alias("positive"), datum.alias("datum"), "lon", "lat", F.when(k % 3 > 0, (k % 10) / 10.0).alias("uncertainty"))
    n = F.col("n_nationkey")
    transforms = table(spark, sf, "nation").where("n_nationkey < 8").select(F.when(n % 2 == 0, "MLLW").otherwise("NAVD88").alias("source"), F.lit("PRVD02").alias("target"), (n / 4.0).alias("offset"), F.col("n_name").alias("authority"), (n / 10.0).alias("uncertainty"), (F.lit(-67.3) + n * 0.2).alias("west"), F.lit(17.0).alias("south"), (F.lit(-66.95) + n * 0.2).alias("east"), F.lit(19.0).alias("north"))
    return rounded(R.on_common_datum(values, transforms, "PRVD02", ("MSL_ASSUMED",)), "elevation", "uncertainty")


SQL["common_heights"] = f"""WITH {site_sql("supplier")}, v AS (SELECT id, balance::DOUBLE * CASE WHEN id % 7 = 0 THEN -1 ELSE 1 END AS up, ['PRVD02','MLLW','NAVD88','MSL_ASSUMED',NULL][id % 5 + 1] AS datum, lon, CASE WHEN id % 3 > 0 THEN (id % 10)/10.0::DOUBLE END AS u FROM sites),
 t AS (SELECT CASE WHEN n_nationkey % 2 = 0 THEN 'MLLW' ELSE 'NAVD88' END AS source, n_nationkey/4.0::DOUBLE AS o, n_name AS a, n_nationkey/10.0::DOUBLE AS tu, -67.3+n_nationkey*0.2::DOUBLE AS w, -66.95+n_nationkey*0.2::DOUBLE AS e FROM nation WHERE n_nationkey < 8),
 m AS (SELECT id, count(*) AS k, any_value(o) AS o, any_value(a) AS a, any_value(tu) AS tu FROM v JOIN t ON datum = source AND lon BETWEEN w AND e GROUP BY id),
 j AS (SELECT v.*, o, a, tu, CASE WHEN datum IS NULL THEN 'UNKNOWN_DATUM' WHEN datum = 'MSL_ASSUMED' THEN 'ASSUMED_DATUM' WHEN datum = 'PRVD02' THEN 'SAME_REFERENCE' WHEN k IS NULL THEN 'NO_TRANSFORM' WHEN k > 1 THEN 'AMBIGUOUS' ELSE 'TRANSFORMED' END AS state FROM v LEFT JOIN m USING (id))
 SELECT id, round(CASE state WHEN 'SAME_REFERENCE' THEN up WHEN 'TRANSFORMED' THEN up+o END,6) AS elevation, round(CASE state WHEN 'SAME_REFERENCE' THEN u WHEN 'TRANSFORMED' THEN sqrt(u*u+tu*tu) END,6) AS uncertainty, state, CASE WHEN state = 'TRANSFORMED' THEN a END AS authority FROM j"""


def _flown(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("flight_id")
    f = flights(spark, sf).select(
        k, F.when(k % 5 > 0, F.col("callsign")).alias("callsign"), F.col("origin").alias("origin_airport"), F.col("dest").alias("destination_airport"), F.col("takeoff").cast("string").alias("takeoff_time"), F.col("minutes").alias("flight_duration_minutes"),
        F.col("mission").alias("mission_type"), F.when(k % 7 > 0, F.col("origin_lon")).alias("origin_lon"), "origin_lat", "dest_lon", F.when(k % 11 > 0, F.col("dest_lat")).otherwise(0.0).alias("dest_lat"),
    )
    return f


def _images(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("event_id")
    return table(spark, sf, "events").select(F.format_string("S%08d", k).alias("screenshot_id"), F.col("user_id").cast("string").alias("flight_id"), F.concat(F.lit("/img/"), k.cast("string")).alias("image_path"), F.when(k % 3 > 0, (k % 100) / 100.0).alias("ocr_confidence"), F.when(k % 4 == 0, "manual").alias("coordinate_method"), F.when(k % 2 == 0, 0.0).otherwise(0.9).alias("coordinate_confidence"))


def airspace_events(spark: SparkSession, sf: str) -> DataFrame:
    """Flights as they are exported, with their first image."""
    return X.airspace_events(_flown(spark, sf), _images(spark, sf)).select("flight_id", "callsign", "operator", "takeoff_time", "flight_duration_minutes", "origin_lon", "dest_lat", "screenshot_id", "source_path", "ocr_confidence", "coordinate_method", "coordinate_confidence", "review_status")


_IMG = """img AS (SELECT min(event_id) AS e, CAST(user_id AS VARCHAR) AS of FROM events GROUP BY user_id)"""
SQL["airspace_events"] = f"""WITH {FLIGHTS}, {_IMG} SELECT CAST(flight_id AS VARCHAR) AS flight_id, CASE WHEN flight_id % 5 > 0 THEN callsign ELSE '' END AS callsign, '' AS operator, CAST(takeoff AS VARCHAR) AS takeoff_time, minutes AS flight_duration_minutes,
 CASE WHEN flight_id % 7 > 0 THEN origin_lon ELSE 0.0 END AS origin_lon, CASE WHEN flight_id % 11 > 0 THEN dest_lat ELSE 0.0 END AS dest_lat, coalesce(printf('S%08d', e), '') AS screenshot_id, coalesce('/img/' || e, '') AS source_path,
 CASE WHEN e % 3 > 0 THEN (e % 100)/100.0::DOUBLE ELSE 0.0 END AS ocr_confidence, CASE WHEN e % 4 = 0 THEN 'manual' ELSE 'fixed_pr_bounds' END AS coordinate_method, CASE WHEN e % 2 = 1 THEN 0.9::DOUBLE ELSE 0.65::DOUBLE END AS coordinate_confidence, 'pending' AS review_status
 FROM flights LEFT JOIN img ON of = CAST(flight_id AS VARCHAR)"""


def airspace_airports(spark: SparkSession, sf: str) -> DataFrame:
    """Each airport once, where the first flight that names it puts it."""
    return rounded(X.airports(_flown(spark, sf), _images(spark, sf)).select("feature_id", "name", "lon", "lat", "screenshot_id"), "lon", "lat")


SQL["airspace_airports"] = f"""WITH {FLIGHTS}, {_IMG}, e AS (SELECT CAST(flight_id AS VARCHAR) AS f, 0 AS k, 'origin_' || origin AS feature_id, origin AS name, origin_lon AS lon, origin_lat AS lat FROM flights WHERE flight_id % 7 > 0
 UNION ALL SELECT CAST(flight_id AS VARCHAR), 1, 'dest_' || dest, dest, dest_lon, dest_lat FROM flights WHERE flight_id % 11 > 0),
 r AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY f, k) AS n FROM e WHERE lon <> 0 AND lat <> 0)
 SELECT feature_id, name, round(lon,6) AS lon, round(lat,6) AS lat, coalesce(printf('S%08d', img.e), '') AS screenshot_id FROM r LEFT JOIN img ON of = f WHERE n = 1"""


def project_places(spark: SparkSession, sf: str) -> DataFrame:
    """customer as projects whose titles name a place, supplier as places with two names."""
    c, s = sites(spark, sf), sites(spark, sf, "supplier")
    k = F.col("id")
    title = F.when(k % 10 == 0, "").when(k % 10 == 1, F.concat(F.lit("SITIO "), (k % 300).cast("string"))).otherwise(F.concat(F.lit("Obras en el Sitio "), (k % 300).cast("string"), F.lit(" Norté")))
    projects = c.select("id", title.alias("name"), F.when(k % 4 > 0, F.concat(F.lit("M"), (k % 3).cast("string"))).alias("municipality"))
    references = s.select(F.concat(F.lit("R"), k.cast("string")).alias("ref_id"), (k * 7 % 1001).alias("ord"), F.concat(F.lit("m"), (k % 3).cast("string")).alias("municipality"), F.array(F.concat(F.lit("sitio "), k.cast("string")), F.concat(F.lit("gran sitio "), (k * 2).cast("string"), F.lit(" sur"))).alias("names"))
    return L.contained_names(projects, references).select("id", "ref_id")


SQL["project_places"] = """WITH p AS (SELECT c_custkey AS id, CASE WHEN c_custkey%10 = 0 THEN '' WHEN c_custkey%10 = 1 THEN 'sitio ' || c_custkey%300 ELSE 'obras en el sitio ' || c_custkey%300 || ' norte' END AS t, CASE WHEN c_custkey%4 > 0 THEN c_custkey%3 END AS m FROM customer),
 r AS (SELECT 'R' || s_suppkey AS ref_id, s_suppkey*7%1001 AS ord, s_suppkey%3 AS m, unnest(['sitio ' || s_suppkey, 'gran sitio ' || s_suppkey*2 || ' sur']) AS n FROM supplier)
 SELECT id, min_by(ref_id, row(ord, ref_id)) AS ref_id FROM p LEFT JOIN r ON t <> '' AND (p.m IS NULL OR p.m = r.m) AND (contains(t, n) OR contains(n, t)) GROUP BY id"""


def point_tiles(spark: SparkSession, sf: str) -> DataFrame:
    """customer as points in vector tiles of zoom 12, at most four to a tile, and bytes that they take at least."""
    p = F.array(F.array(F.struct("lon", "lat")))
    made = V.tiles(sites(spark, sf).select(F.col("id").alias("feature_id"), F.lit("point").alias("kind"), p.alias("parts"), F.create_map(F.lit("nation"), F.col("nation").cast("string")).alias("properties")), 12, limit=4)
    return made.select("x", "y", "n_features", (F.octet_length("mvt") > 20 * F.col("n_features")).alias("has_bytes"))


SQL["point_tiles"] = f"""WITH {site_sql()}, t AS (SELECT id, floor((lon+180)/360*4096)::BIGINT AS x, floor((1-asinh(tan(radians(lat)))/pi())/2*4096)::BIGINT AS y FROM sites)
 SELECT x, y, least(4, count(*))::BIGINT AS n_features, true AS has_bytes FROM t GROUP BY ALL"""

QUERIES = {f.__name__: f for f in (area_features, features_near, projected_sites, corridor_candidates, scenario_ranks, image_registrations, common_heights, airspace_events, airspace_airports, project_places, point_tiles)}
