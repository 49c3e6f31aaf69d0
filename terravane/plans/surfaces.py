"""Queries over surfaces, images, matches of detections and what evidence may claim."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.geodesy import ellipsoidal
from ..operators import evidence as E
from ..operators import joins as J
from ..operators import matching as M
from ..operators import profiles as P
from ..operators import terrain as T
from ..sources.tables import saved, table
from .common import points, rounded, site_sql, sites

SQL: dict[str, str] = {}


def _surface(spark: SparkSession, sf: str) -> tuple[DataFrame, tuple[int, int]]:
    """embeddings as a raster: a row for each vector, a column for each place in it."""
    e = table(spark, sf, "embeddings")
    top, wide = e.agg(F.coalesce(F.max("vec_id"), F.lit(0)), F.coalesce(F.max(F.size("embedding")), F.lit(1))).first()
    cells = e.select(F.col("vec_id").cast("long").alias("row"), F.posexplode("embedding").alias("col", "v")).select("row", F.col("col").cast("long").alias("col"), (F.col("v").cast("double") * 100.0).alias("value"))
    return cells, (top + 1, wide)


_CELLS = "cells AS (SELECT CAST(vec_id AS BIGINT) AS row, CAST(i-1 AS BIGINT) AS col, CAST(embedding[i] AS DOUBLE)*100.0 AS value FROM embeddings, range(1, 65) t(i))"
_NINE = f"""{_CELLS}, across AS (SELECT row, col, value AS c, lag(value,1,value) OVER a AS w, lead(value,1,value) OVER a AS e FROM cells WINDOW a AS (PARTITION BY row ORDER BY col)),
 nine AS (SELECT row, col, c, w, e, lag(c,1,c) OVER d AS n, lag(w,1,w) OVER d AS nw, lag(e,1,e) OVER d AS ne, lead(c,1,c) OVER d AS s, lead(w,1,w) OVER d AS sw, lead(e,1,e) OVER d AS se
 FROM across WINDOW d AS (PARTITION BY col ORDER BY row)),
 grad AS (SELECT *, (ne+2*e+se-nw-2*w-sw)/(8*30.0::DOUBLE) AS gx, (sw+2*s+se-nw-2*n-ne)/(8*20.0::DOUBLE) AS gy FROM nine)"""


def terrain_slope(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(T.slope(*_surface(spark, sf), 30.0, 20.0), "slope", "dz_dx", "dz_dy", "area_ratio", "shade")


SQL["terrain_slope"] = f"""WITH {_NINE}, a AS (SELECT *, atan(sqrt(gx*gx+gy*gy)) AS sl, atan2(gy,-gx) AS asp FROM grad)
 SELECT row, col, round(degrees(sl),6) AS slope, round(gx,6)+0.0 AS dz_dx, round(gy,6)+0.0 AS dz_dy, round(sqrt(1+gx*gx+gy*gy),6) AS area_ratio,
 round(greatest(0.0, least(1.0, sin(radians(45.0))*cos(sl)+cos(radians(45.0))*sin(sl)*cos(radians(135.0)-asp))),6) AS shade FROM a"""


def terrain_curvatures(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(T.curvatures(*_surface(spark, sf), 30.0, 20.0), "profile", "plan", "general", places=5)


SQL["terrain_curvatures"] = f"""WITH {_NINE}, k AS (SELECT *, (w-2*c+e)/900.0::DOUBLE AS xx, (n-2*c+s)/400.0::DOUBLE AS yy, (nw-ne-sw+se)/2400.0::DOUBLE AS xy, gx*gx+gy*gy AS p FROM grad)
 SELECT row, col, round(CASE WHEN p > 0 THEN -(xx*gx*gx+2*xy*gx*gy+yy*gy*gy)/(p*pow(1+p,1.5)) ELSE 0.0 END,5)+0.0 AS profile,
 round(CASE WHEN p > 0 THEN -(xx*gy*gy-2*xy*gx*gy+yy*gx*gx)/pow(p,1.5) ELSE 0.0 END,5)+0.0 AS plan, round(-(xx+yy),5)+0.0 AS general FROM k"""


def terrain_roughness(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(T.roughness(*_surface(spark, sf)), "roughness")


SQL["terrain_roughness"] = f"WITH {_NINE} SELECT row, col, round(list_stddev_pop([nw,n,ne,w,c,e,sw,s,se]),6) AS roughness FROM nine"


def terrain_relief(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(T.relief(*_surface(spark, sf), 3), "relief")


SQL["terrain_relief"] = f"""WITH {_CELLS}, r AS (SELECT row, col, max(value) OVER a AS hi, min(value) OVER a AS lo FROM cells WINDOW a AS (PARTITION BY row ORDER BY col ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING))
 SELECT row, col, round(max(hi) OVER d - min(lo) OVER d,6) AS relief FROM r WINDOW d AS (PARTITION BY col ORDER BY row ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)"""


def terrain_annulus(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(T.annulus_index(*_surface(spark, sf), 2, 1), "index")


SQL["terrain_annulus"] = f"""WITH {_CELLS}, o AS (SELECT i, j FROM range(-2,3) a(i), range(-2,3) b(j) WHERE i*i+j*j BETWEEN 1 AND 4), near AS (SELECT row+i AS row, col+j AS col, avg(value) AS m FROM cells, o GROUP BY 1, 2)
 SELECT row, col, round(value-m,6)+0.0 AS index FROM cells JOIN near USING (row, col)"""


def terrain_ruggedness(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(T.ruggedness(*_surface(spark, sf), 30.0, 20.0), "ruggedness")


def _sum9(x: str) -> str:
    return f"(lag({x},1,{x}) OVER d + {x} + lead({x},1,{x}) OVER d)"


SQL["terrain_ruggedness"] = f"""WITH {_NINE}, u AS (SELECT row, col, gx/sqrt(gx*gx+gy*gy+1) AS x, gy/sqrt(gx*gx+gy*gy+1) AS y, 1/sqrt(gx*gx+gy*gy+1) AS z FROM grad),
 l AS (SELECT row, col, {_sum9("x")} AS x, {_sum9("y")} AS y, {_sum9("z")} AS z FROM u WINDOW d AS (PARTITION BY row ORDER BY col)),
 t AS (SELECT row, col, {_sum9("x")} AS x, {_sum9("y")} AS y, {_sum9("z")} AS z FROM l WINDOW d AS (PARTITION BY col ORDER BY row))
 SELECT row, col, round(greatest(0.0, least(1.0, 1-sqrt(x*x+y*y+z*z)/9)),6) AS ruggedness FROM t"""


def terrain_sample(spark: SparkSession, sf: str) -> DataFrame:
    s = sites(spark, sf).select("id", F.col("lon").alias("x"), F.col("lat").alias("y"))
    return rounded(T.sample(s, _surface(spark, sf)[0], (-67.30005, 18.60005), (0.03, 0.007)).select("id", "row", "col", "value"), "value")


SQL["terrain_sample"] = f"""WITH {_CELLS}, {site_sql()}, spot AS (SELECT id, CAST(floor((18.60005-lat)/0.007) AS BIGINT) AS row, CAST(floor((lon-(-67.30005))/0.03) AS BIGINT) AS col FROM sites)
 SELECT id, row, col, round(value,6)+0.0 AS value FROM spot LEFT JOIN cells USING (row, col)"""


def _images(spark: SparkSession, sf: str) -> DataFrame:
    cells = _surface(spark, sf)[0]
    return cells.select(F.floor(F.col("row") / 64).alias("image_id"), (F.col("row") % 64).alias("row"), "col", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("value") / 200.0 + 0.5)).alias("value"))


_IMAGES = f"{_CELLS}, px AS (SELECT row//64 AS image_id, row%64 AS row, col, greatest(0.0, least(1.0, value/200.0+0.5)) AS value FROM cells)"


def image_measures(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(T.image_measures(_images(spark, sf)), "entropy", "edge", "banding", "coherence")


SQL["image_measures"] = f"""WITH {_IMAGES}, b AS (SELECT image_id, least(31, floor(value*32)) AS bin, count(*) AS n FROM px GROUP BY 1, 2), h AS (SELECT image_id, log2(sum(n))-sum(n*log2(n))/sum(n) AS entropy FROM b GROUP BY 1),
 g AS (SELECT image_id, lead(value) OVER (PARTITION BY image_id, row ORDER BY col) - value AS gx, lead(value) OVER (PARTITION BY image_id, col ORDER BY row) - value AS gy FROM px),
 e AS (SELECT image_id, coalesce(avg(sqrt(gx*gx+gy*gy)),0.0) AS edge FROM g GROUP BY 1), r AS (SELECT image_id, row, avg(value) AS m FROM px GROUP BY 1, 2), rb AS (SELECT image_id, stddev_pop(m) AS banding FROM r GROUP BY 1),
 c AS (SELECT image_id, col, avg(value) AS m FROM px GROUP BY 1, 2), cb AS (SELECT image_id, stddev_pop(m) AS across FROM c GROUP BY 1),
 f AS (SELECT image_id, entropy, edge, banding, across/(banding+1e-9) AS coherence FROM h JOIN e USING (image_id) JOIN rb USING (image_id) JOIN cb USING (image_id))
 SELECT image_id, round(entropy,6) AS entropy, round(edge,6) AS edge, round(banding,6) AS banding, round(coherence,6) AS coherence,
 round((0.30*least(entropy/5.0,1.0)+0.30*least(edge*20.0,1.0)+0.20*least(banding*15.0,1.0)+0.20*least(coherence,1.0))*100.0,2) AS risk FROM f"""


def changed_share(spark: SparkSession, sf: str) -> DataFrame:
    a = _images(spark, sf)
    return rounded(T.changed_share(a, a.withColumn("value", F.col("value") * F.col("value")), 0.24), "changed")


SQL["changed_share"] = f"WITH {_IMAGES} SELECT image_id, count(*) AS n_pixels, round(avg((abs(value-value*value) > 0.24)::INT::DOUBLE),6) AS changed FROM px GROUP BY 1"


def _detections(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    x, y = F.col("lon") * 1000.0, F.col("lat") * 1000.0
    kind = (F.col("nation") % 3).cast("string").alias("class")
    d = sites(spark, sf, "supplier").select(F.col("id").alias("d"), kind, x.alias("x"), y.alias("y"))
    return d, sites(spark, sf).select(F.col("id").alias("l"), kind, x.alias("x"), y.alias("y"), (5.0 + F.col("id") % 20).cast("double").alias("radius"))


_PAIRS = f"""{site_sql("supplier", "supp")}, {site_sql()}, pairs AS (SELECT s.id AS d, t.id AS l, sqrt((s.lon*1000.0-t.lon*1000.0)*(s.lon*1000.0-t.lon*1000.0)+(s.lat*1000.0-t.lat*1000.0)*(s.lat*1000.0-t.lat*1000.0)) AS distance, 5.0 + t.id % 20 AS radius
 FROM supp s JOIN sites t ON s.nation % 3 = t.nation % 3)"""


def match_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(M.near_pairs(*_detections(spark, sf), 15.0), "distance")


SQL["match_pairs"] = f"WITH {_PAIRS} SELECT d, l, round(distance,6) AS distance FROM pairs WHERE distance <= radius"


def match_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Greedy, so without SQL; tests/test_surfaces.py holds the matching against a plain walk."""
    d, lab = _detections(spark, sf)
    return M.scores(d, lab, M.matched(d, lab, 15.0))


def ellipsoid_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Distances on the ellipsoid of pairs within 3 km on the sphere; tests hold the formula against known lines."""
    s, t = sites(spark, sf), sites(spark, sf, "supplier")
    near = J.place_pairs(s, t, 3_000.0)
    pairs = saved(near.select("place", "other_place", F.round(ellipsoidal("place.lon", "place.lat", "other_place.lon", "other_place.lat"), 4).alias("metres")))
    return J.spelled_places(pairs, s.select("id", "lon", "lat"), t.select("id", "lon", "lat")).select("id", "other_id", "metres")


def kmeans_profiles(spark: SparkSession, sf: str) -> DataFrame:
    """Clusters depend on the seed, so there is no SQL; tests hold the assignment and the labels."""
    up = lambda c, top: F.least(F.lit(1.0), c / top)
    p = points(spark, sf)
    v = p.groupBy("flight_id").agg(
        up(F.max("alt_ft"), 10000.0).alias("altitude"), up(F.avg("speed_mph"), 180.0).alias("speed"), up(F.count(F.lit(1)), 480.0).alias("duration"), up(F.max("alt_ft") - F.min("alt_ft"), 5000.0).alias("altitude_range"),
        F.avg((F.col("speed_mph") < 30).cast("double")).alias("hover"), F.lit(0.5).alias("linearity"),
        up((F.max("lat") - F.min("lat")) * (F.max("lon") - F.min("lon")), 0.75 * 0.65).alias("coverage"), F.avg((~F.col("lat").between(18.05, 18.35)).cast("double")).alias("coastal"), F.lit(0.5).alias("infrastructure"),
    )
    return P.describe(P.clusters(v.withColumn("callsign", F.col("flight_id").cast("string"))))


_KINDS = ["sar_amplitude_change", "coherence_loss", "optical_change", "terrain_morphology", "multi_epoch_lidar_elevation", "field_or_authoritative_record"]


def signal_tiers(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.element_at(F.array(*(F.lit(k) for k in _KINDS)), (F.col("event_id") % 23 % 6 + 1).cast("int"))
    g = table(spark, sf, "events").groupBy(F.col("user_id"), F.floor(F.col("event_id") / 7).alias("part")).agg(F.collect_set(kind).alias("s"))
    return g.select("user_id", "part", E.signal_tier(F.col("s")).alias("tier"))


SQL["signal_tiers"] = f"""WITH g AS (SELECT user_id, event_id//7 AS part, array_to_string(list_sort(list(DISTINCT {_KINDS}[event_id%23%6+1])),'+') AS s FROM events GROUP BY 1, 2)
 SELECT user_id, part, CASE {" ".join(f"WHEN s = '{'+'.join(sorted(k))}' THEN '{t}'" for k, t in fixed.SIGNAL_SETS)} {" ".join(f"WHEN contains(s, '{k}') THEN '{t}'" for k, t in fixed.SIGNAL_FALLBACK)} ELSE '{fixed.SIGNAL_WEAKEST}' END AS tier FROM g"""


def decision_events(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("event_id")
    word = F.element_at(F.array(*(F.lit(w) for w in _WORDS)), (k % 31 % 13 + 1).cast("int"))
    return E.decide(table(spark, sf, "events").select(F.col("user_id").alias("uid"), k.alias("ord"), word.alias("decision"), F.when(k % 2 == 0, F.array(F.lit(fixed.FIELD_SIGNAL))).alias("signals")))


_WORDS = ["promote", "hold", "downgrade", "promote", "hold", "promote", "downgrade", "hold", "guess", "promote", "hold", "confirm", "reject"]
SQL["decision_events"] = f"""WITH d AS (SELECT user_id AS uid, event_id AS ord, {_WORDS}[event_id%31%13+1] AS decision, event_id%2=0 AS f FROM events),
 c AS (SELECT *, decision <> 'guess' AND (decision <> 'confirm' OR f) AS ok, CASE decision WHEN 'confirm' THEN 'confirmed' WHEN 'reject' THEN 'rejected' WHEN 'promote' THEN 'supported_candidate' WHEN 'downgrade' THEN 'candidate' END AS target FROM d),
 m AS (SELECT *, min(ord) FILTER (ok AND decision IN ('confirm','reject')) OVER (PARTITION BY uid) AS closing FROM c),
 l AS (SELECT *, ok AND (closing IS NULL OR ord <= closing OR decision = 'hold') AS legal FROM m),
 p AS (SELECT *, coalesce(last_value(CASE WHEN legal THEN target END IGNORE NULLS) OVER (PARTITION BY uid ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 'candidate') AS previous FROM l)
 SELECT uid, ord, decision, previous, CASE WHEN legal THEN coalesce(target, previous) ELSE previous END AS status, legal,
 CASE WHEN legal THEN NULL WHEN decision = 'guess' THEN 'unknown' WHEN ord > closing AND decision <> 'hold' THEN 'terminal' ELSE 'no field signal' END AS reason FROM p"""


def lineage_roots(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("p_partkey")
    p = table(spark, sf, "part")
    s = p.select(k.alias("source"), F.when(k % 7 != 0, F.concat(F.lit(" R"), (k % 5).cast("string"))).alias("root"))
    links = p.where(k > 12).select(k.alias("source"), F.explode(F.array(F.floor(k / 2), F.floor(k / 3) + 1)).alias("parent"))
    return E.lineage_roots(s, links)


SQL["lineage_roots"] = """WITH RECURSIVE s AS (SELECT p_partkey AS source, CASE WHEN p_partkey%7 <> 0 THEN 'R' || CAST(p_partkey%5 AS VARCHAR) END AS root FROM part),
 e AS (SELECT p_partkey AS source, p_partkey//2 AS parent FROM part WHERE p_partkey > 12 UNION SELECT p_partkey, p_partkey//3+1 FROM part WHERE p_partkey > 12),
 w AS (SELECT source, source AS at FROM s UNION SELECT w.source, e.parent FROM w JOIN e ON e.source = w.at)
 SELECT DISTINCT w.source, s.root FROM w JOIN s ON s.source = w.at WHERE s.root IS NOT NULL AND w.at <= 12"""

_DIMS = ["EXISTENCE", "MORPHOLOGY", "PHYSICAL_OPENING", "ACCESSIBILITY", "CONNECTIVITY", "FUNCTION"]
_CLAIMS = ["FACT", "COMPUTED", "BINDING", "INFERENCE", "FACT", "HYPOTHESIS", "COMPUTED"]
_BASES = ["survey", "morphology", "survey", "name_only", "record"]
_STATES = ["REGISTERED", "REFERENCED_ONLY", "REGISTERED", "UNREGISTERED"]
_ASKED = ["UNRESOLVED", "CANDIDATE", "SUPPORTING", "DIRECT", "DIRECT", "DIRECT", "DIRECT", "CONTRADICTED"]


def _worth(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem as assertions about orders, supplier as their sources."""
    of = lambda xs, k: F.element_at(F.array(*(F.lit(x) for x in xs)), (k % len(xs) + 1).cast("int"))
    o, n, s, p = (F.col(c) for c in ("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"))
    a = table(spark, sf, "lineitem").select(
        (o * 10 + n).alias("assertion"), o.alias("feature"), of(_ASKED, p + n).alias("tier"), of(_DIMS, n).alias("dimension"), of(_CLAIMS, p).alias("claim"),
        F.when(p % 11 != 0, F.array(of(_BASES, o))).alias("bases"), F.when(p % 13 == 0, F.array(s.cast("long"), F.lit(-1).cast("long"))).otherwise(F.array(s.cast("long"))).alias("source_ids"),
    )
    sources = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("source"), of(_STATES, F.col("s_suppkey")).alias("provenance"), (F.col("s_suppkey") % 4 == 0).alias("direct"))
    return E.effective_tiers(a, sources)


_LOW = "(p%11=0 OR basis = 'name_only' OR (basis = 'morphology' AND dimension NOT IN ('EXISTENCE','MORPHOLOGY')) OR claim = 'HYPOTHESIS' OR NOT ok OR state = 'UNREGISTERED')"
_WORTH = f"""a AS (SELECT l_orderkey*10+l_linenumber AS assertion, l_orderkey AS feature, {_ASKED}[(l_partkey+l_linenumber)%8+1] AS tier, {_DIMS}[l_linenumber%6+1] AS dimension, {_CLAIMS}[l_partkey%7+1] AS claim,
 {_BASES}[l_orderkey%5+1] AS basis, l_partkey AS p, l_partkey%13 <> 0 AND s_suppkey IS NOT NULL AS ok, {_STATES}[l_suppkey%4+1] AS state, l_suppkey%4=0 AS direct FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey),
 cap AS (SELECT *, CASE WHEN {_LOW} THEN 1 WHEN claim = 'INFERENCE' OR NOT direct THEN 2 ELSE 3 END AS ceiling, list_position({fixed.TIERS}, tier)-1 AS asked FROM a),
 worth AS (SELECT *, CASE WHEN asked IN (0, 4) OR asked <= ceiling THEN asked ELSE ceiling END AS r FROM cap)"""


def effective_tiers(spark: SparkSession, sf: str) -> DataFrame:
    return _worth(spark, sf).select("assertion", "dimension", "tier", "effective")


SQL["effective_tiers"] = f"WITH {_WORTH} SELECT assertion, dimension, tier, {fixed.TIERS}[r+1] AS effective FROM worth"


def evidence_rungs(spark: SparkSession, sf: str) -> DataFrame:
    return E.rungs(_worth(spark, sf))


SQL["evidence_rungs"] = f"""WITH {_WORTH}, t AS (SELECT feature, dimension, max(r) AS r FROM worth GROUP BY 1, 2),
 g AS (SELECT feature, coalesce(bool_or(dimension='EXISTENCE' AND r IN (2,3)),false) AS a, coalesce(bool_or(dimension='PHYSICAL_OPENING' AND r=3),false) AS b, coalesce(bool_or(dimension='ACCESSIBILITY' AND r=3),false) AS c,
 coalesce(bool_or(dimension='CONNECTIVITY' AND r=3),false) AS d, coalesce(string_agg(dimension, ',' ORDER BY dimension) FILTER (r=4),'') AS contradicted FROM t GROUP BY 1)
 SELECT feature, CASE WHEN NOT a THEN 0 WHEN NOT b THEN 1 WHEN NOT c THEN 2 WHEN NOT d THEN 3 ELSE 4 END::BIGINT AS rung, contradicted FROM g"""

QUERIES = {
    f.__name__: f
    for f in (
        terrain_slope, terrain_curvatures, terrain_roughness, terrain_relief, terrain_annulus, terrain_ruggedness, terrain_sample, image_measures, changed_share, match_pairs, match_scores, ellipsoid_pairs, kmeans_profiles,
        signal_tiers, decision_events, lineage_roots, effective_tiers, evidence_rungs,
    )
}
