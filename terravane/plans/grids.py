"""Queries over cells, groups of nodes and sites."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from ..operators import area as A
from ..operators import grids as G
from ..sources.tables import table
from .common import rounded, site_sql, sites

SQL: dict[str, str] = {}


def line_in_cell(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    x, y = (k * 37 % 1800 * 100).cast("double"), (k * 53 % 700 * 100).cast("double")
    s = table(spark, sf, "orders").select(k.alias("line_id"), x.alias("x1"), y.alias("y1"), (x + k * 31 % 4001 - 2000.0).alias("x2"), (y + F.when(k % 5 == 0, 0).otherwise(k * 17 % 3001 - 1500)).alias("y2"))
    return rounded(G.lines_in_cells(s, 1000.0, 180, 70), "length", places=4)


def _t(p: str, d: str, c: str) -> tuple[str, str]:
    a, b = f"({c}*1000.0::DOUBLE-{p})/{d}", f"(({c}+1)*1000.0::DOUBLE-{p})/{d}"
    return f"CASE WHEN {d}=0 THEN 0.0 ELSE least({a},{b}) END", f"CASE WHEN {d}=0 THEN 1.0 ELSE greatest({a},{b}) END"


(_X0, _X1), (_Y0, _Y1) = _t("x", "dx", "col"), _t("y", "dy", "row")
SQL["line_in_cell"] = f"""WITH s AS (SELECT o_orderkey AS line_id, (o_orderkey*37%1800*100)::DOUBLE AS x, (o_orderkey*53%700*100)::DOUBLE AS y, (o_orderkey*31%4001-2000)::DOUBLE AS dx, (CASE WHEN o_orderkey%5=0 THEN 0 ELSE o_orderkey*17%3001-1500 END)::DOUBLE AS dy FROM orders),
 n AS (SELECT *, CAST(floor(x/1000) AS BIGINT)+i AS col, CAST(floor(y/1000) AS BIGINT)+j AS row FROM s, range(-4,5) a(i), range(-3,4) b(j)),
 c AS (SELECT * FROM n WHERE col BETWEEN 0 AND 179 AND row BETWEEN 0 AND 69 AND least(x,x+dx) <= (col+1)*1000 AND greatest(x,x+dx) >= col*1000 AND least(y,y+dy) <= (row+1)*1000 AND greatest(y,y+dy) >= row*1000),
 l AS (SELECT line_id, col, row, greatest(0.0, least(1.0, {_X1}, {_Y1}) - greatest(0.0, {_X0}, {_Y0}))*sqrt(dx*dx+dy*dy) AS length FROM c)
 SELECT line_id, col, row, round(length,4) AS length FROM l WHERE length > 1e-6"""


def polygon_in_cell(spark: SparkSession, sf: str) -> DataFrame:
    """Boxes of suppliers, each with a hole, told as edges."""
    k = F.col("s_suppkey")
    b = table(spark, sf, "supplier").select(k.alias("polygon_id"), (k * 37 % 1700 * 100 + 50.0).alias("x"), (k * 53 % 650 * 100 + 50.0).alias("y"), (1000.0 + k % 7 * 450).alias("w"), (800.0 + k % 5 * 350).alias("h"))
    edge = lambda r, a, c, d, e: F.struct(F.lit(r).alias("ring"), a.alias("x1"), c.alias("y1"), d.alias("x2"), e.alias("y2"))
    out = []
    for r, m in ((0, 0.0), (1, 100.0)):
        x0, y0, x1, y1 = F.col("x") + m, F.col("y") + m, F.col("x") + F.col("w") - m, F.col("y") + F.col("h") - m
        out += [edge(r, x0, y0, x1, y0), edge(r, x1, y0, x1, y1), edge(r, x1, y1, x0, y1), edge(r, x0, y1, x0, y0)]
    return rounded(G.polygons_in_cells(b.select("polygon_id", F.inline(F.array(*out))), 1000.0, 180, 70), "area", "share")


SQL["polygon_in_cell"] = """WITH b AS (SELECT s_suppkey AS polygon_id, s_suppkey*37%1700*100+50.0::DOUBLE AS x, s_suppkey*53%650*100+50.0::DOUBLE AS y, 1000.0::DOUBLE+s_suppkey%7*450 AS w, 800.0::DOUBLE+s_suppkey%5*350 AS h FROM supplier),
 n AS (SELECT *, CAST(floor(x/1000) AS BIGINT)+i AS col, CAST(floor(y/1000) AS BIGINT)+j AS row FROM b, range(0,6) a(i), range(0,5) c(j)),
 o AS (SELECT polygon_id, col, row, greatest(0.0, least(x+w,(col+1)*1000)-greatest(x,col*1000))*greatest(0.0, least(y+h,(row+1)*1000)-greatest(y,row*1000))
 - greatest(0.0, least(x+w-100,(col+1)*1000)-greatest(x+100,col*1000))*greatest(0.0, least(y+h-100,(row+1)*1000)-greatest(y+100,row*1000)) AS area FROM n WHERE col BETWEEN 0 AND 179 AND row BETWEEN 0 AND 69)
 SELECT polygon_id, col, row, round(area,6) AS area, round(area/1000000.0,6) AS share FROM o WHERE area > 1e-6"""


def _sets(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select((k % 3).alias("set_id"), (k * 7 % 40).alias("row"), (k * 11 % 120).alias("col"))


_SETS = "c AS (SELECT DISTINCT o_orderkey%3 AS set_id, o_orderkey*7%40 AS row, o_orderkey*11%120 AS col FROM orders)"


def cell_set_boundary(spark: SparkSession, sf: str) -> DataFrame:
    return G.edge_of_set(_sets(spark, sf))


SQL["cell_set_boundary"] = f"""WITH {_SETS} SELECT set_id, row, col, (SELECT count(*) FROM c d WHERE d.set_id = c.set_id AND abs(d.row-c.row)+abs(d.col-c.col) = 1) = 4 AS interior FROM c"""


def cell_set_widened(spark: SparkSession, sf: str) -> DataFrame:
    return G.widen_set(_sets(spark, sf), 1, 2, 40, 120)


SQL["cell_set_widened"] = f"WITH {_SETS} SELECT DISTINCT set_id, row+i AS row, col+j AS col FROM c, range(-1,2) a(i), range(-2,3) b(j) WHERE row+i BETWEEN 0 AND 39 AND col+j BETWEEN 0 AND 119"


def cluster_scores(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("l_orderkey")
    tier = F.concat(F.lit("T"), (F.col("l_partkey") % 6 + 1).cast("string"))
    nodes = table(spark, sf, "lineitem").select(k.alias("cluster"), F.concat(F.lit("r"), (F.col("l_partkey") % 5).cast("string")).alias("role"), F.col("l_returnflag").alias("domain"), F.col("l_linestatus").alias("function"), tier.alias("tier"), F.when(F.col("l_suppkey") % 9 == 0, 1).alias("contradictions"))
    return G.group_scores(nodes)


_BEST = " ".join(f"WHEN tier = '{t}' THEN {v}" for t, v in G.TIER_POINTS.items())
SQL["cluster_scores"] = f"""WITH n AS (SELECT l_orderkey AS cluster, 'r' || CAST(l_partkey%5 AS VARCHAR) AS role, l_returnflag AS domain, l_linestatus AS fn, 'T' || CAST(l_partkey%6+1 AS VARCHAR) AS tier, l_suppkey%9=0 AS bad FROM lineitem),
 g AS (SELECT cluster, count(*) AS n, count(DISTINCT role) AS n_roles, count(DISTINCT domain) AS n_domains, count(DISTINCT fn) AS n_functions, max(CASE {_BEST} ELSE 0 END) AS best, count(*) FILTER (bad) AS against, bool_or(tier IN ('T1','T2')) AS good FROM n GROUP BY 1),
 a AS (SELECT *, least(n,5)*5.0::DOUBLE+least(n_roles,4)*7.5::DOUBLE+least(n_domains,3)*6+least(n_functions,3)*4+best-least(against,3)*10 AS raw FROM g),
 b AS (SELECT *, CASE WHEN n < 2 THEN least(raw,29.0) ELSE raw END AS one FROM a), c AS (SELECT *, CASE WHEN one > 70 AND (n_roles < 2 OR n_domains < 2) THEN 69.0 ELSE one END AS two FROM b)
 SELECT cluster, n, n_roles, n_domains, n_functions, greatest(0.0, least(100.0, CASE WHEN two > 85 AND NOT good THEN 84.0 ELSE round(two,2) END)) AS score FROM c"""


def site_scores(spark: SparkSession, sf: str) -> DataFrame:
    rules = table(spark, sf, "region").select(F.col("r_name").alias("factor"), (F.col("r_regionkey") * 2 - 1).cast("long").alias("delta"))
    names = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(names, F.col("c_nationkey") == F.col("n_nationkey"))
    return G.site_confidence(o.select(F.col("o_custkey").alias("site"), F.concat(F.lit(" "), F.col("r_name")).alias("factor"), F.when(F.col("o_orderkey") % 3 == 0, "confirmed").otherwise("pending").alias("status")), rules)


SQL["site_scores"] = """WITH g AS (SELECT o_custkey AS site, CAST(coalesce(sum(CASE WHEN o_orderkey%3 = 0 THEN n_regionkey*2-1 END), 0) AS BIGINT) AS score FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)
 SELECT site, score, CASE WHEN score <= 3 THEN 'low-interest / likely ordinary' WHEN score <= 7 THEN 'monitor / contextual infrastructure' WHEN score <= 11 THEN 'high-interest utility node' ELSE 'anomalous infrastructure candidate requiring deeper validation' END AS class FROM g"""


def infra_report(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("feature_id"), F.col("l_quantity").cast("double").alias("distance"))
    return rounded(G.nearby_report(e, table(spark, sf, "part").select(F.col("p_partkey").alias("feature_id"), F.col("p_name").alias("name"))), "mean_distance")


SQL["infra_report"] = "SELECT p_name AS name, count(*) AS n_events, round(avg(l_quantity::DOUBLE),6) AS mean_distance FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY n_events DESC, name LIMIT 10"


def tile_bounds(spark: SparkSession, sf: str) -> DataFrame:
    x, y = geo.xyz_tile(F.col("lon"), F.col("lat"), 12)
    t = sites(spark, sf).select(x.alias("x"), y.alias("y")).distinct()
    b = G.tile_bounds(F.col("x"), F.col("y"), 12)
    return rounded(t.withColumns(b), *b)


SQL["tile_bounds"] = f"""WITH {site_sql()}, t AS (SELECT DISTINCT CAST(floor((lon+180.0)/360.0*4096.0) AS BIGINT) AS x, CAST(floor((1.0-ln(tan(radians(lat))+1.0/cos(radians(lat)))/pi())/2.0*4096.0) AS BIGINT) AS y FROM sites)
 SELECT x, y, round(x/4096.0*360.0-180.0,6) AS west, round(degrees(atan(sinh(pi()*(1.0-2.0*(y+1)/4096.0)))),6) AS south, round((x+1)/4096.0*360.0-180.0,6) AS east, round(degrees(atan(sinh(pi()*(1.0-2.0*y/4096.0)))),6) AS north FROM t"""


def grid_v2_receipt(spark: SparkSession, sf: str) -> DataFrame:
    """How many points bind to no, one, two or four cells."""
    k = F.col("c_custkey")
    p = table(spark, sf, "customer").select(k.alias("id"), (k * 37 % 1800 * 100).cast("decimal(18,3)").alias("x"), (k * 53 % 700 * 100).cast("decimal(18,3)").alias("y"))
    bound = A.bind_exact(p, 250, 720, 280).groupBy("id").agg(F.count(F.lit(1)).alias("n_cells"))
    return p.select("id").join(bound, "id", "left").groupBy(F.coalesce("n_cells", F.lit(0)).cast("long").alias("n_cells")).agg(F.count(F.lit(1)).alias("n_points"))


SQL["grid_v2_receipt"] = """WITH xy AS (SELECT c_custkey AS id, (c_custkey*37)%1800*100 AS x, (c_custkey*53)%700*100 AS y FROM customer),
 c AS (SELECT id, (SELECT count(*) FROM range(-1,1) a(i) WHERE (i=0 OR x%250=0) AND x//250+i BETWEEN 0 AND 719)*(SELECT count(*) FROM range(-1,1) a(i) WHERE (i=0 OR y%250=0) AND y//250+i BETWEEN 0 AND 279) AS n_cells FROM xy)
 SELECT n_cells, count(*) AS n_points FROM c GROUP BY 1"""

QUERIES = {f.__name__: f for f in (line_in_cell, polygon_in_cell, cell_set_boundary, cell_set_widened, cluster_scores, site_scores, infra_report, tile_bounds, grid_v2_receipt)}
