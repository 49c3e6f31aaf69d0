"""Queries over hollows, seams and steep bands of a surface."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import basins as B
from .common import rounded
from .surfaces import _CELLS, _NINE, _surface

SQL: dict[str, str] = {}
_DX, _DY = 30.0, 20.0


def surface_filled(spark: SparkSession, sf: str) -> DataFrame:
    """Every cell with its height filled to the spill level."""
    cells, shape = _surface(spark, sf)
    return rounded(B.fill(cells, shape).select("row", "col", "filled", "depth"), "filled", "depth")


def _around(x: str, pick: str) -> str:
    """Least or greatest of a cell's three by three, by two windows."""
    return f"{pick}({x}) OVER (PARTITION BY row ORDER BY col ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)"


# Water sinks step by step in a recursive table until no round changes it; it starts at the top and drains at the border.
_FILLED = f"""{_CELLS}, size AS (SELECT max(row) AS r, max(col) AS c, max(value) AS top FROM cells),
 water AS (SELECT 0 AS k, row, col, value AS g, CASE WHEN row IN (0, r) OR col IN (0, c) THEN value ELSE top END AS w, true AS moved FROM cells, size
 UNION ALL SELECT k+1, row, col, g, n, bool_or(n < w) OVER () FROM (SELECT k, row, col, g, w, least(w, greatest(g, min(a) OVER (PARTITION BY col ORDER BY row ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING))) AS n
 FROM (SELECT *, {_around("w", "min")} AS a FROM water WHERE moved))),
 filled AS MATERIALIZED (SELECT row, col, g AS value, w AS filled, w - g AS depth FROM water WHERE k = (SELECT max(k) FROM water))"""

SQL["surface_filled"] = f"WITH RECURSIVE {_FILLED} SELECT row, col, round(filled,6)+0.0 AS filled, round(depth,6)+0.0 AS depth FROM filled"

_LEAST_DEPTH, _LEAST_AREA = 6.0, 1200.0
_MEASURES = ("area", "max_depth", "mean_depth", "volume", "spill", "floor", "centre_x", "centre_y", "circularity", "elongation", "rectangularity", "wall_slope", "flat_share")


def surface_depressions(spark: SparkSession, sf: str) -> DataFrame:
    """Closed hollows with their measures."""
    cells, shape = _surface(spark, sf)
    found = B.depressions(cells, shape, _DX, _DY, _LEAST_DEPTH, _LEAST_AREA)
    return rounded(found.select("label", "n_cells", *_MEASURES, "at_edge"), *_MEASURES)


def _labelled(mask: str, fields: str) -> str:
    """lab: the cells of mask (a table with row and col) under the place of the first cell that they reach."""
    return f"""grow AS (SELECT 0 AS k, c.row, c.col, CASE WHEN m.row IS NOT NULL THEN c.row*64+c.col END AS l, true AS moved FROM cells c LEFT JOIN {mask} m ON c.row = m.row AND c.col = m.col
 UNION ALL SELECT k+1, row, col, n, bool_or(n < l) OVER () FROM (SELECT k, row, col, l, CASE WHEN l IS NOT NULL THEN min(a) OVER (PARTITION BY col ORDER BY row ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) END AS n
 FROM (SELECT *, {_around("l", "min")} AS a FROM grow WHERE moved))),
 lab AS MATERIALIZED (SELECT s.row*64+s.col AS id, {fields}, l AS lab FROM {mask} s JOIN (SELECT row, col, l FROM grow WHERE k = (SELECT max(k) FROM grow)) g ON g.row = s.row AND g.col = s.col)"""


_SLOPES = "slopes AS (SELECT row, col, degrees(atan(sqrt(gx*gx+gy*gy))) AS slope FROM grad)"
# Area-like terms of the ellipse with the same second moments.
_ELLIPSE = "var_pop(row::DOUBLE) AS vr, var_pop(col::DOUBLE) AS vc, covar_pop(row::DOUBLE, col::DOUBLE) AS rc"
_LONG, _SHORT = (f"4*sqrt(greatest(0.0, (vr+vc)/2 {s} sqrt((vr-vc)*(vr-vc)/4+rc*rc)))" for s in "+-")
_OR_ONE = "CASE WHEN {0} > 1e-7 THEN {0} ELSE 1.0 END"
# Crofton's weights for the sixteen patterns of a square: the cell, the one above (2), to the left (4) and across (8).
_WEIGHTS = "[0, a, b, 2*b, 0, a, 0, b, pi()/4, pi()/2, b, b, pi()/4, pi()/2, 0, 0]"

_REGIONS = f"""deep AS MATERIALIZED (SELECT f.*, slope FROM filled f JOIN slopes USING (row, col) WHERE depth > 1e-6), {_labelled("deep", "s.row, s.col, value, filled, depth, slope")},
 touch AS (SELECT DISTINCT lab, row + i AS row, col + j AS col FROM lab, range(0,2) p(i), range(0,2) q(j)),
 square AS (SELECT t.lab, 1*count(*) FILTER (l.row=t.row AND l.col=t.col) + 2*count(*) FILTER (l.row=t.row-1 AND l.col=t.col) + 4*count(*) FILTER (l.row=t.row AND l.col=t.col-1) + 8*count(*) FILTER (l.row=t.row-1 AND l.col=t.col-1) AS pattern
 FROM touch t JOIN lab l ON l.lab=t.lab AND l.row IN (t.row, t.row-1) AND l.col IN (t.col, t.col-1) GROUP BY t.lab, t.row, t.col),
 line AS (SELECT lab, sum({_WEIGHTS}[pattern+1]) AS outline FROM square, (SELECT pi()/4*(1+1/sqrt(2.0)) AS a, pi()/(4*sqrt(2.0)) AS b) GROUP BY lab),
 reg AS (SELECT lab, count(*) AS n, max(depth) AS max_depth, avg(depth) AS mean_depth, sum(depth)*{_DX * _DY} AS volume, min(row(-depth, id, filled, value)) AS best, avg(col)+0.5 AS cx, avg(row)+0.5 AS cy, {_ELLIPSE},
 min(row) AS r0, max(row) AS r1, min(col) AS c0, max(col) AS c1, avg(slope) AS wall_slope, avg((slope < 2.0)::INT) AS flat_share FROM lab GROUP BY lab HAVING max(depth) >= {_LEAST_DEPTH} AND count(*)*{_DX * _DY} >= {_LEAST_AREA}),
 basin AS (SELECT reg.*, n*{_DX * _DY} AS area, CASE WHEN n > 1 THEN outline ELSE 4.0 END*sqrt({_DX * _DY}) AS around, {_LONG} AS long, {_SHORT} AS short, r0 = 0 OR c0 = 0 OR r1 = size.r OR c1 = size.c AS at_edge FROM reg JOIN line USING (lab), size)"""

SQL["surface_depressions"] = f"""WITH RECURSIVE {_FILLED}, {_NINE.removeprefix(_CELLS + ",")}, {_SLOPES}, {_REGIONS}
 SELECT CAST(lab AS BIGINT) AS label, n AS n_cells, area::DOUBLE AS area, round(max_depth,6) AS max_depth, round(mean_depth,6) AS mean_depth, round(volume,6) AS volume, round(best[3],6)+0.0 AS spill, round(best[4],6)+0.0 AS floor,
 round(cx*{_DX},6) AS centre_x, round(-cy*{_DY},6) AS centre_y, round(least(1.0, 4*pi()*area/(around*around)),6) AS circularity, round(({_OR_ONE.format("long")})/({_OR_ONE.format("short")}),6) AS elongation,
 round(n/((r1-r0+1)*(c1-c0+1))::DOUBLE,6) AS rectangularity, round(wall_slope,6) AS wall_slope, round(flat_share,6) AS flat_share, at_edge FROM basin"""


def surface_basin_review(spark: SparkSession, sf: str) -> DataFrame:
    """Hollows as candidates for review: flags, class, tier and score."""
    cells, shape = _surface(spark, sf)
    found = B.basin_detections(cells, shape, _DX, _DY, _LEAST_DEPTH, _LEAST_AREA, offshore=True)
    return found.select("label", F.array_join("flags", ",").alias("flags"), "proposed_class", "tier", "score")


_STEPS = """step AS (SELECT 'column' AS axis, col AS index, lead(value) OVER (PARTITION BY row ORDER BY col) - value AS s, (SELECT max(row)+1 FROM cells) AS length FROM cells
 UNION ALL SELECT 'row', row, lead(value) OVER (PARTITION BY col ORDER BY row) - value, (SELECT max(col)+1 FROM cells) FROM cells),
 med AS (SELECT axis, index, length, median(s) AS m, count(*) AS n, count(*) FILTER (s > 0) AS up, count(*) FILTER (s < 0) AS down FROM step WHERE s IS NOT NULL GROUP BY axis, index, length HAVING count(*) >= greatest(3, ceil(0.5*length))),
 cen AS (SELECT axis, median(m) AS c, stddev_pop(m) AS sd, count(*) AS k FROM med GROUP BY axis), dev AS (SELECT axis, median(abs(m-c)) AS d FROM med JOIN cen USING (axis) GROUP BY axis),
 scaled AS (SELECT axis, index, m, (m-c)/(CASE WHEN d > 0 THEN 1.4826*d ELSE sd END) AS z, greatest(up,down)/n::DOUBLE AS sign, n/length::DOUBLE AS run FROM med JOIN cen USING (axis) JOIN dev USING (axis) WHERE k >= 5 AND (d > 0 OR sd > 0))"""
_FIND = dict(z_threshold=2.5, min_sign_share=0.5)


def surface_seams(spark: SparkSession, sf: str) -> DataFrame:
    """Grid lines whose median step stands out; the surface is rough, so the bounds are lower than for a survey."""
    cells, shape = _surface(spark, sf)
    return rounded(B.seams(cells, shape, **_FIND), "step", "robust_z", "sign_share", "run_share")


SQL["surface_seams"] = f"""WITH {_CELLS}, {_STEPS} SELECT axis, CAST(index AS BIGINT) AS index, round(m,6)+0.0 AS step, round(z,6)+0.0 AS robust_z, round(sign,6) AS sign_share, round(run,6) AS run_share FROM scaled
 WHERE abs(z) >= 2.5 AND sign >= 0.5"""

# Seams at the usual bounds cross a hollow's box.
SQL["surface_basin_review"] = f"""WITH RECURSIVE {_FILLED}, {_NINE.removeprefix(_CELLS + ",")}, {_SLOPES}, {_REGIONS}, {_STEPS},
 seam AS (SELECT axis, unnest([index, index+1]) AS l FROM scaled WHERE abs(z) >= 8.0 AND sign >= 0.9),
 j AS (SELECT *, EXISTS (SELECT 1 FROM seam WHERE (axis = 'column' AND l BETWEEN c0 AND c1) OR (axis = 'row' AND l BETWEEN r0 AND r1)) AS on_seam, max_depth/(2*sqrt(area/pi())) AS relief, least(1.0, 4*pi()*area/(around*around)) AS circ FROM basin)
 SELECT CAST(lab AS BIGINT) AS label, CASE WHEN on_seam THEN 'SEAM_OVERLAP,' ELSE '' END || 'UNCERTAINTY_UNKNOWN' || CASE WHEN at_edge THEN ',ADJOINS_EDGE' ELSE '' END AS flags,
 CASE WHEN on_seam THEN 'SURVEY_ARTIFACT' WHEN circ >= 0.7 AND relief >= 0.15 AND wall_slope >= 20 THEN 'BLUE_HOLE_CANDIDATE' ELSE 'SEAFLOOR_DEPRESSION' END AS proposed_class, 'CANDIDATE' AS tier,
 round(least(100.0, (25*least(relief/0.3,1.0)+15*circ+10*least(wall_slope/35.0,1.0)+CASE WHEN at_edge THEN 0.0 ELSE 15.0 END)*CASE WHEN on_seam THEN 0.25 ELSE 1.0 END),2) AS score FROM j"""


def surface_escarpments(spark: SparkSession, sf: str) -> DataFrame:
    """Long steep bands."""
    cells, shape = _surface(spark, sf)
    found = B.escarpments(cells, shape, _DX, _DY, 35.0, 80.0, 2.0)
    return rounded(found.select("label", "n_cells", "centre_x", "centre_y", "length", "width", "relief", "mean_slope", "proposed_class", "score"), "centre_x", "centre_y", "length", "width", "relief", "mean_slope")


SQL["surface_escarpments"] = f"""WITH RECURSIVE {_NINE}, {_SLOPES}, {_STEPS}, seam AS (SELECT axis, unnest([index, index+1]) AS l FROM scaled WHERE abs(z) >= 8.0 AND sign >= 0.9),
 steep AS MATERIALIZED (SELECT row, col, value, slope FROM slopes JOIN cells USING (row, col) WHERE slope >= 35.0), {_labelled("steep", "s.row, s.col, value, slope")},
 mark AS (SELECT *, EXISTS (SELECT 1 FROM seam WHERE (axis = 'column' AND l = col) OR (axis = 'row' AND l = row)) AS s FROM lab),
 reg AS (SELECT lab, count(*) AS n, avg(s::INT) > 0.5 AS on_seam, max(value)-min(value) AS relief, avg(slope) AS mean_slope, avg(col)+0.5 AS cx, avg(row)+0.5 AS cy, {_ELLIPSE} FROM mark GROUP BY lab),
 sized AS (SELECT *, {_LONG}*sqrt({_DX * _DY}) AS length, greatest({_SHORT}*sqrt({_DX * _DY}), sqrt({_DX * _DY})) AS width FROM reg)
 SELECT CAST(lab AS BIGINT) AS label, n AS n_cells, round(cx*{_DX},6) AS centre_x, round(-cy*{_DY},6) AS centre_y, round(length,6) AS length, round(width,6) AS width, round(relief,6) AS relief, round(mean_slope,6) AS mean_slope,
 CASE WHEN on_seam THEN 'SURVEY_ARTIFACT' ELSE 'ESCARPMENT' END AS proposed_class, round(least(100.0, 40*least(relief/50.0,1.0)+30*least(mean_slope/45.0,1.0)),2) AS score FROM sized WHERE length >= 80.0 AND length/width >= 2.0"""

QUERIES = {f.__name__: f for f in (surface_filled, surface_depressions, surface_basin_review, surface_seams, surface_escarpments)}
