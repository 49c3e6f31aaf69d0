"""Ordered tracks: checks between neighbouring points, segments, shape, prediction and transitions.

A track is the rows of one flight in the order of time, then point number. Every operator partitions by flight only;
neighbours come from `lag`, so a track costs one shuffle whatever its operators. Rows with a null flight are kept and
form a track of their own.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed, geo
from ..functions.texts import hours

# Limits of plausible motion, and of the region's box.
MAX_SPEED_MPH = 180.0
MAX_CLIMB_FT_MIN = 1500.0
MAX_ERROR_NM = 5.0
MAX_ERROR_FT = 2000.0
REGION_WIDTH, REGION_HEIGHT = 0.75, 0.65


def _order() -> Window:
    return Window.partitionBy("flight_id").orderBy("ts", "point_id")


def _present(*cols: Column) -> Column:
    """Neither null nor zero: zero stands for a missing reading."""
    out = F.lit(True)
    for c in cols:
        out = out & c.isNotNull() & (c != 0)
    return out


def pairs(points: DataFrame, order: Window | None = None) -> DataFrame:
    """Each point with its predecessor's columns (prefix p_) and its number in the track; first points go.

    order lets a caller keep the reading order instead of time, which is what shows a clock that runs backward.
    """
    w = order or _order()
    before = {f"p_{c}": F.lag(c).over(w) for c in ("ts", "lon", "lat", "alt_ft")}
    return points.withColumns({**before, "idx": F.row_number().over(w) - 1}).where("idx > 0")


def validate(points: DataFrame, order: Window | None = None) -> DataFrame:
    """flight_id, idx, check_type, passed, measure: one row for each check of each neighbouring pair.

    Time that goes backward is one failure and ends the checks of the pair; equal times give no row.
    """
    p = pairs(points, order)
    dt = hours(F.col("ts"), F.col("p_ts")) * 3600.0
    miles = geo.haversine(F.col("p_lon"), F.col("p_lat"), F.col("lon"), F.col("lat"), geo.EARTH_NM) * geo.MILES_PER_NM
    speed = miles / (F.col("dt") / 3600.0)
    climb = F.abs(F.col("alt_ft") - F.col("p_alt_ft")) / (F.col("dt") / 60.0)
    row = lambda name, ok, x: F.struct(F.lit(name).alias("check_type"), ok.alias("passed"), x.cast("double").alias("measure"))
    ahead = F.col("dt") > 0
    checks = F.array_compact(
        F.array(
            F.when(F.col("dt") < 0, row("monotonic_time", F.lit(False), F.abs("dt"))),
            F.when(ahead & _present(*(F.col(c) for c in ("lat", "lon", "p_lat", "p_lon"))), row("speed", speed <= MAX_SPEED_MPH, speed)),
            F.when(ahead & _present(F.col("alt_ft"), F.col("p_alt_ft")) & (climb > MAX_CLIMB_FT_MIN), row("climb_rate", F.lit(False), climb)),
        )
    )
    return p.withColumn("dt", dt).select("flight_id", "idx", F.explode(checks).alias("c")).select("flight_id", "idx", "c.*")


def violations(points: DataFrame) -> DataFrame:
    """Failed checks of each flight and kind."""
    return validate(points).where(~F.col("passed")).groupBy("flight_id", "check_type").agg(F.count(F.lit(1)).alias("n_failed"))


def segments(points: DataFrame) -> DataFrame:
    """Horizontal, vertical and slant distance, elapsed time and speed from each point to the next."""
    p = pairs(points).withColumn("horizontal_m", geo.haversine(F.col("p_lon"), F.col("p_lat"), F.col("lon"), F.col("lat")))
    vertical = (F.col("alt_ft") - F.col("p_alt_ft")) * 0.3048
    elapsed = hours(F.col("ts"), F.col("p_ts")) * 3600.0
    slant = F.sqrt(F.col("horizontal_m") * F.col("horizontal_m") + vertical * vertical)
    return p.select("flight_id", "idx", "horizontal_m", vertical.alias("vertical_m"), slant.alias("slant_m"), elapsed.alias("elapsed_s"), F.when(elapsed > 0, slant / elapsed).alias("speed_m_s"))


def shape(points: DataFrame) -> DataFrame:
    """For each flight: points, linearity (direct over travelled distance), box coverage and hover share."""
    w = _order()
    step = geo.haversine(F.lag("lon").over(w), F.lag("lat").over(w), F.col("lon"), F.col("lat"), geo.EARTH_NM)
    at = F.struct("ts", "point_id", "lon", "lat")
    g = points.withColumn("step", step).groupBy("flight_id").agg(
        F.count(F.lit(1)).alias("n_points"),
        F.sum("step").alias("travelled"),
        F.min(at).alias("a"),
        F.max(at).alias("b"),
        (F.max("lat") - F.min("lat")).alias("dlat"),
        (F.max("lon") - F.min("lon")).alias("dlon"),
        F.avg(F.when(F.when(_present(F.col("speed_mph")), F.col("speed_mph")).otherwise(99) < 20, 1.0).otherwise(0.0)).alias("hover_share"),
    )
    direct = geo.haversine(F.col("a.lon"), F.col("a.lat"), F.col("b.lon"), F.col("b.lat"), geo.EARTH_NM)
    line = F.when((F.col("n_points") < 2) | (F.coalesce("travelled", F.lit(0.0)) <= 0), F.lit(0.0)).otherwise(F.least(F.lit(1.0), direct / F.col("travelled")))
    cover = F.least(F.lit(1.0), F.col("dlat") * F.col("dlon") / (REGION_WIDTH * REGION_HEIGHT))
    return g.select("flight_id", "n_points", line.alias("linearity"), cover.alias("coverage"), "hover_share")


def transitions(flights: DataFrame) -> DataFrame:
    """state_key, next_mission, n and probability: what followed each state of a callsign.

    A state is callsign, three-hour block, weekday (Monday 0) and the mission before.
    """
    w = Window.partitionBy("callsign").orderBy("takeoff", "flight_id")
    state = F.concat_ws("|", F.col("callsign").cast("string"), F.floor(F.hour("takeoff") / 3).cast("string"), F.weekday("takeoff").cast("string"), F.col("last"))
    seen = flights.withColumn("last", F.lag("mission").over(w)).where("last is not null").groupBy(state.alias("state_key"), F.col("mission").alias("next_mission")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy("state_key"))
    return seen.withColumn("probability", F.col("n") / total)


def heatmap(points: DataFrame, cell: float = 0.1) -> DataFrame:
    """Points of each rounded cell (half to even), intensity up to 1 and colour."""
    at = lambda c: F.rint(F.col(c) / cell)
    g = points.groupBy(at("lat").cast("long").alias("lat_cell"), at("lon").cast("long").alias("lon_cell")).agg(F.count(F.lit(1)).alias("n_points"))
    intensity = F.least(F.lit(1.0), F.col("n_points") / 10.0)
    colour = F.when(intensity > 0.7, "red").when(intensity > 0.4, "orange").otherwise("yellow")
    return g.select("*", intensity.alias("intensity"), colour.alias("colour"))


def density(cells: DataFrame) -> DataFrame:
    """One row: how many cells, their most, least and mean count, and the fullest cell (the least one of several)."""
    top = F.max_by(F.struct("lat_cell", "lon_cell"), F.struct("n_points", (-F.col("lat_cell")).alias("a"), (-F.col("lon_cell")).alias("b")))
    g = cells.agg(F.count(F.lit(1)).alias("n_cells"), F.max("n_points").alias("most"), F.min("n_points").alias("least"), F.avg("n_points").alias("mean"), top.alias("t"))
    return g.select("n_cells", "most", "least", "mean", F.col("t.lat_cell").alias("lat_cell"), F.col("t.lon_cell").alias("lon_cell"))


def _follow(rows: pd.DataFrame) -> pd.DataFrame:
    """Dead reckoning through one track; a point that is not later than the last leaves the state as it is."""
    import math

    rows = rows.sort_values("arrival", kind="stable")
    state, out = None, []
    for r in rows.itertuples(index=False):
        if state is None:
            kind, ok, error = "track_init", True, None
        else:
            lon, lat, alt, speed, heading, at = state
            dt = (r.ts - at).total_seconds()
            if dt <= 0:
                out.append((r.flight_id, r.point_id, "track_duplicate", True, None))
                continue
            nm = speed * dt / 3600.0
            y = lat + nm * math.cos(math.radians(heading)) / 60.0
            x = lon + nm * math.sin(math.radians(heading)) / (60.0 * math.cos(math.radians(lat)))
            h = math.sin(math.radians(r.lat - y) / 2) ** 2 + math.cos(math.radians(y)) * math.cos(math.radians(r.lat)) * math.sin(math.radians(r.lon - x) / 2) ** 2
            error = 2 * geo.EARTH_NM * math.asin(min(1.0, math.sqrt(h)))
            kind, ok = "track_consistency", error <= MAX_ERROR_NM and abs(r.alt_ft - alt) <= MAX_ERROR_FT
        heading = 0.0
        if state is not None:
            d, p, q = math.radians(r.lon - state[0]), math.radians(state[1]), math.radians(r.lat)
            heading = math.degrees(math.atan2(math.sin(d) * math.cos(q), math.cos(p) * math.sin(q) - math.sin(p) * math.cos(q) * math.cos(d))) % 360.0
        state = (r.lon, r.lat, r.alt_ft, r.speed_mph, heading, r.ts)
        out.append((r.flight_id, r.point_id, kind, ok, error))
    return pd.DataFrame(out, columns=["flight_id", "point_id", "check_type", "passed", "error_nm"])


HYPOTHESIS = "flight_id long, point_id long, check_type string, passed boolean, error_nm double"


def hypotheses(points: DataFrame) -> DataFrame:
    """Each point in order of arrival (column arrival) against its track's prediction.

    The state depends on which points were accepted before, so a track is one group; tracks are bounded by a flight.
    """
    cols = points.select("flight_id", "point_id", "arrival", "ts", "lon", "lat", F.col("alt_ft").cast("double").alias("alt_ft"), F.col("speed_mph").cast("double").alias("speed_mph"))
    return cols.groupBy("flight_id").applyInPandas(_follow, HYPOTHESIS)


def consensus(frames: DataFrame, fields: list[str], key: str = "callsign") -> DataFrame:
    """For each key and field the value most frames agree on, ties by mean confidence, then by value.

    Means are of decimals (15 places), so that equal ones tie in whatever order frames are added.
    """
    each = frames.select(key, "confidence", F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields))).alias("v")).select(key, "confidence", "v.*").where("value is not null and value <> ''")
    votes = each.groupBy(key, "field", "value").agg(F.count(F.lit(1)).alias("n_votes"), F.avg(F.col("confidence").try_cast(fixed.EXACT)).alias("mean_confidence"))
    over = Window.partitionBy(key, "field")
    ranked = votes.withColumns({"r": F.row_number().over(over.orderBy(F.desc("n_votes"), F.desc("mean_confidence"), "value")), "n_frames": F.sum("n_votes").over(over)})
    return ranked.where("r = 1").select(key, "field", "value", "n_votes", (F.col("n_votes") / F.col("n_frames")).alias("agreement"))


def gaps(seen: DataFrame, key: str = "site", ts: str = "ts") -> DataFrame:
    """Days between neighbouring times of each key: how many, least, median and most."""
    w = Window.partitionBy(key).orderBy(ts)
    days = hours(F.col(ts), F.lag(ts).over(w)) / 24.0
    return seen.withColumn("gap", days).where("gap is not null").groupBy(key).agg(F.count(F.lit(1)).alias("n_gaps"), F.min("gap").alias("min_days"), F.expr("percentile(gap, 0.5)").alias("median_days"), F.max("gap").alias("max_days"))

