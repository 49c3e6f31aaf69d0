"""Scores of candidates, cells and flights: sums of capped and weighted measurements, then bands."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.texts import band


def in_context(score: Column, tile: Column, coast: float = 1.0, water: float = 1.0) -> Column:
    """A raw score, lowered on water and coast tiles and kept within 0 and 1."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score * F.when(tile == "water", water * fixed.TILE_WEIGHTS["water"]).when(tile == "coast", coast * fixed.TILE_WEIGHTS["coast"]).otherwise(1.0)))


def seam_in_context(score: Column, tile: Column, at_edge: Column) -> Column:
    """A seam's score in its context; half of it at the edge of the grid, where seams may be artefacts."""
    return in_context(score, tile) * F.when(at_edge, 0.5).otherwise(1.0)


def composite(best: Column, risk: Column, nodes: Column) -> Column:
    w = fixed.RANK_WEIGHTS
    return F.round(w["best"] * best + w["risk"] * (risk / 100.0) + w["nodes"] * F.least(nodes / 20.0, F.lit(1.0)), 4)


def ranked(candidates: DataFrame, least_score: float = 0.3, least_nodes: int = 1, on_water: float = 0.5) -> DataFrame:
    """Candidates (id, max_score, mean_risk, node_count, tile) above the thresholds, with rank_score, terrain_filtered and rank.

    Ranks are by score, then id. They are counted over range partitions of the score and not in one task.
    """
    some = candidates.where((F.coalesce("max_score", F.lit(0.0)) >= least_score) & (F.coalesce("node_count", F.lit(0)) >= least_nodes))
    raw = composite(F.col("max_score"), F.coalesce("mean_risk", F.lit(0.0)), F.col("node_count"))
    wet = F.coalesce(F.col("tile") == "water", F.lit(False))
    scored = some.withColumn("rank_score", F.when(wet, F.round(raw * on_water, 4)).otherwise(raw)).withColumn("terrain_filtered", wet)
    # How many have a better score: scores have four digits, so there are at most some ten thousand of them.
    better = scored.groupBy("rank_score").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy(F.desc("rank_score")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tied = F.row_number().over(Window.partitionBy("rank_score").orderBy("id"))
    return scored.join(F.broadcast(better.select("rank_score", before.alias("before"))), "rank_score").withColumn("rank", F.col("before") + tied).drop("before")


def top_ties(records: DataFrame, score: str = "score") -> DataFrame:
    """records with tied: the score is the greatest finite one, and another id has it too."""
    finite = F.col(score).isNotNull() & ~F.isnan(score) & (F.abs(F.col(score)) < float("inf"))
    top = records.where(finite).agg(F.max(score).alias("__top"))
    holders = records.join(F.broadcast(top), F.col(score) == F.col("__top")).agg(F.max("__top").alias("__top"), (F.countDistinct("id") > 1).alias("__tied"))
    return records.join(F.broadcast(holders), finite & (F.col(score) == F.col("__top")), "left").withColumn("tied", F.coalesce("__tied", F.lit(False))).drop("__top", "__tied")


def zones(evidence: DataFrame, x0: int, y0: int, columns: int, rows: int, cell: float = 0.02) -> DataFrame:
    """Cells (col, row) of a box of cells, with counts of evidence (lon, lat, kind, source, opening) by kind, a score and a tier.

    Cells are closed, so a point on an edge counts on both sides. Nearness alone counts nothing. Cells without any
    evidence are there with score 0.
    """
    kinds = fixed.ZONE_CAPS
    at = lambda c, base: F.when(F.col(c) / cell == F.floor(F.col(c) / cell), F.array(F.floor(F.col(c) / cell) - base, F.floor(F.col(c) / cell) - base - 1)).otherwise(F.array(F.floor(F.col(c) / cell) - base))
    hit = (
        evidence.where(F.col("kind").isin(list(kinds)))
        .select("kind", "source", "opening", F.explode(at("lon", x0)).alias("col"), at("lat", y0).alias("ys"))
        .select("kind", "source", "opening", "col", F.explode("ys").alias("row"))
        .where(F.col("col").between(0, columns - 1) & F.col("row").between(0, rows - 1))
    )
    counts = hit.groupBy("col", "row").agg(*(F.count_if(F.col("kind") == k).alias(k) for k in kinds), F.countDistinct("source").alias("n_sources"), F.count_if("opening").alias("openings"))
    every = evidence.sparkSession.range(columns * rows).select((F.col("id") % columns).alias("col"), F.floor(F.col("id") / columns).alias("row"))
    z = every.join(counts, ["col", "row"], "left").fillna(0)
    part = lambda k, cap, weight, flat: F.least(F.lit(cap), F.col(k) * weight if flat else F.log1p(k) * weight)
    bonus = F.when(F.col("n_sources") >= 3, F.least(F.lit(1.0), (F.col("n_sources") - 2) * 0.15)).otherwise(0.0)
    score = F.round(F.least(F.lit(10.0), reduce(lambda a, b: a + b, (part(k, *x) for k, x in kinds.items())) + bonus), 3)
    z = z.withColumn("score", score)
    tier = F.when((F.col("cave") > 0) | (F.col("openings") > 0), "DIRECT").when((F.col("score") >= 4.0) & (F.col("n_sources") >= 3), "SUPPORTING").when(F.col("score") > 0, "CANDIDATE").otherwise("UNRESOLVED")
    return z.withColumn("relevance", band(F.col("score"), [(7.0, "HIGH"), (4.0, "MODERATE"), (1.5, "LOW")], "VERY_LOW")).withColumn("tier", tier)


def activity(flights: DataFrame) -> DataFrame:
    """callsign, total_flights, first_seen and last_seen of every callsign that is not empty."""
    return flights.where("callsign <> ''").groupBy("callsign").agg(F.count(F.lit(1)).alias("total_flights"), F.min("takeoff").alias("first_seen"), F.max("takeoff").alias("last_seen"))


def _within(x: Column, low: Column, high: Column, below: float, above: float) -> Column:
    """1 between low and high, falling to 0 over `below` under and `above` over them."""
    return F.when(x.between(low, high), 1.0).when(x < low, F.greatest(F.lit(0.0), 1.0 - (low - x) / below)).otherwise(F.greatest(F.lit(0.0), 1.0 - (x - high) / above))


def by_hours(takeoff: Column, hours: Column) -> Column:
    hour = F.hour(takeoff)
    by_day = F.when(hour.isNull(), 0.5).when(hour.between(7, 18), 1.0).when(hour.between(6, 20), 0.6).otherwise(0.1)
    return F.when(hours == "24/7", 0.8).when(hours == "daytime", by_day).otherwise(0.5)


def profile_scores(flights: DataFrame, points: DataFrame, near: DataFrame, history: DataFrame, profiles: DataFrame) -> DataFrame:
    """Each flight against each profile: score, confidence and rank (1 is best, ties by name).

    flights: flight_id, callsign, operator, max_alt, avg_speed, minutes, takeoff, n_corridors. points: flight_id,
    speed_mph. near: flight_id, type, distance_nm. history: callsign, profile (one row a flight). profiles is a small
    table of fixed rows and goes to every task. Points, near features and history are reduced to a row a key before
    they meet the flights, so nothing but flights times profiles is multiplied.
    """
    hover = points.groupBy("flight_id").agg(F.avg(F.when(F.coalesce("speed_mph", F.lit(99.0)) < 20, 1.0).otherwise(0.0)).alias("hover"))
    closest = near.groupBy("flight_id", "type").agg(F.min(F.coalesce("distance_nm", F.lit(99.0))).alias("d")).groupBy("flight_id").agg(F.map_from_entries(F.collect_list(F.struct("type", "d"))).alias("closest"))
    counts = history.groupBy("callsign", "profile").agg(F.count(F.lit(1)).alias("c")).groupBy("callsign").agg(F.map_from_entries(F.collect_list(F.struct("profile", "c"))).alias("flown"))
    f = flights.join(hover, "flight_id", "left").join(closest, "flight_id", "left").join(counts, "callsign", "left")
    # The few profiles travel as one row; each flight is given all of them in its task.
    all_of = profiles.groupBy(F.lit(1).alias("one")).agg(F.collect_list(F.struct(*profiles.columns)).alias("p"))
    f = f.withColumn("one", F.lit(1)).join(F.broadcast(all_of), "one").select(*f.columns, F.inline("p"))
    c = F.col
    nearest = F.array_min(F.transform("near_types", lambda t: F.try_element_at("closest", t)))
    known = F.exists("operators", lambda o: F.contains(F.coalesce(c("callsign"), F.lit("")), o) | F.contains(F.coalesce(c("operator"), F.lit("")), o))
    off = F.abs(F.coalesce("hover", F.lit(0.0)) - c("hover_share"))
    signals = {
        "corridor_alignment": F.when((c("corridor_share") > 0.7) & (c("n_corridors") > 0), 0.9).when((c("search_share") > 0.7) & (c("n_corridors") == 0), 0.8).otherwise(0.4),
        "infrastructure_proximity": F.coalesce(F.greatest(F.lit(0.0), 1.0 - nearest / 10.0), F.lit(0.0)),
        "altitude_profile": _within(F.coalesce("max_alt", F.lit(0)), c("alt_low"), c("alt_high"), 2000.0, 3000.0),
        "hover_behavior": F.when(off < 0.2, 0.9).when(off < 0.4, 0.6).otherwise(0.2),
        "operator_identity": F.when(known, 1.0).otherwise(0.3),
        "repeat_frequency": F.least(F.lit(1.0), F.coalesce(F.try_element_at("flown", c("profile")), F.lit(0)) / 10.0),
        "time_pattern": by_hours(c("takeoff"), c("hours")),
        "speed_profile": _within(F.coalesce("avg_speed", F.lit(0)), c("speed_low"), c("speed_high"), 50.0, 50.0),
        "duration_profile": _within(F.coalesce("minutes", F.lit(0)), c("min_low"), c("min_high"), 60.0, 120.0),
    }
    total = F.round(reduce(lambda a, b: a + b, (signals[k] * w for k, w in fixed.MISSION_WEIGHTS.items())), 6)
    scored = f.select("flight_id", "profile", total.alias("score"))
    place = F.row_number().over(Window.partitionBy("flight_id").orderBy(F.desc("score"), "profile"))
    return scored.withColumns({"confidence": band(c("score"), [(0.75, "HIGH"), (0.5, "MEDIUM")], "LOW"), "rank": place})
