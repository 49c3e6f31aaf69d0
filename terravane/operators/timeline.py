"""Scenes of a site over time: admission, comparison pairs, epochs, change scores and radar pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.texts import reasons

# Limits of the change score, and days within which two scenes count as near.
ALIGNMENT_FLOOR, ARTIFACT_HIGH, CONFIRMED, PROBABLE = 0.6, 0.7, 0.7, 0.35
ARTIFACT_WEIGHT, CONTRADICTION_WEIGHT = 0.6, 0.3
NEAR_DAYS = 30


def admit(scenes: DataFrame, most_cloud: float = 40.0) -> DataFrame:
    """Every scene (site, scene_id, ts, cloud) with a disposition; a repeated scene_id counts once, the earliest."""
    w = Window.partitionBy("site", "scene_id").orderBy(F.col("ts").asc_nulls_last(), "ord")
    first = F.row_number().over(w)
    d = F.when(F.col("ts").isNull(), "undated").when(F.col("n") > 1, "repeated").when(F.col("cloud") > most_cloud, "cloudy").otherwise("admitted")
    return scenes.withColumn("n", first).withColumn("disposition", d).drop("n")


def comparison_pairs(series: DataFrame) -> DataFrame:
    """site, before, after, pair_kind: neighbouring scenes, and the first with the last where there are three or more."""
    w = Window.partitionBy("site").orderBy("ts", "scene_id")
    named = series.select("site", F.struct("ts", "scene_id").alias("s"), F.lead(F.struct("ts", "scene_id")).over(w).alias("nxt"))
    steps = named.where("nxt is not null").select("site", F.col("s").alias("a"), F.col("nxt").alias("b"), F.lit("consecutive").alias("pair_kind"))
    ends = named.groupBy("site").agg(F.count(F.lit(1)).alias("n"), F.min("s").alias("a"), F.max("s").alias("b")).where("n >= 3").select("site", "a", "b", F.lit("baseline_latest").alias("pair_kind"))
    return steps.unionByName(ends).select("site", F.col("a.scene_id").alias("before"), F.col("b.scene_id").alias("after"), F.col("a.ts").alias("before_ts"), F.col("b.ts").alias("after_ts"), "pair_kind")


def epoch(pairs: DataFrame) -> DataFrame:
    """Pairs with their epoch class: SAME on one day, NEAR within 30 days, CROSS otherwise, UNKNOWN without a time."""
    whole = F.floor((F.unix_micros(F.col("after_ts").cast("timestamp")) - F.unix_micros(F.col("before_ts").cast("timestamp"))) / 86_400_000_000)
    c = F.when(F.col("before_ts").isNull() | F.col("after_ts").isNull(), "UNKNOWN_EPOCH").when(F.to_date("before_ts") == F.to_date("after_ts"), "SAME_EPOCH").when(whole < NEAR_DAYS, "NEAR_EPOCH").otherwise("CROSS_EPOCH")
    return pairs.withColumn("epoch", c)


def change_scores(observed: DataFrame) -> DataFrame:
    """adjusted score and class of observations (id, change, overlap, registration, scale, view, artifact, contradiction)."""
    one = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.col(c), F.lit(0.0))))
    o = observed.withColumns({c: one(c) for c in ("change", "overlap", "registration", "scale", "view", "artifact", "contradiction")})
    o = o.withColumn("alignment", F.round((F.col("overlap") + F.col("registration") + F.col("scale") + F.col("view")) / 4.0, 4))
    o = o.withColumn("adjusted", F.round(F.col("change") * F.col("alignment") * (1.0 - ARTIFACT_WEIGHT * F.col("artifact")) * (1.0 - CONTRADICTION_WEIGHT * F.col("contradiction")), 4))
    label = (
        F.when(F.col("alignment") < ALIGNMENT_FLOOR, "INSUFFICIENT_EPOCH_ALIGNMENT")
        .when((F.col("artifact") >= ARTIFACT_HIGH) & (F.col("change") >= PROBABLE), "ARTIFACT_DRIVEN_CHANGE")
        .when(F.col("adjusted") >= CONFIRMED, "CONFIRMED_VISIBLE_CHANGE")
        .when(F.col("adjusted") >= PROBABLE, "PROBABLE_CHANGE")
        .otherwise("STABLE")
    )
    return o.select("id", "alignment", "adjusted", label.alias("label"))


def radar_pairs(scenes: DataFrame, most_days: int = 24, most_baseline: float = 150.0) -> DataFrame:
    """Pairs of scenes (scene_id, orbit, mode, polarization, ts, baseline) that can be combined.

    Orbit, mode and polarization are equal, the second is later by at most most_days, and the perpendicular baselines
    differ by at most most_baseline. Scenes meet in cells of most_days, the earlier one also in the next cell.
    """
    cell = F.floor(F.datediff("ts", F.lit("1970-01-01").cast("date")) / most_days)
    a = scenes.where("orbit is not null").withColumn("cell", F.explode(F.array(cell, cell + 1)))
    b = scenes.select(F.col("scene_id").alias("second"), "orbit", "mode", "polarization", F.col("ts").alias("ts2"), F.col("baseline").alias("baseline2"), cell.alias("cell"))
    days = F.datediff("ts2", "ts")
    met = a.join(b, ["orbit", "mode", "polarization", "cell"]).where((days >= 1) & (days <= most_days) & (F.abs(F.col("baseline2") - F.col("baseline")) <= most_baseline))
    return met.select(F.col("scene_id").alias("first"), "second", days.cast("long").alias("days"))


def radar_reasons(pairs: DataFrame, most_baseline: float = 150.0) -> DataFrame:
    """Why a given pair (columns a and b, scenes as structs) can't be combined: all reasons in order; none if it can."""
    a, b = (lambda c: F.col(f"a.{c}")), (lambda c: F.col(f"b.{c}"))
    why = reasons(
        (a("orbit").isNull() | b("orbit").isNull(), "orbit missing"),
        (a("orbit") != b("orbit"), "orbit mismatch"),
        (~a("mode").eqNullSafe(b("mode")), "mode mismatch"),
        (~a("polarization").eqNullSafe(b("polarization")), "polarization mismatch"),
        (F.abs(b("baseline")) > most_baseline, "baseline too long"),
    )
    return pairs.withColumn("reasons", why)
