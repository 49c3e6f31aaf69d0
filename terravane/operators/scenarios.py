"""Relevance of zones with some families of evidence left out, and how steady their ranks are."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.texts import band
from ..sources.tables import saved

# Families that are left out in each scenario, and for each term its cap, its weight and whether it grows in proportion.
LEFT_OUT = {
    "BASE": (),
    "NO_UTILITY": ("UTILITIES_UNDERGROUND",),
    "NO_HISTORY": ("HISTORICAL_CORROBORATION",),
    "NO_INDUSTRIAL": ("INDUSTRIAL_REMEDIATION",),
    "NO_UTILITY_HISTORY": ("UTILITIES_UNDERGROUND", "HISTORICAL_CORROBORATION"),
    "NO_UTILITY_HISTORY_INDUSTRIAL": ("UTILITIES_UNDERGROUND", "HISTORICAL_CORROBORATION", "INDUSTRIAL_REMEDIATION"),
}
TERMS = {"cave": (3.0, 3.0, True), "groundwater": (2.5, 0.75, False), "mine": (2.0, 0.9, False), "industrial": (0.75, 0.25, False), "utility": (0.50, 0.08, False), "history": (0.25, 0.05, False)}
STEPS = [(7.0, "HIGH"), (4.0, "MODERATE"), (1.5, "LOW")]
#: Ids of zones in one block of a rank.
BLOCK = 65_536


def scenario_scores(hits: DataFrame, zones: DataFrame) -> DataFrame:
    """zone_id, scenario, groundwater, mine (counts of things) and score for every zone and scenario.

    hits: zone_id, family, source, ground, mine, cave, history (booleans), asset and asset_class. Records of one thing
    of the fitting class count once; those bound to no such thing count each. Zones without hits have score 0.
    """
    scenarios = F.array(*(F.struct(F.lit(n).alias("scenario"), F.array(*(F.lit(f) for f in out)).cast("array<string>").alias("out")) for n, out in LEFT_OUT.items()))
    spread = hits.select("*", F.explode(scenarios).alias("s")).where(~F.array_contains("s.out", F.coalesce("family", F.lit("")))).select(*hits.columns, "s.scenario")
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    fits = lambda flag_col, kind: flag(flag_col) & F.col("asset").isNotNull() & F.coalesce(F.col("asset_class") == kind, F.lit(False))
    water, mine = fits("ground", "GROUNDWATER_POINT"), fits("mine", "MINE_QUARRY_FEATURE")
    # Things first, then zones: no zone's things are held as a set.
    n = lambda c: F.count_if(c)
    by_asset = spread.groupBy("zone_id", "scenario", "source", "asset").agg(
        F.max(water.cast("int")).alias("w"), F.max(mine.cast("int")).alias("m"), n(flag("ground") & ~water).alias("w_free"), n(flag("mine") & ~mine).alias("m_free"),
        n(flag("cave")).alias("cave"), n(F.col("family") == "INDUSTRIAL_REMEDIATION").alias("industrial"), n(F.col("family") == "UTILITIES_UNDERGROUND").alias("utility"), n(flag("history")).alias("history"),
    )
    sums = [F.sum(c).alias(c) for c in ("w_free", "m_free", "cave", "industrial", "utility", "history")]
    things = by_asset.groupBy("zone_id", "scenario", "asset").agg(F.max("w").alias("w"), F.max("m").alias("m"), *sums)
    counts = things.groupBy("zone_id", "scenario").agg((F.sum("w") + F.sum("w_free")).alias("groundwater"), (F.sum("m") + F.sum("m_free")).alias("mine"), *(F.sum(c).alias(c) for c in ("cave", "industrial", "utility", "history")))
    sources = by_asset.where("source is not null and source <> ''").select("zone_id", "scenario", "source").distinct().groupBy("zone_id", "scenario").agg(F.count(F.lit(1)).alias("n_sources"))
    every = zones.select("zone_id").distinct().select("zone_id", F.explode(F.array(*(F.lit(n) for n in LEFT_OUT))).alias("scenario"))
    z = every.join(counts, ["zone_id", "scenario"], "left").join(sources, ["zone_id", "scenario"], "left").fillna(0)
    part = lambda c, cap, weight, flat: F.least(F.lit(cap), F.col(c) * weight if flat else F.log1p(c) * weight)
    more = F.when(F.col("n_sources") >= 3, F.least(F.lit(1.0), (F.col("n_sources") - 2) * 0.15)).otherwise(0.0)
    score = F.round(F.least(F.lit(10.0), reduce(lambda a, b: a + b, (part(c, *x) for c, x in TERMS.items())) + more), 3)
    return z.select("zone_id", "scenario", "groundwater", "mine", score.alias("score"))


def ranks(scores: DataFrame) -> DataFrame:
    """scores (zone_id, scenario, score) with rank: 1 for the greatest score, the greatest id first among equal ones.

    Scores have three digits, so there are few of them; zones of one score are cut into blocks of ids, blocks are
    counted, and only within a block ids are sorted. So no task gets all zones of a score.
    """
    blocked = scores.withColumn("block", F.floor(F.col("zone_id") / BLOCK))
    counts = blocked.groupBy("scenario", "score", "block").agg(F.count(F.lit(1)).alias("n"))
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("scenario").orderBy(F.desc("score"), F.desc("block")).rowsBetween(Window.unboundedPreceding, -1))).select("scenario", "score", "block", F.coalesce("before", F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("scenario", "score", "block").orderBy(F.desc("zone_id")))
    return blocked.withColumn("own", own).join(before, ["scenario", "score", "block"]).select("zone_id", "scenario", "score", (F.col("before") + F.col("own")).alias("rank"))


def _of(scenario: str) -> Column:
    return F.max(F.when(F.col("scenario") == scenario, F.col("score")))


def hardened(hits: DataFrame, zones: DataFrame) -> DataFrame:
    """zones (zone_id, relevance, tier, score: as first rated) rated anew, with their sensitivity and the span of their ranks.

    A zone that was moderate is robust (semi-robust without direct evidence) where its score stays at 4 or more without
    utilities and history, and without industry too; at the threshold where not; provisional where it is no longer moderate.
    """
    scored = saved(scenario_scores(hits, zones))
    ranked = ranks(scored.select("zone_id", "scenario", "score"))
    g = ranked.groupBy("zone_id").agg(_of("BASE").alias("new_score"), F.min(F.when(F.col("scenario").isin("BASE", "NO_UTILITY_HISTORY", "NO_UTILITY_HISTORY_INDUSTRIAL"), F.col("score"))).alias("core"), F.min("rank").alias("rank_min"), F.max("rank").alias("rank_max"))
    base = scored.where("scenario = 'BASE'").select("zone_id", "groundwater", "mine")
    z = zones.select("zone_id", "relevance", "tier", F.col("score").alias("old")).join(g, "zone_id").join(base, "zone_id")
    new = band(F.col("new_score"), STEPS, "VERY_LOW")
    sensitivity = F.when(~F.coalesce(F.col("relevance") == "MODERATE", F.lit(False)), "BASELINE").when(~new.isin("MODERATE", "HIGH"), "PROVISIONAL").when(F.col("core") < 4, "THRESHOLD").when(F.col("tier") == "DIRECT", "ROBUST").otherwise("SEMI_ROBUST")
    return z.select("zone_id", "new_score", new.alias("new_relevance"), F.round(F.col("new_score") - F.coalesce("old", F.lit(0.0)), 3).alias("delta"), sensitivity.alias("sensitivity"), "groundwater", "mine", "rank_min", "rank_max", (F.col("rank_max") - F.col("rank_min")).alias("rank_span"))
