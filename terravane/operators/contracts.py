"""Contract records: scores, fusion with candidates, profiles, differences between runs and financial checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.texts import band
from ..sources.tables import saved
from .joins import ranked_fallback

# Tier limits and weights of the score.
TIERS = [(0.75, "T1"), (0.55, "T2"), (0.35, "T3")]
WEIGHTS = {"amount": 0.25, "convergence": 0.30, "density": 0.25, "pulse": 0.20}


def tier(score: Column) -> Column:
    return band(score, TIERS, "T4")


def score(records: DataFrame, now: str) -> DataFrame:
    """Four components, score and tier for records (record_id, entity, area, amount, date).

    The three global figures (records of an entity, sum of an area, greatest amount) are pre-aggregated; the two
    maxima come back as one row, so no window spans the whole table.
    """
    entity = records.where(F.col("entity").isNotNull()).groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    area = records.where(F.col("area").isNotNull()).groupBy("area").agg(F.sum(F.col("amount").cast("decimal(28,2)")).cast("double").alias("area_total"))
    most = records.agg(F.max("amount").alias("most")).join(area.agg(F.max("area_total").alias("most_area")))
    r = records.join(entity, "entity", "left").join(area, "area", "left").join(F.broadcast(most))  # one row
    amount = F.when((F.col("amount") <= 0) | (F.col("most") <= 0) | F.col("amount").isNull(), F.lit(0.0)).otherwise(F.least(F.lit(1.0), F.log1p("amount") / F.log1p("most")))
    together = F.when(F.col("n_entity").isNull(), F.lit(0.0)).when(F.col("n_entity") <= 1, F.lit(0.35)).when(F.col("n_entity") == 2, F.lit(0.70)).otherwise(F.lit(1.0))
    dense = F.when(F.col("area_total").isNull() | (F.col("most_area") <= 0), F.lit(0.0)).otherwise(F.least(F.lit(1.0), F.col("area_total") / F.col("most_area")))
    age = F.greatest(F.lit(0), F.datediff(F.lit(now).cast("date"), F.col("date")))
    pulse = F.when(F.col("date").isNull(), F.lit(0.0)).when(age <= 365, F.lit(1.0)).when(age <= 730, F.lit(0.55)).otherwise(F.lit(0.20))
    r = r.withColumns({"amount_weight": amount, "convergence": together, "density": dense, "pulse": pulse})
    total = WEIGHTS["amount"] * F.col("amount_weight") + WEIGHTS["convergence"] * F.col("convergence") + WEIGHTS["density"] * F.col("density") + WEIGHTS["pulse"] * F.col("pulse")
    r = r.withColumn("score", F.round(total, 4))
    return r.select("record_id", "entity", "area", "amount", F.round("amount_weight", 6).alias("amount_weight"), "convergence", F.round("density", 6).alias("density"), "pulse", "score", tier(F.col("score")).alias("tier"))


def summary(scored: DataFrame) -> DataFrame:
    """kind, name, n and amount by tier and by area, in one pass of grouping sets."""
    g = scored.groupingSets([[F.col("tier")], [F.col("area")]], F.col("tier"), F.col("area")).agg(F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("n"), F.sum(F.col("amount").cast("decimal(28,2)")).cast("double").alias("amount"))
    return g.select(F.when(F.col("gid") == 1, "tier").otherwise("area").alias("kind"), F.when(F.col("gid") == 1, F.col("tier")).otherwise(F.coalesce(F.col("area").cast("string"), F.lit("UNKNOWN"))).alias("name"), "n", "amount")


def fuse(candidates: DataFrame, contracts: DataFrame, max_deg: float = 0.08) -> DataFrame:
    """Every candidate (with base, a score) and a quarter of its best contract's strength on top, at most 1."""
    best = ranked_fallback(candidates, contracts, max_deg)
    boost = 0.25 * F.coalesce("strength", F.lit(0.0))
    fused = F.round(F.least(F.lit(1.0), F.col("base") + boost), 4)
    return candidates.select("id", "base").join(best, "id", "left").select("id", "base", "record_id", "relation", F.round(boost, 4).alias("boost"), fused.alias("fused"), tier(fused).alias("fused_tier"))


def profile(records: DataFrame, by: list[str], amount: str = "amount") -> DataFrame:
    """Count, sum, exact quantiles and maximum of the amounts that are not zero.

    Distinct amounts are counted and dealt to ranges of groups and amounts. How many lie before a range is known from its
    neighbours' sums, so the amounts at the quantiles' positions are found without any task that holds a group's values.
    """
    some = records.where((F.col(amount) != 0) & F.col(amount).isNotNull())
    values = some.groupBy(F.struct(*by).alias("g"), F.col(amount).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    values = saved(values.repartitionByRange("g", "v").withColumn("part", F.spark_partition_id()))
    sums = values.groupBy("g", "part").agg(F.sum("c").alias("c"))
    all_of = Window.partitionBy("g")
    ahead = sums.select("g", "part", F.sum("c").over(all_of).alias("n"), (F.sum("c").over(all_of.orderBy("part")) - F.col("c")).alias("ahead"))
    last = F.col("ahead") + F.sum("c").over(Window.partitionBy("g", "part").orderBy("v"))
    placed = values.join(ahead, ["g", "part"]).withColumn("last", last)
    at = {name: (F.col("n") - 1) * x for name, x in (("p50", 0.5), ("p90", 0.9), ("p95", 0.95), ("p99", 0.99))}
    holds = lambda k: F.max(F.when((k < F.col("last")) & (k >= F.col("last") - F.col("c")), F.col("v").cast("double")))
    found = placed.groupBy("g", "n").agg(
        F.sum(F.col("v").cast("decimal(28,4)") * F.col("c")).cast("double").alias("total"), F.max("v").alias("most"),
        *(holds(f(p)).alias(f"{k}_{x}") for k, p in at.items() for f, x in ((F.floor, "low"), (F.ceil, "high"))),
    )
    low, high = (lambda k: F.col(f"{k}_low")), (lambda k: F.col(f"{k}_high"))
    q = lambda k: F.when(F.floor(at[k]) == at[k], low(k)).otherwise((F.ceil(at[k]) - at[k]) * low(k) + (at[k] - F.floor(at[k])) * high(k))
    return found.select(*(F.col(f"g.{c}").alias(c) for c in by), "n", "total", *(q(k).alias(k) for k in at), "most")


def difference(new: DataFrame, old: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """key and state of every row of two runs: NEW, WITHDRAWN, REVISED or UNCHANGED, by hashes of the columns."""
    side = lambda d, name: d.select(key, F.xxhash64(*columns).alias(name))
    both = side(new, "h_new").join(side(old, "h_old"), key, "full_outer")
    state = F.when(F.col("h_old").isNull(), "NEW").when(F.col("h_new").isNull(), "WITHDRAWN").when(F.col("h_new") == F.col("h_old"), "UNCHANGED").otherwise("REVISED")
    return both.select(key, state.alias("state"))


def epochs(a: DataFrame, b: DataFrame, key: str = "id", score_col: str = "score", band_width: float = 0.05) -> DataFrame:
    """Both scores of each key, a missing one as 0, their difference and its trend."""
    both = a.select(key, F.col(score_col).alias("score_a")).join(b.select(key, F.col(score_col).alias("score_b")), key, "full_outer")
    both = both.select(key, F.coalesce("score_a", F.lit(0.0)).alias("score_a"), F.coalesce("score_b", F.lit(0.0)).alias("score_b"))
    delta = F.round(F.col("score_b") - F.col("score_a"), 4)
    trend = F.when(delta > band_width, "increasing").when(delta < -band_width, "decreasing").otherwise("stable")
    return both.select("*", delta.alias("delta"), trend.alias("trend"))


def financial_errors(rows: DataFrame) -> DataFrame:
    """id and errors of rows (id, amount, currency, date) that break a rule; several errors stay in order."""
    from ..functions.texts import reasons

    errors = reasons(
        (F.col("amount").isNull(), "amount missing"),
        (F.col("amount") < 0, "amount negative"),
        (F.col("currency").isNull() | ~F.col("currency").rlike("^[A-Z]{3}$"), "currency invalid"),
        (F.col("date").isNull(), "date missing"),
    )
    return rows.select("id", errors.alias("errors")).where(F.size("errors") > 0)
