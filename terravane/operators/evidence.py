"""What evidence may claim: tiers of observed signals, decisions on candidates, lineage of sources, worth of assertions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..sources.tables import saved


def signal_tier(signals: Column) -> Column:
    """The tier that a set of signals may support; repeats and order don't matter, null counts as the empty set.

    An exact combination has its own tier. Any other falls back to the strongest single rule it meets and never above.
    """
    have = F.array_sort(F.array_distinct(F.coalesce(signals, F.array().cast("array<string>"))))
    said = F.concat_ws("+", have)
    exact = F.coalesce(*(F.when(said == "+".join(sorted(s)), t) for s, t in fixed.SIGNAL_SETS))
    weak = F.coalesce(*(F.when(F.array_contains(have, s), t) for s, t in fixed.SIGNAL_FALLBACK), F.lit(fixed.SIGNAL_WEAKEST))
    return F.coalesce(exact, weak)


def decide(decisions: DataFrame) -> DataFrame:
    """The events of candidates under ordered decisions (uid, ord, decision, signals), each with the state around it.

    A candidate starts as candidate. promote, downgrade, confirm and reject lead to supported_candidate, candidate,
    confirmed and rejected; hold keeps the state. After confirmed or rejected only hold is legal, and confirm needs
    the field signal. An illegal or unknown decision changes nothing and has legal = false with its reason.
    Since only the first legal terminal decision can end a history, windows say all of it and no loop is needed.
    """
    from pyspark.sql import Window

    order = Window.partitionBy("uid").orderBy("ord", "decision")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    d = F.col("decision")
    has_field = F.coalesce(F.array_contains("signals", fixed.FIELD_SIGNAL), F.lit(False))
    target = F.coalesce(*(F.when(d == k, v) for k, v in fixed.DECISIONS.items()))
    known = target.isNotNull() | (d == "hold")
    possible = F.coalesce(known, F.lit(False)) & ((d != "confirm") | has_field)
    # A decision that is possible in itself fails only after a terminal one; the first of those always succeeds.
    ends = possible & d.isin("confirm", "reject")
    closed = F.coalesce(F.max(F.when(ends, 1)).over(before), F.lit(0)) == 1
    step = decisions.withColumns({"_possible": possible, "_closed": closed, "_target": target, "_known": F.coalesce(known, F.lit(False))})
    legal = F.col("_possible") & (~F.col("_closed") | (d == "hold"))
    step = step.withColumn("legal", legal)
    moved = F.when(F.col("legal"), F.col("_target"))
    prev = F.coalesce(F.last(moved, ignorenulls=True).over(before), F.lit("candidate"))
    why = F.when(F.col("legal"), None).when(~F.col("_known"), "unknown").when(F.col("_closed") & (d != "hold"), "terminal").otherwise("no field signal")
    out = step.withColumn("previous", prev)
    return out.select("uid", "ord", "decision", "previous", F.when(F.col("legal"), F.coalesce("_target", "previous")).otherwise(F.col("previous")).alias("status"), "legal", why.alias("reason"))


def lineage_roots(sources: DataFrame, parents: DataFrame, most_rounds: int = 1_000) -> DataFrame:
    """source and root: the independent roots behind each source of sources (source, root), with parents (source, parent).

    A source with parents has the roots of those and not its own; one without has its trimmed root, if any. Unknown
    parents add nothing, cycles end. Roots travel from the ends down to all that derive from them, a link a round, and
    what a source knows already goes no further: no more is held than the answer, however many ancestors a source has.
    """
    known = sources.select("source", F.nullif(F.trim("root"), F.lit("")).alias("root")).dropDuplicates(["source"])
    links = saved(parents.select("source", "parent").where("parent is not null").distinct().join(known.select("source"), "source", "left_semi"))
    seen = front = saved(known.join(links, "source", "left_anti").where("root is not null").select("source", "root"))
    for k in range(most_rounds):
        # Merged by sorting: small fronts would all be broadcast, round by round, through the driver.
        on = front.select(F.col("source").alias("parent"), "root").hint("merge")
        front = saved(links.join(on, "parent").select("source", "root").distinct().join(seen.hint("merge"), ["source", "root"], "left_anti"))
        if front.isEmpty():
            return seen
        # Fronts are saved already, so their union is only a list of files; now and then it becomes one again.
        seen = seen.unionByName(front)
        seen = saved(seen) if k % 20 == 19 else seen
    raise RuntimeError("the lineage has not come to rest")


def effective_tiers(assertions: DataFrame, sources: DataFrame) -> DataFrame:
    """assertions with effective, the tier they are worth: never above what was asserted.

    assertions: assertion, tier, dimension, claim, bases and source_ids (arrays); sources: source, provenance, direct.
    Tiers are ordered as fixed.TIERS says; unresolved and contradicted stay. A ceiling of candidate lies on assertions
    without a basis, with a discovery-only basis, with shape-only bases outside existence and morphology, with a
    speculative claim, or without a source better than unregistered; one of supporting on inferences and where no source
    measures directly. Citing a source that isn't held is citing none.
    """
    # What the sources are worth depends on their list alone, and far fewer lists than assertions are about.
    cited = assertions.select("source_ids").distinct().select("source_ids", F.explode("source_ids").alias("source")).join(sources.dropDuplicates(["source"]).withColumn("held", F.lit(True)), "source", "left")
    sums = cited.groupBy("source_ids").agg(
        F.bool_and(F.coalesce("held", F.lit(False))).alias("all_held"),
        F.bool_or(F.coalesce("held", F.lit(False)) & (F.coalesce("provenance", F.lit("")) != "UNREGISTERED")).alias("registered"),
        F.bool_or(F.coalesce("direct", F.lit(False))).alias("measured"),
    )
    # Hashed, since sorting all assertions for it would spill.
    j = assertions.join(sums.hint("shuffle_hash"), "source_ids", "left")
    ok = F.coalesce("all_held", F.lit(False))
    bases = F.transform(F.coalesce("bases", F.array().cast("array<string>")), lambda b: F.lower(F.trim(b)))
    lit = lambda xs: F.array(*(F.lit(x) for x in xs))
    shape_only = (F.size(bases) > 0) & (F.size(F.array_except(bases, lit(fixed.SHAPE_BASES))) == 0) & ~F.col("dimension").isin("EXISTENCE", "MORPHOLOGY")
    low = (F.size(bases) == 0) | F.arrays_overlap(bases, lit(fixed.DISCOVERY_BASES)) | shape_only | F.col("claim").isin("HYPOTHESIS", "ASSUMPTION", "UNKNOWN") | ~(ok & F.coalesce("registered", F.lit(False)))
    middle = (F.col("claim") == "INFERENCE") | ~(ok & F.coalesce("measured", F.lit(False)))
    rank = lambda c: F.array_position(lit(fixed.TIERS), c)
    cap = F.when(low, F.lit("CANDIDATE")).when(middle, F.lit("SUPPORTING")).otherwise(F.lit("DIRECT"))
    worth = F.when(F.col("tier").isin("UNRESOLVED", "CONTRADICTED") | (rank(F.col("tier")) <= rank(cap)), F.col("tier")).otherwise(cap)
    return j.withColumn("effective", worth).drop("all_held", "registered", "measured")


_RUNGS = (("EXISTENCE", ("SUPPORTING", "DIRECT")), ("PHYSICAL_OPENING", ("DIRECT",)), ("ACCESSIBILITY", ("DIRECT",)), ("CONNECTIVITY", ("DIRECT",)))


def rung_flags() -> dict[str, Column]:
    """What a row of (dimension, effective) adds to its feature's rung; any row may set a flag."""
    of = lambda d, tiers: (F.col("dimension") == d) & F.col("effective").isin(*tiers)
    return {f"met_{d}": of(d, tiers) for d, tiers in _RUNGS} | {f"against_{d}": of(d, ("CONTRADICTED",)) for d, _ in _RUNGS}


def rung_of(has: Callable[[str], Column]) -> Column:
    """The rung of a feature from its flags: a contradiction is above all tiers, and each rung needs the one below."""
    rung = F.lit(len(_RUNGS))
    for i, (d, _) in reversed(list(enumerate(_RUNGS))):
        rung = F.when(~has(f"met_{d}") | has(f"against_{d}"), i).otherwise(rung)
    return rung.cast("long")


def rungs(worth: DataFrame) -> DataFrame:
    """For each feature of worth (feature, dimension, effective): rung, 0 to 4, and its contradicted dimensions, sorted.

    A dimension has its greatest tier, a contradiction before all. The rungs are existence supported, then opening,
    accessibility and connectivity seen directly; each needs the one below.
    """
    sums = (F.coalesce(F.bool_or(test), F.lit(False)).alias(name) for name, test in rung_flags().items())
    against = F.collect_set(F.when(F.col("effective") == "CONTRADICTED", F.col("dimension")))
    g = worth.groupBy("feature").agg(*sums, F.concat_ws(",", F.array_sort(against)).alias("contradicted"))
    return g.select("feature", rung_of(F.col).alias("rung"), "contradicted")
