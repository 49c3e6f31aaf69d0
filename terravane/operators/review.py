"""What a reviewer sees: blockers of promotion, adjudicated features, scores of depressions, pairs of scenes and routes, counts by place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.texts import band
from . import evidence


def _any(condition: Column) -> Column:
    return F.coalesce(F.bool_or(condition), F.lit(False))


def permitted(features: DataFrame, assertions: DataFrame, cites: DataFrame, observations: DataFrame, sources: DataFrame, producer: str) -> DataFrame:
    """feature, status and blockers (texts) for each feature: the strongest status that its evidence allows.

    assertions: feature, dimension, effective, adjudication, adjudicator, source_ids; cites: feature, observation;
    observations: observation, source, located; sources: source, provenance. VERIFIED needs an opening seen directly, no
    contradiction, only observations that are held, one of them located, and for existence and opening an assertion
    accepted by someone other than the producer and sources whose bytes are registered. Short of that a feature with a
    source better than unregistered is a CANDIDATE, any other a PROVISIONAL_DISCOVERY. Features without assertions or
    observations get a row as well. A repeated observation or source counts once.
    """
    if not producer.strip():
        raise ValueError("the producer has to be named")
    # All that is said of a feature is a sum over rows of flags, so everything goes to its feature in one narrow shuffle. What
    # is looked up is hashed, as it is far less than what looks it up: sorting that would spill.
    held_sources = sources.dropDuplicates(["source"]).select("source", "provenance", F.lit(True).alias("held"))
    provenance = F.coalesce(F.col("provenance"), F.lit(""))
    backs = F.coalesce(F.col("held") & (provenance != "UNREGISTERED"), F.lit(False))
    lists = assertions.select("source_ids").distinct().select("source_ids", F.explode("source_ids").alias("source")).join(held_sources, "source", "left")
    lists = lists.groupBy("source_ids").agg(_any(backs).alias("backs"), F.collect_set(F.when(provenance != "REGISTERED", F.col("source").cast("string"))).alias("unsure"))
    known = observations.dropDuplicates(["observation"]).select("observation", F.col("source"), "located", F.lit(True).alias("o_held")).join(held_sources, "source", "left")
    known = known.select("observation", "o_held", "located", backs.alias("backs"))

    dims = ("EXISTENCE", "PHYSICAL_OPENING")
    is_of = {d: F.col("dimension") == d for d in dims}
    carrying = F.col("effective").isin("SUPPORTING", "DIRECT")
    independent = (F.col("adjudication") == "ACCEPTED") & (F.col("adjudicator") != "") & (F.trim("adjudicator") != producer.strip())
    told = {
        "backed": F.col("backs"),
        **{f"has_{d}": is_of[d] & carrying for d in dims},
        **{f"own_{d}": is_of[d] & carrying & independent for d in dims},
        **evidence.rung_flags(),
    }
    seen = {"backed": F.col("backs"), "lost": F.col("o_held").isNull(), "located": F.col("located")}
    bit = {name: 1 << i for i, name in enumerate(["asked", *dict.fromkeys([*told, *seen])])}
    flags = lambda of: sum((F.when(test, bit[name]).otherwise(0) for name, test in of.items()), F.lit(0)).alias("flags")
    has = lambda name: F.col("flags").bitwiseAND(bit[name]) != 0

    # Without a feature nothing is said of one.
    said = assertions.where("feature is not null").join(lists.hint("shuffle_hash"), "source_ids", "left")
    loose = [F.when(is_of[d] & carrying & (F.size("unsure") > 0), F.col("unsure")).alias(f"loose_{d}") for d in dims]
    rows = said.select("feature", flags(told), F.when(F.col("effective") == "CONTRADICTED", F.col("dimension")).alias("against"), *loose)
    looks = cites.where("feature is not null").join(known.hint("shuffle_hash"), "observation", "left").select("feature", flags(seen))
    rows = rows.unionByName(looks, True).unionByName(features.select("feature", F.lit(bit["asked"]).alias("flags")), True)
    text = lambda d: lambda source: F.concat(F.lit(f"{d} cites source "), source, F.lit(" whose exact bytes are not registered"))
    g = rows.repartition("feature").groupBy("feature").agg(
        F.bit_or("flags").alias("flags"), F.concat_ws(",", F.array_sort(F.collect_set("against"))).alias("contradicted"), *(F.array_sort(F.transform(F.array_distinct(F.flatten(F.collect_set(f"loose_{d}"))), text(d))).alias(f"loose_{d}") for d in dims)
    )
    j = g.where(has("asked")).select("feature", "contradicted", *(f"loose_{d}" for d in dims), *(has(name).alias(name) for name in bit), evidence.rung_of(has).alias("rung"))
    rung = F.col("rung")
    one = lambda c, text: F.when(F.coalesce(c, F.lit(False)), F.array(text)).otherwise(F.array().cast("array<string>"))
    name = F.element_at(F.array(*map(F.lit, fixed.RUNGS)), (rung + 1).cast("int"))
    found = [
        one(rung < 2, F.concat(F.lit("evidence reaches "), name, F.lit("; a verified access point needs a directly observed physical opening"))),
        one(F.col("contradicted") != "", F.concat(F.lit("contradicted dimensions: "), F.replace("contradicted", F.lit(","), F.lit(", ")))),
        one(F.col("lost"), F.lit("feature cites observations the registry does not hold")),
        one(~F.col("located"), F.lit("no observation carries source-backed coordinates")),
    ]
    for d in dims:
        found.append(one(F.col(f"has_{d}") & ~F.col(f"own_{d}"), F.lit(f"{d} has no assertion accepted by a reviewer independent of the producer")))
        found.append(F.col(f"loose_{d}"))
    out = j.select("feature", "backed", F.concat(*found).alias("blockers"))
    return out.select("feature", F.when(~F.col("backed"), "PROVISIONAL_DISCOVERY").when(F.size("blockers") == 0, "VERIFIED").otherwise("CANDIDATE").alias("status"), "blockers")


def box_state(x0: Column, y0: Column, x1: Column, y1: Column, area: Sequence[float]) -> Column:
    """How a box, or a point where both corners are one, lies to the box of an area (min x, min y, max x, max y)."""
    ax0, ay0, ax1, ay1 = (F.lit(float(v)) for v in area)
    point = (x0 == x1) & (y0 == y1)
    invalid = ~point & ((x0 >= x1) | (y0 >= y1))
    strictly = (x0 > ax0) & (x1 < ax1) & (y0 > ay0) & (y1 < ay1)
    closed = (x0 >= ax0) & (x1 <= ax1) & (y0 >= ay0) & (y1 <= ay1)
    inner = (x0 < ax1) & (x1 > ax0) & (y0 < ay1) & (y1 > ay0)
    meets = (x0 <= ax1) & (x1 >= ax0) & (y0 <= ay1) & (y1 >= ay0)
    return (
        F.when(x0.isNull() | y0.isNull() | x1.isNull() | y1.isNull(), "NULL_EMPTY")
        .when(invalid, "UNRESOLVED")
        .when((point & strictly) | (~point & closed), "FULLY_WITHIN")
        .when(inner & ~point, "PARTIAL")
        .when(meets, "TOUCH_ONLY")
        .otherwise("OUTSIDE")
    )


def adjudicated(records: DataFrame, area: Sequence[float]) -> DataFrame:
    """records (tier, bases, x0, y0, x1, y1) with state, evidence_tier, certification and distance to the area.

    A basis that only suggests an identity lowers supporting and direct evidence to a candidate; a feature without a
    usable geometry is unresolved. Null bases count as none; the distance is null where there is no geometry.
    """
    bases = F.transform(F.coalesce("bases", F.array().cast("array<string>")), F.lower)
    weak = F.arrays_overlap(bases, F.array(*map(F.lit, fixed.HEURISTIC_BASES))) & F.col("tier").isin("SUPPORTING", "DIRECT")
    state = box_state(*(F.col(c) for c in ("x0", "y0", "x1", "y1")), area)
    gap = lambda low, high, a, b: F.greatest(F.lit(0.0), F.lit(float(a)) - F.col(high), F.col(low) - F.lit(float(b)))
    dx, dy = gap("x0", "x1", area[0], area[2]), gap("y0", "y1", area[1], area[3])
    none = F.col("state").isin("NULL_EMPTY", "UNRESOLVED")
    out = records.withColumn("state", state).withColumn("evidence_tier", F.when(none, "UNRESOLVED").when(F.coalesce(weak, F.lit(False)), "CANDIDATE").otherwise(F.col("tier")))
    said = F.when(F.col("evidence_tier") == "CANDIDATE", "CANDIDATE_NOT_IDENTITY").when(F.col("evidence_tier") == "UNRESOLVED", "UNRESOLVED").otherwise("PROVISIONAL")
    return out.withColumns({"certification": said, "distance": F.when(F.col("state") != "NULL_EMPTY", F.sqrt(dx * dx + dy * dy))})


def shape_tier(flags: Column) -> Column:
    """How far shape alone may go under its flags."""
    weak = F.arrays_overlap(F.coalesce(flags, F.array().cast("array<string>")), F.array(*map(F.lit, fixed.WEAK_SHAPES)))
    return F.when(weak, "CANDIDATE").otherwise("SUPPORTING")


def depression_score(significance: Column, depth_to_diameter: Column, circularity: Column, wall_slope: Column, at_border: Column, flags: Column) -> Column:
    """Priority of a depression for review, 0 to 100. Unknown significance and wall count nothing; doubtful cells cut the score."""
    w = fixed.DEPRESSION_WEIGHTS
    share = lambda x, k: F.when(x.isNull(), 0.0).otherwise(F.least(x / w[k][0], F.lit(1.0))) * w[k][1]
    total = share(significance, "significance") + share(depth_to_diameter, "depth_to_diameter") + circularity * w["circularity"][1] + share(wall_slope, "wall_slope")
    total = total + F.when(at_border, 0.0).otherwise(fixed.DEPRESSION_INNER)
    has = lambda f: F.coalesce(F.array_contains(flags, f), F.lit(False))
    total = total * F.when(has("SEAM_OVERLAP"), 0.25).otherwise(1.0)
    total = total * F.when(has("MOSTLY_INTERPOLATED"), 0.25).when(has("PARTLY_INTERPOLATED"), 0.75).otherwise(1.0)
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(100.0), total)), 2)


def confidence_band(score: Column) -> Column:
    """The band of a confidence from 0 to 100."""
    return band(score, fixed.CONFIDENCE_BANDS, fixed.CONFIDENCE_LEAST)


def reconcile(left: Column, right: Column) -> Column:
    """UNRESOLVED, CONTRADICTION or REVIEW for two route designations; null fields make a side ineligible.

    Both are structs of classification, system, authority, source, route_type and route_number.
    """
    filled = lambda c: F.coalesce(F.trim(c) != "", F.lit(False))
    fit = lambda s: F.coalesce((s["classification"] == "CANDIDATE") & (s["system"] == "USPS"), F.lit(False)) & filled(s["authority"]) & filled(s["source"])
    same = (left["authority"] == right["authority"]) & left["route_type"].eqNullSafe(right["route_type"]) & left["route_number"].eqNullSafe(right["route_number"])
    return F.when(~(fit(left) & fit(right)), "UNRESOLVED").when(same, "REVIEW").otherwise("CONTRADICTION")


def density(features: DataFrame, places: DataFrame) -> DataFrame:
    """key, matched and n: features (name) counted by the geoid of the place (name, geoid) with exactly that name.

    Names without a place are counted under the name itself, null and empty ones under __NULL__. Features are counted
    by name before the join, so a name that most rows share is one row there. Of repeated names of places the least
    geoid counts.
    """
    by_name = features.groupBy(F.nullif(F.col("name"), F.lit("")).alias("name")).agg(F.count(F.lit(1)).alias("n"))
    own = places.groupBy("name").agg(F.min("geoid").alias("geoid"))
    met = by_name.join(own, "name", "left")
    return met.groupBy(F.coalesce("geoid", "name", F.lit("__NULL__")).alias("key"), F.col("geoid").isNotNull().alias("matched")).agg(F.sum("n").alias("n"))


def density_state(counted: DataFrame) -> DataFrame:
    """total, matched, unmatched and state of what density() returns; no rows at all pass."""
    n = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("long")
    g = counted.agg(n(F.lit(True)).alias("total"), n(F.col("matched")).alias("matched"), n(~F.col("matched")).alias("unmatched"))
    return g.withColumn("state", F.when((F.col("total") > 0) & (F.col("matched") == 0), "UNRESOLVED").when(F.col("unmatched") > 0, "CANDIDATE_NOT_IDENTITY").otherwise("PASS"))


def compared_keys(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row of counts of the distinct keys (column key) of two sides: in both, in one only, in any. Null is no key."""
    sides = left.select("key", F.lit(1).alias("side")).union(right.select("key", F.lit(2).alias("side"))).where("key is not null")
    each = sides.groupBy("key").agg(F.expr("bit_or(side)").alias("sides"))
    return each.agg(F.count_if(F.col("sides") == 3).alias("both"), F.count_if(F.col("sides") == 1).alias("left_only"), F.count_if(F.col("sides") == 2).alias("right_only"), F.count(F.lit(1)).alias("any"), F.count_if(F.col("sides") < 3).alias("one_only"))


def promotable(edges: DataFrame) -> DataFrame:
    """edges whose kinds (an array) hold one that proves identity."""
    return edges.where(F.arrays_overlap("kinds", F.array(*map(F.lit, fixed.IDENTITY_EVIDENCE))))


def covered_share(chip: Sequence[Column], before: Sequence[Column], after: Sequence[Column]) -> Column:
    """Share of a chip's box that both scenes' boxes cover (min x, min y, max x, max y each); 0 for a chip without area, null where a corner is unknown."""
    low = [F.greatest(a, b, c) for a, b, c in zip(chip[:2], before[:2], after[:2], strict=True)]
    high = [F.least(a, b, c) for a, b, c in zip(chip[2:], before[2:], after[2:], strict=True)]
    side = lambda a, b: F.greatest(F.lit(0.0), b - a)
    whole = side(chip[0], chip[2]) * side(chip[1], chip[3])
    unknown = F.lit(False)
    for c in (*chip, *before, *after):
        unknown = unknown | c.isNull()
    return F.when(unknown, None).when(whole <= 0, 0.0).otherwise(F.least(F.lit(1.0), side(low[0], high[0]) * side(low[1], high[1]) / whole))


def scale_ratio(before: Column, after: Column) -> Column:
    """Finer through coarser resolution; a half where one is unknown or zero."""
    known = F.coalesce((before != 0) & (after != 0), F.lit(False))
    return F.when(known, F.least(before, after) / F.greatest(before, after)).otherwise(0.5)


def at_resolution(signals: Column, resolution: Column) -> Column:
    """The signals (a map) that images of this resolution can show; an unknown resolution is coarse."""
    fine = F.coalesce(resolution <= fixed.COARSE_ABOVE_M, F.lit(False))
    return F.map_filter(signals, lambda k, v: fine | k.isin(fixed.COARSE_CHANGES))


def field_errors(lat: Column, lon: Column, kind: Column) -> Column:
    """What a candidate lacks of what it must have, as texts."""
    none = lambda c, name: F.when(c.isNull(), F.lit(f"None value for: {name}"))
    return F.array_compact(F.array(none(lat, "_lat"), none(lon, "_lon"), F.when(kind.isNull(), F.lit("Missing field: _candidate_type"))))


def inherited_confidence(kind: Column, overall: Column, alignment: Column, flights: Column, score: Column) -> Column:
    """The confidence that a candidate brings along, from the field that its kind has; 0 where that is missing."""
    brought = F.when(kind == "poi", overall).when(kind == "ilap", alignment).when(kind == "corridor", F.least(F.lit(1.0), F.coalesce(flights, F.lit(0)) / 5.0)).when(kind == "aasb_edge", score)
    return F.coalesce(brought, F.lit(0.0))


def run_deltas(first: DataFrame, second: DataFrame) -> DataFrame:
    """metric and delta (second minus first) of two reports (metric, value); null where one has no value. Metrics are unique in a report."""
    a, b = first.select("metric", F.col("value").alias("a")), second.select("metric", F.col("value").alias("b"))
    return a.join(b, "metric", "full").select("metric", F.round(F.col("b") - F.col("a"), 6).alias("delta"))


def cell_accounting(cells: DataFrame) -> DataFrame:
    """One row of counts of cells (value, interpolated): all, valid, without data, interpolated, measured.

    A null or NaN value is no data. Where no cell tells whether it is interpolated, the last two are null.
    """
    valid = F.col("value").isNotNull() & ~F.isnan("value")
    told = F.count("interpolated") > 0
    filled = F.count_if(valid & F.coalesce("interpolated", F.lit(False)))
    n = F.count_if(valid)
    return cells.agg(F.count(F.lit(1)).alias("total"), n.alias("valid"), (F.count(F.lit(1)) - n).alias("no_data"), F.when(told, filled).alias("interpolated"), F.when(told, n - filled).alias("measured"))


def first_met(domains: Column, conditions: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """The name of the first condition whose required domains are all among domains; null if none is.

    Null domains are none; a condition that requires nothing is never met.
    """
    have = F.coalesce(domains, F.array().cast("array<string>"))
    met = [F.when(F.size(F.array_except(F.array(*map(F.lit, need)).cast("array<string>"), have)) == 0, F.lit(name)) for name, need in conditions if need]
    return F.coalesce(*met, F.lit(None).cast("string"))
