"""Alert rules over flights, and what is done with alerts afterwards.

A rule is a filter and a projection. All rules that need a flight alone are evaluated in one pass: each gives a struct
or null, and the array of them is exploded, so flights are read once and not once for each rule. The counts that
rules need (failed checks, flights of a callsign) are joined on beforehand as pre-aggregated tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Severities from the gravest, the window of repeated alerts, and the limits of the rules.
SEVERITIES = ["CRITICAL", "HIGH", "MEDIUM", "LOW", "INFO"]
REPEAT_HOURS = 24
LONG_MINUTES = 360
NIGHT_BEFORE, NIGHT_AFTER = 7, 19
LOW_CONFIDENCE = 0.75
NEAR_NM = 1.0


def severity_rank(c: Column) -> Column:
    """0 for the gravest; unknown names come last."""
    out = F.lit(len(SEVERITIES))
    for i, name in reversed(list(enumerate(SEVERITIES))):
        out = F.when(c == name, i).otherwise(out)
    return out


def evaluate(flights: DataFrame, failed: DataFrame, near: DataFrame, known: list[str], day_only: list[str], confidence: DataFrame | None = None) -> DataFrame:
    """All alerts of flights (flight_id, callsign, takeoff, minutes).

    failed: flight_id, n_failed. near: flight_id, n_restricted, min_nm (nearest critical site). confidence: callsign,
    mean_confidence. Every one of them has a row for a flight or callsign at most.
    """
    count = F.count(F.lit(1)).over(Window.partitionBy("callsign"))
    f = flights.withColumn("n_flights", count).join(failed, "flight_id", "left").join(near, "flight_id", "left")
    f = f.join(confidence, "callsign", "left") if confidence is not None else f.withColumn("mean_confidence", F.lit(None).cast("double"))
    name = F.coalesce(F.col("callsign"), F.lit(""))
    has = lambda names: F.exists(F.array(*(F.lit(x) for x in names)), lambda k: name.contains(k)) if names else F.lit(False)
    alert = lambda when, prefix, category, severity: F.when(
        when, F.struct(F.concat(F.lit(prefix + "_"), F.col("flight_id").cast("string")).alias("alert_id"), F.lit(category).alias("category"), F.lit(severity).alias("severity"))
    )
    night = ~F.hour("takeoff").between(NIGHT_BEFORE, NIGHT_AFTER)
    rules = [
        alert(F.coalesce("n_restricted", F.lit(0)) > 0, "RESTR", "RESTRICTED_AIRSPACE", "HIGH"),
        alert(~has(known), "UNKN", "UNKNOWN_AIRCRAFT", "MEDIUM"),
        alert(has(day_only) & night, "NIGHT", "NIGHT_OPERATION", "LOW"),
        alert(F.coalesce("minutes", F.lit(0)) > LONG_MINUTES, "EXTD", "EXTENDED_OPERATION", "MEDIUM"),
        alert(F.coalesce("min_nm", F.lit(99.0)) < NEAR_NM, "INFRA", "INFRASTRUCTURE_PROX", "MEDIUM"),
        alert(F.coalesce("n_failed", F.lit(0)) > 0, "PHYS", "TEMPORAL_ANOMALY", "LOW"),
        alert(F.col("n_flights") <= 1, "NEW", "NEW_AIRCRAFT", "INFO"),
        alert(F.col("mean_confidence") < LOW_CONFIDENCE, "CONF", "TEMPORAL_ANOMALY", "LOW"),
    ]
    return f.select("flight_id", "callsign", F.explode(F.array_compact(F.array(*rules))).alias("a")).select("flight_id", "callsign", "a.*")


def active(alerts: DataFrame, limit: int = 50) -> DataFrame:
    """The gravest and newest alerts that nobody has acknowledged or resolved."""
    return alerts.where(~F.col("acknowledged") & ~F.col("resolved")).orderBy(severity_rank(F.col("severity")), F.desc("ts"), "alert_id").limit(limit)


def without_repeats(alerts: DataFrame, within_hours: int = REPEAT_HOURS) -> DataFrame:
    """Alerts with no earlier one of the same key and category within the last hours."""
    w = Window.partitionBy("callsign", "category").orderBy("ts", "alert_id")
    before = F.lag("ts").over(w)
    return alerts.withColumn("before", before).where(F.col("before").isNull() | (F.col("ts") - F.col("before") > F.expr(f"interval {within_hours} hours"))).drop("before")


def stats(alerts: DataFrame) -> DataFrame:
    """kind, name and n: the total, counts by severity and by category, and how many were acknowledged or resolved.

    One pass by grouping sets.
    """
    g = alerts.groupingSets([[F.col("severity")], [F.col("category")], []], F.col("severity"), F.col("category")).agg(F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("n"), F.count_if("acknowledged").alias("n_acknowledged"), F.count_if("resolved").alias("n_resolved"))
    kind = F.when(F.col("gid") == 3, "total").when(F.col("gid") == 1, "severity").otherwise("category")
    name = F.when(F.col("gid") == 1, F.col("severity")).when(F.col("gid") == 2, F.col("category")).otherwise(F.lit(""))
    return g.select(kind.alias("kind"), name.alias("name"), "n", "n_acknowledged", "n_resolved")


def by(alerts: DataFrame, column: str, since: Column | None = None) -> DataFrame:
    """Alerts of each value of a column, from a time on."""
    some = alerts if since is None else alerts.where(F.col("ts") >= since)
    return some.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def top(alerts: DataFrame, column: str, limit: int, since: Column | None = None) -> DataFrame:
    """The values with most alerts; ties by value."""
    return by(alerts, column, since).orderBy(F.desc("n"), column).limit(limit)
