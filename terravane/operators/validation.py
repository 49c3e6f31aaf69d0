"""Records held against a schema, and the queue of what a reviewer has to see.

A schema is a list of rules; every rule is an expression, so a batch is read once and nothing is shuffled before the
queue, which is keyed by (schema, record, field, kind of error).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kinds of errors and the hint for each.
HINTS = {
    "required": "add the missing required field",
    "type": "correct the value type",
    "enum": "use an allowed enum value",
    "format": "fix the value format",
    "pattern": "match the required pattern",
    "minimum": "increase the value to meet the minimum",
    "maximum": "decrease the value to meet the maximum",
    "minLength": "provide a longer value",
    "maxLength": "shorten the value",
    "null_field": "field is required — supply a non-null value (T2-19)",
    "invalid_geometry": "fix the geometry — self-intersecting or malformed (T2-18)",
}
KEY = ["schema_name", "record_id", "field", "error_type"]


@dataclass(frozen=True)
class Rule:
    """field has to be there (null_field), or, if it is, fit: enum, pattern, minimum, maximum, minLength, maxLength."""

    field: str
    kind: str
    value: object = None

    def broken(self) -> Column:
        c, v = F.col(self.field), self.value
        match self.kind:
            case "null_field":
                return c.isNull()
            case "enum":
                test = c.isin(*v)
            case "pattern":
                test = c.rlike(v)
            case "minimum":
                test = c >= v
            case "maximum":
                test = c <= v
            case "minLength":
                test = F.char_length(c) >= v
            case "maxLength":
                test = F.char_length(c) <= v
            case _:
                raise ValueError(f"unknown kind of rule: {self.kind}")
        return ~F.coalesce(test, F.lit(True))


def _broken(rules: list[Rule]) -> Column:
    each = (F.when(r.broken(), F.struct(F.lit(r.field).alias("field"), F.lit(r.kind).alias("error_type"), F.lit(HINTS[r.kind]).alias("suggested_fix"))) for r in rules)
    return F.array_compact(F.array(*each))


def split(records: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """The valid records, and the others with what is wrong in a column `errors` (field, error_type, suggested_fix)."""
    judged = records.withColumn("errors", _broken(rules))
    return judged.where(F.size("errors") == 0).drop("errors"), judged.where(F.size("errors") > 0)


def record_id(columns: list[str]) -> Column:
    """The first of some columns that is not null or empty, as text; empty if there is none."""
    return F.coalesce(*(F.nullif(F.col(c).cast("string"), F.lit("")) for c in columns), F.lit(""))


def queue_rows(invalid: DataFrame, schema_name: str, ids: list[str], routed_at: Column) -> DataFrame:
    """A row for each invalid record and each of its errors."""
    body = F.to_json(F.struct(*(c for c in invalid.columns if c != "errors")))
    return invalid.select(routed_at.alias("routed_at"), record_id(ids).alias("record_id"), F.lit(schema_name).alias("schema_name"), body.alias("record_json"), F.inline("errors"))


def merged(queue: DataFrame, new: DataFrame, now: Column, hours: float = 24.0) -> DataFrame:
    """The queue and what is new in it: one row a key, and none whose key was routed within the last hours.

    Old rows stay as they are. Of new rows of one key the first by time, then by record, stays. Rows of the queue with
    a null in the key hide nothing.
    """
    recent = queue.where(F.col("routed_at") >= now - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(hours * 3600))).select(*KEY).distinct()
    rest = [c for c in new.columns if c not in KEY]
    first = F.min(F.struct("routed_at", *(c for c in rest if c != "routed_at"))).alias("m")
    once = new.groupBy(*KEY).agg(first).select(*KEY, "m.*")
    return queue.unionByName(once.join(recent, KEY, "left_anti").select(*queue.columns))
