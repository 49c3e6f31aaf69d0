"""Which records of several sources are one thing: identity edges by rules, and the things they make.

Nearness alone never binds. A number that one source took from another binds directly; a place binds only with a
similar name. Records meet by number or by cells of their places, as a rule says, and names are compared for the pairs that
met, each pair of spellings once. The ratio of matching blocks is the well-known one of Python's difflib.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from ..functions import geo
from ..functions.texts import MARKED, PLAIN
from ..sources.tables import saved
from . import copies
from .graph import components
from .joins import place_pairs

# Words that name the sort of place and not the place.
GENERIC = ("well", "pozo", "spring", "quarry", "cantera", "pr", "puerto rico")


@dataclass(frozen=True)
class NumberRule:
    """Records of left hold, as number, the number of one record of right; of several the last by ord counts."""

    left: str
    right: str


@dataclass(frozen=True)
class RepeatRule:
    """Records of one source with the same number are one; the first by ord stands for them."""

    source: str


@dataclass(frozen=True)
class PlaceRule:
    """Records within `metres`. They bind where a pair of binds (most metres, least similarity) holds.

    Other pairs are candidates up to candidate_metres.
    """

    left: tuple[str, ...]
    right: tuple[str, ...]
    metres: float
    binds: tuple[tuple[float, float], ...]
    candidate_metres: float


def name_key(name: Column) -> Column:
    """A name in lower case, without marks, generic words and punctuation."""
    low = F.regexp_replace(F.translate(F.lower(F.coalesce(name, F.lit(""))), MARKED, PLAIN), r"[^\x00-\x7F]", "")
    return F.trim(F.regexp_replace(F.regexp_replace(low, rf"\b({'|'.join(GENERIC)})\b", " "), "[^a-z0-9]+", " "))


#: Cells (pairs by letters) that matching_ratio() compares at a time, and texts from which difflib passes over common letters.
CELLS, LONG = 1 << 16, 200


def _matching_ratio():
    """The function of matching_ratio(), whole, as it is sent to tasks."""

    def letters(texts: list[str], width: int, pad: int) -> np.ndarray:
        code = np.array(texts, f"U{width}").view(np.uint32).reshape(len(texts), width).astype(np.int32)
        return np.where(np.arange(width) < np.array([len(t) for t in texts])[:, None], code, np.int32(pad))

    def matches(left: list[str], right: list[str]) -> np.ndarray:
        """Letters of matching blocks of pairs of texts, all pairs a step: the longest block (the first of equals), then what is left and right of it."""
        na, nb = (np.array([len(t) for t in x]) for x in (left, right))
        a, b = letters(left, na.max(), -1), letters(right, nb.max(), -2)
        total = np.zeros(len(left), np.int64)
        pair, a0, a1, b0, b1 = np.arange(len(left)), np.zeros_like(na), na, np.zeros_like(nb), nb
        while len(pair):
            rows, deep, wide = np.arange(len(pair)), np.arange((a1 - a0).max()), np.arange((b1 - b0).max())
            ours = np.where(deep < (a1 - a0)[:, None], a[pair[:, None], np.minimum(a0[:, None] + deep, a.shape[1] - 1)], -1)
            theirs = np.where(wide < (b1 - b0)[:, None], b[pair[:, None], np.minimum(b0[:, None] + wide, b.shape[1] - 1)], -2)
            size, i, j = (np.zeros(len(pair), np.int64) for _ in range(3))
            run = np.zeros((len(pair), len(wide) + 1), np.int16)
            for k in deep:
                run[:, 1:] = (run[:, :-1] + np.int16(1)) * (theirs == ours[:, k, None])
                end = run.argmax(1)
                most = run[rows, end]
                more = most > size
                size[more], i[more], j[more] = most[more], k + 1 - most[more], end[more] - most[more]
            i, j = i + a0, j + b0
            np.add.at(total, pair, size)
            ends = [(a0, i, b0, j), (i + size, a1, j + size, b1)]
            some = [(size > 0) & (x0 < x1) & (y0 < y1) for x0, x1, y0, y1 in ends]
            pair, a0, a1, b0, b1 = (np.concatenate([c[m] for c, m in zip(cs, some, strict=True)]) for cs in zip(*((pair, *e) for e in ends), strict=True))
        return total

    def in_common(left: list[str], right: list[str]) -> np.ndarray:
        """Letters of both texts in any order, which blocks cannot pass."""
        a, b = letters(left, max(map(len, left)), -1), letters(right, max(map(len, right)), -2)
        return sum(np.minimum((a == c).sum(1), (b == c).sum(1)) for c in np.intersect1d(a, b)) + np.zeros(len(left), np.int64)

    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        from difflib import SequenceMatcher

        for left, right, *least in batches:
            a, b = left.tolist(), right.tolist()
            out = np.array([1.0 if x and x == y else 0.0 for x, y in zip(a, b, strict=True)])
            long = [k for k, (x, y) in enumerate(zip(a, b, strict=True)) if x and y and x != y and max(len(x), len(y)) >= LONG]
            for k in long:
                out[k] = SequenceMatcher(None, a[k], b[k]).ratio()
            short = sorted((k for k, (x, y) in enumerate(zip(a, b, strict=True)) if x and y and x != y and max(len(x), len(y)) < LONG), key=lambda k: len(b[k]))
            while short:
                n = max(1, CELLS // len(b[short[-1]]))
                some, short = short[-n:], short[:-n]
                x, y = [a[k] for k in some], [b[k] for k in some]
                total = np.array([len(s) + len(t) for s, t in zip(x, y, strict=True)])
                if least:
                    can = 2.0 * in_common(x, y) / total >= least[0].to_numpy()[some]
                    out[[k for k, c in zip(some, can, strict=True) if not c]] = np.nan
                    some, x, y, total = [k for k, c in zip(some, can, strict=True) if c], [t for t, c in zip(x, can, strict=True) if c], [t for t, c in zip(y, can, strict=True) if c], total[can]
                if some:
                    out[some] = 2.0 * matches(x, y) / total
            yield pd.Series(out, index=left.index)

    return run


#: 2 * M / T with M the letters of matching blocks and T those of both texts; 1 for equal texts, 0 beside an empty one.
matching_ratio = pandas_udf(_matching_ratio(), DoubleType())
#: The same with a third column, the least ratio of use: null where the letters in common cannot give it.
ratio_from = pandas_udf(_matching_ratio(), DoubleType())


#: Pairs of names that make a task worth while, and the most tasks.
COMPARED, MOST_TASKS = 1 << 14, 2048


def _ratios(pairs: DataFrame, a: str, b: str, least: Column) -> DataFrame:
    """a, b and similarity of each pair of names once, null where it cannot reach least. Comparing takes far longer than reading, so tasks are dealt by pairs and not by bytes."""
    n = min(MOST_TASKS, pairs.count() // COMPARED + 1)
    once = pairs.select(a, b, least.alias("least")).repartition(n, a, b).groupBy(a, b).agg(F.min("least").alias("least"))
    return once.select(a, b, ratio_from(a, b, "least").alias("similarity"))


def _by_number(records: DataFrame, rules: list) -> DataFrame | None:
    numbered = records.where("number is not null and trim(number) <> ''").withColumn("number", F.trim("number"))
    out = None
    for r in rules:
        if isinstance(r, NumberRule):
            last = numbered.where(F.col("source") == r.right).groupBy("number").agg(F.max_by("id", F.struct("ord", "id")).alias("other_id"))
            met = numbered.where(F.col("source") == r.left).join(last, "number").select("id", "other_id", F.lit("AUTHORITATIVE_ID").alias("relation"))
        else:
            own = numbered.where(F.col("source") == r.source)
            first = own.groupBy("number").agg(F.min_by("id", F.struct("ord", "id")).alias("first"))
            met = own.join(first, "number").where("id <> first").select(F.col("first").alias("id"), F.col("id").alias("other_id"), F.lit("DUPLICATE_SOURCE_ROW").alias("relation"))
        out = met if out is None else out.unionByName(met)
    return out


def _spots(records: DataFrame, names: tuple[str, ...], place: str, key: str) -> DataFrame:
    """id, place and name key of the records of some sources that have a place."""
    at = F.struct(F.col("lon").cast("double").alias("lon"), F.col("lat").cast("double").alias("lat"))
    return records.where(F.col("source").isin(*names) & F.col("lon").isNotNull() & F.col("lat").isNotNull()).select("id", F.struct(at.alias(place), F.col("name_key").alias(key)).alias(key))


def _spot_pairs(records: DataFrame, rules: list[PlaceRule], salts: int) -> DataFrame:
    """rule, a and b (place and name key each), distance_m, similarity and binding of the pairs that rules keep.

    Records with equal places and name keys have equal partners, so one of each is measured and compared.
    """
    met = None
    for k, r in enumerate(rules):
        left, right = _spots(records, r.left, "place", "a").select("a").distinct(), _spots(records, r.right, "other_place", "b").select("b").distinct()
        pairs = place_pairs(left.select("a.place.*"), right.select("b.other_place.*"), r.metres, salts)
        # The least similarity with which a pair is kept; null where none is enough.
        least = F.least(*(F.when(F.col("distance_m") <= most, ratio) for most, ratio in (*r.binds, (r.candidate_metres, 0.0))), F.lit(None))
        one = copies.spelled_pairs(pairs.withColumn("least", least).where("least is not null"), left.select("a", "a.place"), right.select("b", "b.other_place"), "place", "other_place").select(F.lit(k).alias("rule"), "a", "b", "distance_m", "least")
        met = one if met is None else met.unionByName(one)
    met = saved(met.select("*", F.col("a.a").alias("name"), F.col("b.b").alias("name2")))
    ratios = _ratios(met, "name", "name2", F.col("least"))
    bound, keep = F.lit(False), F.col("similarity") >= F.col("least")
    for k, r in enumerate(rules):
        ok = F.lit(False)
        for most, least in r.binds:
            ok = ok | ((F.col("distance_m") <= most) & (F.col("similarity") >= least))
        bound = F.when(F.col("rule") == k, ok).otherwise(bound)
    return saved(met.join(ratios, ["name", "name2"]).where(keep).select("rule", "a", "b", "distance_m", "similarity", bound.alias("binding")))


def _number_edges(records: DataFrame, rules: list) -> DataFrame | None:
    numbers = _by_number(records, rules)
    if numbers is None:
        return None
    a = records.select("id", F.col("name_key").alias("a"), "lon", "lat")
    b = records.select(F.col("id").alias("other_id"), F.col("name_key").alias("b"), F.col("lon").alias("lon2"), F.col("lat").alias("lat2"))
    # least() in the distance passes over nulls, so these have to be kept out.
    placed = F.col("lon").isNotNull() & F.col("lat").isNotNull() & F.col("lon2").isNotNull() & F.col("lat2").isNotNull()
    distance = F.when(placed, geo.haversine(F.col("lon"), F.col("lat"), F.col("lon2"), F.col("lat2")))
    full = saved(numbers.join(a, "id").join(b, "other_id").withColumn("distance_m", distance))
    # Rows of one source with one number are one whatever their names, which are not compared.
    repeated = F.col("relation") == "DUPLICATE_SOURCE_ROW"
    ratios = _ratios(full.where(~repeated), "a", "b", F.lit(0.0))
    compared = full.where(~repeated).join(ratios, ["a", "b"]).unionByName(full.where(repeated).withColumn("similarity", F.lit(1.0)))
    return compared.select("id", "other_id", "relation", F.lit(True).alias("binding"), F.lit("DIRECT").alias("confidence"), "distance_m", "similarity")


def _parted(records: DataFrame, rules: list) -> tuple[DataFrame, list, list]:
    if not rules:
        raise ValueError("no rules")
    places = [r for r in rules if isinstance(r, PlaceRule)]
    # Every rule reads the records, and names are long in folding.
    keyed = saved(records.select("id", "source", name_key(F.col("name")).alias("name_key"), "number", "lon", "lat", "ord"))
    return keyed, [r for r in rules if not isinstance(r, PlaceRule)], places


def identity_edges(records: DataFrame, rules: list, salts: int = 1) -> DataFrame:
    """id, other_id, relation, binding, confidence, distance_m and similarity for each pair that a rule joins.

    records have id (distinct), source, name, number, lon, lat and ord. Rows without a place meet by number only, and
    their distance is null. A pair that several rules join has a row for each. salts splits crowded cells. Pairs of
    places and names are judged once and spelled out for their records.
    """
    records, numbers, places = _parted(records, rules)
    out = _number_edges(records, numbers)
    judged = _spot_pairs(records, places, salts) if places else None
    for k, r in enumerate(places):
        right = _spots(records, r.right, "other_place", "b").withColumnRenamed("id", "other_id")
        near = copies.spelled_pairs(judged.where(F.col("rule") == k), _spots(records, r.left, "place", "a"), right, "a", "b").select(
            "id", "other_id", F.when(F.col("binding"), "GEOMETRY_NAME").otherwise("PROXIMITY_CANDIDATE").alias("relation"), "binding", F.when(F.col("binding"), "SUPPORTING").otherwise("CANDIDATE").alias("confidence"), "distance_m", "similarity"
        )
        out = near if out is None else out.unionByName(near)
    return out


def identity_members(records: DataFrame, rules: list, salts: int = 1) -> DataFrame:
    """id and canonical, as canonical_records() of all identity_edges() gives them, without spelling those out.

    Where a pair of places and names binds, all records of both are one. So each is linked to the least of its own, and
    those two to each other.
    """
    records, numbers, places = _parted(records, rules)
    by_number = _by_number(records, numbers)
    links = None if by_number is None else by_number.select(F.col("id").alias("u"), F.col("other_id").alias("v"))
    judged = _spot_pairs(records, places, salts).where("binding") if places else None
    for k, r in enumerate(places):
        left, right = _spots(records, r.left, "place", "a"), _spots(records, r.right, "other_place", "b")
        bound = judged.where(F.col("rule") == k).select("a", "b")
        first = lambda df, c, name: df.groupBy(c).agg(F.min("id").alias(name))
        across = bound.join(first(left, "a", "u"), "a").join(first(right, "b", "v"), "b").select("u", "v")
        own = [df.join(bound.select(c).distinct(), c).join(first(df, c, "v"), c).select(F.col("id").alias("u"), "v") for df, c in ((left, "a"), (right, "b"))]
        for df in (across, *own):
            links = df if links is None else links.unionByName(df)
    return _canonical(records, links)


def _canonical(records: DataFrame, links: DataFrame) -> DataFrame:
    return records.select("id").join(components(links).select(F.col("node").alias("id"), "root"), "id", "left").select("id", F.coalesce("root", "id").alias("canonical"))


def canonical_records(records: DataFrame, edges: DataFrame) -> DataFrame:
    """id and canonical, the least id that binding edges reach, for every record."""
    bound = edges.where("binding").select(F.col("id").alias("u"), F.col("other_id").alias("v"))
    return _canonical(records, bound)


def canonical_assets(records: DataFrame, edges: DataFrame, classes: dict[str, tuple[str, ...]], members: DataFrame | None = None) -> DataFrame:
    """canonical, asset_class, relation, n_members, n_sources and confidence of each thing.

    classes: names with the sources that make a thing of that class, the first that has one of them counts. relation is
    1:1 where no source has two members, N:1_SOURCE_DUPLICATE where there is one source only, N:1 where one source has
    several, N:N where more do; those last two are conflicts for a reviewer and stay as they are.
    """
    of = canonical_records(records, edges) if members is None else members
    by_source = of.join(records.select("id", "source"), "id").groupBy("canonical", "source").agg(F.count(F.lit(1)).alias("n"))
    kinds = [F.bool_or(F.col("source").isin(*names)).alias(f"is{k}") for k, names in enumerate(classes.values())]
    g = by_source.groupBy("canonical").agg(F.sum("n").alias("n_members"), F.count(F.lit(1)).alias("n_sources"), F.count_if(F.col("n") > 1).alias("several"), *kinds)
    direct = edges.where("binding and confidence = 'DIRECT'").select("id").distinct().join(of, "id").select("canonical").distinct().withColumn("direct", F.lit(True))
    relation = F.when((F.col("n_sources") == 1) & (F.col("n_members") > 1), "N:1_SOURCE_DUPLICATE").when(F.col("several") == 0, "1:1").when(F.col("several") == 1, "N:1").otherwise("N:N")
    asset = F.coalesce(*(F.when(F.col(f"is{k}"), name) for k, name in enumerate(classes)), F.lit("UNRESOLVED_TARGET"))
    confidence = F.when(F.col("direct"), "DIRECT").when(F.col("n_members") > 1, "SUPPORTING").otherwise("SOURCE_ONLY")
    return g.join(direct, "canonical", "left").select("canonical", asset.alias("asset_class"), relation.alias("relation"), "n_members", "n_sources", confidence.alias("confidence"))
