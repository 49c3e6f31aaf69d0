"""Near-duplicates by SimHash fingerprints, compared exactly in tiles.

A fingerprint has 64 bits, by majority over the XXH64 hashes of the four-word shingles. Two texts are linked where
their fingerprints differ in at most `radius` bits. Equal fingerprints are first put together. Distinct ones are laid
into tiles by the population counts of their upper and lower 32 bits; fingerprints that differ in r bits differ by at
most r in these two counts together, so a tile meets only the tiles that near. Within a pair of tiles numpy compares
everything: exclusive or, then bit counts. A pair of tiles returns a spanning forest of what it has linked and not
every pair, so that a group of n near copies gives about n edges; components are the same.

Population counts give at most 33 * 33 tile keys, whatever the input, and a key with many fingerprints is cut into
tiles of about TILE, so no task meets more than two tiles at a time.

Defined results: a null or empty text has fingerprint zero, linked like any other; rows with equal ids keep a row
each; a class without any id has a null component_id; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, saved
from .components import components

TILE = 32_768
SHINGLE = 4
SEED = 42
#: Salts for the join of fingerprints with their component, one of which may hold most of them.
SALTS = 16


def fingerprint(text: str | None) -> int:
    """The fingerprint of one text, unsigned."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    k = min(SHINGLE, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    first, last = starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()
    votes = np.zeros(64, np.int64)
    for at in range(0, len(first), 65_536):
        some = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(first[at : at + 65_536], last[at : at + 65_536], strict=True)]
        h = np.array(some, np.uint64)
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * votes > len(first)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        *rest, texts = b.columns
        got = np.fromiter((fingerprint(x.as_py()) for x in texts), np.uint64, b.num_rows)
        yield pa.RecordBatch.from_arrays([*rest, pa.array(got.view(np.int64))], [*b.schema.names[:-1], "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp (the fingerprint's bits as a signed long) for each row."""
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return ids.mapInArrow(_fingerprints, "doc_id long, fp long")


def _forest(a: np.ndarray, b: np.ndarray, same: bool, radius: int) -> tuple[list[int], list[int]]:
    """Edges that connect what is within the radius, between the tiles a and b or inside one."""
    nodes = a if same else np.concatenate([a, b])
    shift = 0 if same else len(a)
    label = np.arange(len(nodes))
    left: list[int] = []
    right: list[int] = []
    rows = max(1, (1 << 20) // max(1, len(b)))
    for at in range(0, len(a), rows):
        hit = np.bitwise_count(a[at : at + rows, None] ^ b[None, :]) <= radius
        if same:
            hit[np.arange(hit.shape[0]), np.arange(at, at + hit.shape[0])] = False
        for i in np.flatnonzero(hit.any(axis=1)):
            near = np.flatnonzero(hit[i]) + shift
            roots = np.unique(np.append(label[near], label[at + i]))
            for r in roots[1:]:
                left.append(int(nodes[roots[0]]))
                right.append(int(nodes[r]))
            if len(roots) > 1:
                label[np.isin(label, roots)] = roots[0]
    return left, right


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same, a, b = batch.column(0).to_pylist(), batch.column(1), batch.column(2)
            left: list[int] = []
            right: list[int] = []
            for i in range(batch.num_rows):
                x = a[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                y = b[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                p, q = _forest(x, y, same[i], radius)
                left += p
                right += q
            edges = np.array([left, right], np.uint64).reshape(2, -1).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(edges[0]), pa.array(edges[1])], ["u", "v"])

    return run


def links(distinct: DataFrame, radius: int = 4, tile: int = TILE) -> DataFrame:
    """Edges (u, v) of a forest that connects the distinct fingerprints (column fp) within the radius."""
    low = F.lit(0xFFFFFFFF).cast("long")
    keyed = distinct.select("fp", F.bit_count(F.shiftrightunsigned("fp", 32)).alias("hi"), F.bit_count(F.col("fp").bitwiseAND(low)).alias("lo"))
    # At most 33 * 33 rows, whatever the input.
    keys = saved(keyed.groupBy("hi", "lo").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("cuts")).coalesce(1))
    cut = F.pmod(F.xxhash64("fp"), F.col("cuts")).cast("int")
    tiles = saved(keyed.join(F.broadcast(keys), ["hi", "lo"]).select("hi", "lo", cut.alias("cut"), "fp").groupBy("hi", "lo", "cut").agg(F.collect_list("fp").alias("fps")))
    near = [(h, x) for h in range(radius + 1) for x in range(-radius, radius + 1) if abs(h) + abs(x) <= radius and (h, x) >= (0, 0)]
    steps = F.explode(F.array(*(F.struct(F.lit(h).alias("h"), F.lit(x).alias("x")) for h, x in near)))
    others = keys.select(F.col("hi").alias("hi2"), F.col("lo").alias("lo2"), F.col("cuts").alias("cuts2"))
    left = (
        tiles.select("hi", "lo", "cut", F.col("fps").alias("a"), steps.alias("s"))
        .join(F.broadcast(others), (F.col("hi2") == F.col("hi") + F.col("s.h")) & (F.col("lo2") == F.col("lo") + F.col("s.x")))
        .select("*", F.explode(F.sequence(F.lit(0), F.col("cuts2") - 1)).alias("cut2"))
        .select("hi2", "lo2", "cut2", "a", "cut", ((F.col("s.h") == 0) & (F.col("s.x") == 0)).alias("own"))
        .where(~F.col("own") | (F.col("cut") <= F.col("cut2")))
    )
    right = tiles.select(F.col("hi").alias("hi2"), F.col("lo").alias("lo2"), F.col("cut").alias("cut2"), F.col("fps").alias("b"))
    pairs = left.join(right, ["hi2", "lo2", "cut2"]).select((F.col("own") & (F.col("cut") == F.col("cut2"))).alias("same"), "a", "b")
    return pairs.mapInArrow(_compare(radius), "u long, v long")


def _roots(distinct: DataFrame, radius: int) -> DataFrame:
    """fp and root (the same for all that are linked) for the distinct fingerprints that have links; the others are their own."""
    edges = links(distinct.select("fp"), radius)
    return components(edges).select(F.col("node").alias("fp"), "root")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 4) -> DataFrame:
    """doc_id, fp and component_id (the smallest id reachable over links) for each row of docs."""
    fps = saved(fingerprints(docs, id_col, text_col))
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    salted = F.pmod(F.xxhash64("fp"), F.lit(SALTS)).cast("int")
    rooted = classes.join(_roots(classes, radius), "fp", "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"), salted.alias("salt"))
    # A component's least id goes to each salt, so that one component does not land in one task.
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    found = saved(rooted.join(least, ["root", "salt"]).select("fp", "component_id"))
    # A fingerprint that very many rows share is split by Spark as the join runs: the other side has one row for it.
    return fps.join(found, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 4) -> DataFrame:
    """One row of docs for each component: the one with the smallest id (null ids last), the first of those with that id."""
    tag = "__terravane_row"
    rows = numbered(docs, tag)
    ids = rows.select(F.col(id_col).cast("long").alias("doc_id"), F.col(tag).alias("row"), F.col(text_col).cast("string").alias("text"))
    fps = saved(ids.mapInArrow(_fingerprints, "doc_id long, row long, fp long"))
    classes = saved(fps.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first")))
    rooted = classes.join(_roots(classes, radius), "fp", "left").select("first", F.coalesce("root", "fp").alias("root"))
    stay = rooted.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias(tag))
    return rows.join(stay, tag, "left_semi").select(*(rows[c] for c in docs.columns))
