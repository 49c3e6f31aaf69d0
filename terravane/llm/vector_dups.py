"""Near-duplicate vectors by collisions of one-dimensional projections, checked by exact cosines.

Rows are compared within one label (and one length). Equal vectors are first put together. Of two unit vectors with
the given cosine the difference has length at most D = sqrt(2 - 2 * cosine); on a direction drawn from a normal
distribution the two projections then differ by a normal value of deviation at most D. So of m independent directions
the number on which the second vector lies in a window of WINDOW * D around the first is binomial, whatever the data,
and the count that a pair has to reach is the largest that true pairs miss in at most 1 - RECALL of cases.

A few leading directions sort the vectors: each is cut into windows of LEAD * D, and a vector's places on the leading
directions name its cell. A true pair lies in the same or the next window on each of them (it misses that in one of
2,000 cases a direction). Small labels use none, and every four times as many vectors a further one, up to six, so
that a label with very many vectors is not compared as a whole. A full cell is cut into tiles of about TILE vectors;
tiles of the same and of neighbouring cells meet in work items. Inside an item numpy counts the collisions of every
pair, and pairs that pass get their cosine in double precision. An item returns the number of links of each vector and a
spanning forest of what it has linked, never the pairs, so a group of n near copies gives about n edges a tile.

Recall is 0.9995 * 0.9995^leads at the threshold and higher above; no pair below the threshold is ever linked. There is
no cap on partners, cells or candidates.

Defined results: null labels, and vectors that are null, empty, zero or hold null or non-finite components, link with
nothing; nor do vectors of different lengths. Equal vectors of a label link each other. Rows with equal ids are rows of
their own, which count as each other's links if they are near. A class without any id has a null component_id; null
equals null in kept. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, saved
from .components import components
from .vectors import finite, matrix

COSINE = 0.98
PROJECTIONS = 16
WINDOW = 2.2
RECALL = 0.9995
LEAD = 3.5
LEADS = 6
TILE = 2048
SEED = 20_240_229
#: Salts for the join of members with their component, one of which may hold most of the rows.
SALTS = 16


def directions(length: int, count: int, seed: int = SEED) -> np.ndarray:
    """count directions of normally distributed components, the same in every task."""
    return np.random.Generator(np.random.PCG64([seed, length])).standard_normal((count, length))


def reach(cosine: float) -> float:
    """The greatest distance of unit vectors with at least this cosine."""
    return math.sqrt(max(0.0, 2.0 - 2.0 * cosine))


def needed(count: int = PROJECTIONS, window: float = WINDOW, recall: float = RECALL) -> int:
    """The greatest number of collisions that a pair at the threshold reaches with at least this probability."""
    p = math.erf(window / math.sqrt(2.0))
    chance = 0.0
    for k in range(count, -1, -1):
        chance += math.comb(count, k) * p**k * (1.0 - p) ** (count - k)
        if chance >= recall:
            return k
    return 0


def units(x: np.ndarray) -> np.ndarray:
    """The rows as unit vectors in double precision; first by the largest component, so that no square overflows."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _lead(cosine: float, leads: int):
    width = max(LEAD * reach(cosine), 1e-6)

    def run(batches):
        for b in batches:
            lists = b.columns[-1]
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            places = np.zeros((b.num_rows, leads), np.int32)
            for length in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == length)
                x = units(matrix(lists.take(pa.array(own)), length))
                places[own] = np.floor(x @ directions(length, leads).T / width)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(list(places), pa.list_(pa.int32()))], [*b.schema.names, "places"])

    return run


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least index reachable from each of n nodes over the links (i, j)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def linked(a: np.ndarray, b: np.ndarray | None, cosine: float, count: int, window: float, need: int) -> tuple[np.ndarray, np.ndarray]:
    """The linked pairs between the unit vectors a and b, or within a. Rows are taken in blocks, so no more than 2^21 pairs are looked at at once."""
    same = b is None
    b = a if same else b
    turn = directions(a.shape[1], count).T
    pa_, pb = (a @ turn).astype(np.float32), np.ascontiguousarray((b @ turn).astype(np.float32).T)
    wide = np.float32(window * reach(cosine) + 1e-6)
    rows = max(1, (1 << 21) // max(1, len(b)))
    left, right = [], []
    for at in range(0, len(a), rows):
        hits = np.zeros((min(rows, len(a) - at), len(b)), np.uint8)
        for k in range(count):
            hits += np.abs(pb[k][None, :] - pa_[at : at + rows, k][:, None]) <= wide
        near = hits >= need
        if same:
            near &= np.arange(len(b))[None, :] > np.arange(at, at + len(near))[:, None]
        if np.count_nonzero(near) * 32 > near.size:  # so many that one product of matrices is less work than single ones
            near &= a[at : at + rows] @ b.T >= cosine
            i, j = np.nonzero(near)
        else:
            i, j = np.nonzero(near)
            keep = np.concatenate([np.zeros(0, bool), *((a[i[s : s + 65_536] + at] * b[j[s : s + 65_536]]).sum(axis=1) >= cosine for s in range(0, len(i), 65_536))])
            i, j = i[keep], j[keep]
        left.append(i + at)
        right.append(j)
    return np.concatenate([np.zeros(0, np.int64), *left]), np.concatenate([np.zeros(0, np.int64), *right])


def _compare(cosine: float, count: int, window: float, need: int):
    def run(t: pa.Table) -> pa.Table:
        second = t["second"].to_numpy()
        order = np.argsort(second, kind="stable")
        n_a = int(len(second) - second.sum())
        same = bool(t["same"][0].as_py())
        node, copies = t["node"].to_numpy()[order], t["copies"].to_numpy()[order]
        x = units(matrix(t["v"], t["length"][0].as_py()))[order]
        i, j = linked(x[:n_a], None if same else x[n_a:], cosine, count, window, need)
        if not same:
            j = j + n_a
        links = np.zeros(len(node), np.int64)
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        root = forest(len(node), i, j)
        moved = np.flatnonzero(root != np.arange(len(node)))
        some = np.flatnonzero(links)
        none = pa.nulls(len(some), pa.int64())
        return pa.table(
            {
                "u": pa.concat_arrays([pa.array(node[moved]), pa.array(node[some])]),
                "v": pa.concat_arrays([pa.array(node[root[moved]]), none]),
                "n": pa.concat_arrays([pa.array(np.zeros(len(moved), np.int64)), pa.array(links[some])]),
            }
        )

    return run


def _items(cells: DataFrame, leads: int) -> DataFrame:
    """A row for each pair of tiles that meet: item, same, and cell and cut of either."""
    around = cells
    for k in range(leads):
        step = F.when(F.lit(k) < F.col("used"), F.array(F.lit(-1), F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        around = around.withColumn(f"s{k}", F.explode(step))
    moved = F.slice(F.array(*(F.get("cell", k) + F.col(f"s{k}") for k in range(leads))), F.lit(1), F.col("used"))
    around = around.select("label", "length", moved.alias("cell"), F.col("cell").alias("own"), F.col("number").alias("a"), F.col("cuts").alias("cuts_a")).where("own <= cell")
    others = cells.select("label", "length", "cell", F.col("number").alias("b"), F.col("cuts").alias("cuts_b"))
    pairs = around.join(others, ["label", "length", "cell"]).select("*", F.explode(F.expr("sequence(0, cuts_a - 1)")).alias("cut_a"))
    pairs = pairs.select("*", F.explode(F.expr("sequence(if(a = b, cut_a, 0), cuts_b - 1)")).alias("cut_b"))
    return numbered(pairs.select(((F.col("a") == F.col("b")) & (F.col("cut_a") == F.col("cut_b"))).alias("same"), "a", "cut_a", "b", "cut_b"), "item")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", cosine: float = COSINE, tile: int = TILE, leads: int = LEADS) -> DataFrame:
    """vec_id, n_links (other vectors linked directly), component_id and kept for each row."""
    v = F.col(vec_col)
    if vectors.schema[vec_col].dataType.elementType.simpleString() not in ("float", "double"):
        v = v.cast("array<double>")
    there = finite(v) & F.exists(v, lambda x: x != 0) & F.col(label_col).isNotNull()
    keyed = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.when(there, v).alias("v"))
    # 128 bits name a class of equal rows; the vectors themselves are shuffled once only.
    # Rows that link with nothing get a null second half, and a first half that spreads them.
    some = F.col("v").isNotNull()
    keyed = keyed.withColumns({"h1": F.when(some, F.xxhash64("label", "v")).otherwise(F.xxhash64("vec_id")), "h2": F.when(some, F.xxhash64(F.lit("second"), "label", "v"))})
    classes = keyed.where("v is not null").groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("rep"), F.first("label").alias("label"), F.first("v").alias("v"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in classes.schema.fields)
    nodes = numbered(classes.mapInArrow(_lead(cosine, leads), f"{schema}, places array<int>").withColumn("length", F.size("v")), "node")

    sizes = nodes.groupBy("label", "length").count()
    used = F.least(F.lit(leads), F.greatest(F.lit(0), F.floor(F.log2(F.col("count") / tile) / 2))).cast("int")
    placed = nodes.join(sizes.select("label", "length", used.alias("used")), ["label", "length"]).withColumn("cell", F.slice("places", F.lit(1), F.col("used")))
    cells = numbered(placed.groupBy("label", "length", "used", "cell").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("cuts")), "number")
    items = _items(cells, leads)

    tiled = placed.join(cells.select("label", "length", "cell", "number", "cuts"), ["label", "length", "cell"])
    tiled = tiled.select("number", F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int").alias("cut"), "node", "copies", "length", "v")
    first = items.select("item", "same", F.col("a").alias("number"), F.col("cut_a").alias("cut"), F.lit(0).alias("second"))
    second = items.where("not same").select("item", "same", F.col("b").alias("number"), F.col("cut_b").alias("cut"), F.lit(1).alias("second"))
    met = tiled.join(first.union(second), ["number", "cut"]).select("item", "same", "second", "node", "copies", "length", "v")
    found = saved(met.groupBy("item").applyInArrow(_compare(cosine, PROJECTIONS, WINDOW, needed()), "u long, v long, n long"))

    links = found.where("v is null").groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("others"))
    rooted = components(found.where("v is not null").select("u", "v"))
    reps = nodes.select("node", "h1", "h2", "copies", "rep")
    full = saved(reps.join(links, "node", "left").join(rooted, "node", "left").select("h1", "h2", "rep", F.coalesce("root", "node").alias("root"), (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.pmod(F.xxhash64("node"), F.lit(SALTS)).alias("salt")))
    # A component's least id goes to each salt, so that one component does not land in one task.
    least = full.groupBy("root").agg(F.min("rep").alias("component_id")).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    told = full.join(least, ["root", "salt"]).select("h1", "h2", "n_links", "component_id")
    rows = keyed.select("vec_id", "h1", "h2").join(told, ["h1", "h2"], "left")
    component = F.when(F.col("h2").isNotNull(), F.col("component_id")).otherwise(F.col("vec_id"))
    return rows.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id")).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
