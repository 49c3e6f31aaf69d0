"""Benchmark decontamination by Wu-Manber search over words.

The patterns are the windows of `window` consecutive words of the benchmark items; an item with fewer words is one
pattern. Patterns of one length m are searched together. A block is two neighbouring words (one word if m is 1). For
each block that a pattern has, a shift table says how far the end of a window may move when it stands there; every
other block allows m - 1. Where the shift is zero, the hash of that block at the window's end names a bucket of
patterns, which are compared word by word, and at last as strings. Texts are cut into runs of words that overlap by
m - 1, and numpy moves the windows of all runs of a batch together.

Only the patterns are broadcast, as arrays, in blocks of about `block_bytes` of benchmark text (some 20 bytes of
arrays for each byte of it); an item of more than LONG_ITEM words is cut into pieces that share `window` - 1 words, so
that no item fills more than a block. A larger benchmark takes several passes over the
documents, one after the other and each saved, whose results are united by a saved number of the row.

Defined results: null and empty texts have no words; a null item text has no pattern; repeated rows give a row each,
however many passes there are; the windows of items without an id make words hit but name no item, in every entry
of this module alike; repeated items count once; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import numbered, saved

WINDOW = 10
RUN = 256
BLOCK_BYTES = 4 << 20
LONG_ITEM = 65_536


def _byte(b: int) -> int:
    b = b + 32 if 65 <= b <= 90 else b
    return b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 0


#: A-Z become a-z; words are letters, digits and everything beyond ASCII.
BYTES = W.table(_byte)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return W.mix(a * np.uint64(0x9E3779B97F4A7C15) + b)


class Patterns:
    """Shift tables and buckets for the windows of some items."""

    def __init__(self, items: list[tuple[object, str | None]], window: int = WINDOW):
        texts = pa.array([t or "" for _, t in items], pa.large_string())
        data, at = W.flat(texts)
        low = BYTES[data]
        self.names = [i for i, _ in items]
        self.s, self.e, first = W.spans(low, at)
        self.low = low.tobytes()
        h = W.hashes(low, self.s, self.e)
        n = np.diff(first)
        length = np.minimum(n, window)
        self.groups = []
        for m in np.unique(length[length > 0]).tolist():
            some = np.flatnonzero(length == m)
            count = n[some] - m + 1
            item = np.repeat(some, count)
            begin = np.repeat(first[:-1][some], count) + np.arange(len(item)) - np.repeat(np.cumsum(count) - count, count)
            self.groups.append(self._group(m, h, begin, item))

    def words(self, begin: int, m: int) -> list[bytes]:
        return [self.low[self.s[i] : self.e[i]] for i in range(begin, begin + m)]

    def _group(self, m: int, h: np.ndarray, begin: np.ndarray, item: np.ndarray) -> dict:
        hashed = h[begin[:, None] + np.arange(m)]
        hashed, inverse = np.unique(hashed, axis=0, return_inverse=True)
        inverse = inverse.reshape(-1)
        # Windows of equal hashes are one pattern if their words are equal too, and several if not.
        order = np.argsort(inverse, kind="stable")
        heads = np.searchsorted(inverse[order], np.arange(len(hashed)))
        lead = begin[order[heads]]
        extra: dict[tuple[int, tuple[bytes, ...]], int] = {}
        pattern, leads, rows = inverse.copy(), lead.tolist(), list(range(len(hashed)))
        for k in np.flatnonzero(begin != lead[inverse]).tolist():
            said = self.words(int(begin[k]), m)
            if said != self.words(int(lead[inverse[k]]), m):
                key = (int(inverse[k]), tuple(said))
                if key not in extra:
                    extra[key] = len(leads)
                    leads.append(int(begin[k]))
                    rows.append(int(inverse[k]))
                pattern[k] = extra[key]
        hashed = hashed[rows]
        size = min(2, m)
        block = lambda q: hashed[:, q] if size == 1 else _pair(hashed[:, q - 1], hashed[:, q])
        # Of a block that stands at several places the last one says how far the window may move.
        keys = np.concatenate([block(q) for q in range(m - 1, size - 2, -1)])
        shifts = np.repeat(np.arange(m - size + 1), len(hashed))
        keys, at = np.unique(keys, return_index=True)
        last = block(m - 1)
        bucket = np.argsort(last, kind="stable")
        pairs = np.unique(np.stack([pattern, item], axis=1), axis=0)
        return {"m": m, "size": size, "hashed": hashed, "leads": np.array(leads, np.int64), "keys": keys, "shifts": shifts[at], "bucket_keys": last[bucket], "bucket": bucket, "item": pairs[:, 1], "items": np.searchsorted(pairs[:, 0], np.arange(len(leads) + 1))}


def _ends(h: np.ndarray, first: np.ndarray, g: dict) -> tuple[np.ndarray, np.ndarray]:
    """Words at which the shift is zero, and the keys of their blocks."""
    m, size = g["m"], g["size"]
    counts = np.diff(first)
    runs = np.where(counts >= m, (counts - m) // RUN + 1, 0)
    base = np.repeat(first[:-1], runs)
    k = np.arange(len(base)) - np.repeat(np.cumsum(runs) - runs, runs)
    at = base + k * RUN + m - 1
    stop = np.minimum(np.repeat(first[1:], runs), base + (k + 1) * RUN + m - 1)
    far = m - size + 1
    hits, keys = [], []
    while len(at):
        block = h[at] if size == 1 else _pair(h[at - 1], h[at])
        i = np.minimum(np.searchsorted(g["keys"], block), len(g["keys"]) - 1)
        step = np.where(g["keys"][i] == block, g["shifts"][i], far)
        zero = step == 0
        if zero.any():
            hits.append(at[zero])
            keys.append(block[zero])
        at = at + np.maximum(step, 1)
        live = at < stop
        at, stop = at[live], stop[live]
    return (np.concatenate(hits), np.concatenate(keys)) if hits else (np.zeros(0, np.int64), np.zeros(0, np.uint64))


def search(texts: pa.Array, patterns: Patterns) -> tuple[np.ndarray, np.ndarray, dict[int, set[str]], np.ndarray]:
    """For some texts: words of each, hit words of each, items found by text, and the hit flag of every word."""
    data, at = W.flat(texts)
    low = BYTES[data]
    s, e, first = W.spans(low, at)
    h = W.hashes(low, s, e)
    cover = np.zeros(len(s) + 1, np.int64)
    items: dict[int, set[str]] = {}
    for g in patterns.groups:
        m = g["m"]
        ends, keys = _ends(h, first, g)
        order = np.argsort(keys, kind="stable")
        ends, keys = ends[order], keys[order]
        cuts = np.flatnonzero(np.diff(keys)) + 1 if len(keys) else []
        for some in np.split(ends, cuts) if len(keys) else []:
            key = h[some[0]] if g["size"] == 1 else _pair(h[some[:1] - 1], h[some[:1]])[0]
            lo, hi = np.searchsorted(g["bucket_keys"], key, "left"), np.searchsorted(g["bucket_keys"], key, "right")
            for p in g["bucket"][lo:hi].tolist():
                here = some
                for q in range(m):
                    here = here[h[here - (m - 1 - q)] == g["hashed"][p, q]]
                want = patterns.words(int(g["leads"][p]), m)
                sure = [x for x in here.tolist() if all(low[s[x - m + 1 + q] : e[x - m + 1 + q]].tobytes() == want[q] for q in range(m))]
                if sure:
                    named = [patterns.names[i] for i in g["item"][g["items"][p] : g["items"][p + 1]].tolist() if patterns.names[i] is not None]
                    x = np.array(sure)
                    np.add.at(cover, x - m + 1, 1)
                    np.add.at(cover, x + 1, -1)
                    for d in np.unique(np.searchsorted(first, x, "right") - 1).tolist():
                        items.setdefault(d, set()).update(named)
    hit = np.cumsum(cover[:-1]) > 0
    total = np.concatenate([[0], np.cumsum(hit)])
    return np.diff(first), total[first[1:]] - total[first[:-1]], items, hit


def _searcher(patterns, with_hits: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = patterns.value
        for batch in batches:
            for a, b in W.pieces(batch.column(1)):
                part = batch.slice(a, b - a)
                n, n_hit, items, hit = search(part.column(1), known)
                first = np.concatenate([[0], np.cumsum(n)])
                cols = [part.column(0), pa.array(n, pa.int64()), pa.array(n_hit, pa.int64()), pa.array([sorted(items.get(i, ())) for i in range(b - a)], pa.list_(pa.string()))]
                names = [batch.schema.names[0], "n_words", "n_hit", "items"]
                if with_hits:
                    cols += [pa.array([np.flatnonzero(hit[first[i] : first[i + 1]]) for i in range(b - a)], pa.list_(pa.int64()))]
                    names += ["hits"]
                yield pa.RecordBatch.from_arrays(cols, names)

    return run


ROW = "__terravane_row"


def _items(benchmark: DataFrame, item_col: str, text_col: str, window: int, long_item: int = LONG_ITEM) -> DataFrame:
    """item (null where there is no id) and text, each once; very long texts in pieces that hold every window."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    said = F.filter(F.split(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")
    cut = F.transform(F.sequence(F.lit(1), F.size("w") - window + 1, F.lit(long_item)), lambda at: F.array_join(F.slice("w", at, long_item + window - 1), " "))
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), text.alias("text"), F.when(F.octet_length(text) > 2 * long_item, said).alias("w"))
    return items.select("item", F.explode(F.when(F.size("w") > long_item + window, cut).otherwise(F.array("text"))).alias("text")).distinct()


def _blocks(items: DataFrame, block_bytes: int) -> int:
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return max(1, -(-size // block_bytes))


def _patterns(items: DataFrame, block: int, blocks: int, window: int):
    """The patterns of one block of the items (item, text), broadcast."""
    some = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
    return items.sparkSession.sparkContext.broadcast(Patterns([(r["item"], r["text"]) for r in some.collect()], window))


def _in_passes(rows: DataFrame, text_col: str, items: DataFrame, blocks: int, window: int) -> DataFrame:
    """ROW, n_words, n_hit and items for each of the numbered rows, by a pass over them for each block."""
    texts = rows.select(ROW, F.col(text_col).cast("string").alias("text"))
    schema = f"{ROW} long, n_words long, n_hit long, items array<string>, hits array<long>"
    each = None
    for k in range(blocks):
        patterns = _patterns(items, k, blocks, window)
        some = saved(texts.mapInArrow(_searcher(patterns, True), schema))
        patterns.unpersist()
        each = some if each is None else each.unionByName(some)
    by = each.groupBy(ROW).agg(F.max("n_words").alias("n_words"), F.array_distinct(F.flatten(F.collect_list("hits"))).alias("h"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return by.select(ROW, "n_words", F.size("h").cast("long").alias("n_hit"), "items")


def occurrences(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit and items (sorted ids as strings) for each row of docs."""
    items = _items(benchmark, item_col, item_text_col, window)
    blocks = _blocks(items, block_bytes)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    if blocks == 1:
        return texts.mapInArrow(_searcher(_patterns(items, 0, 1, window), False), "doc_id long, n_words long, n_hit long, items array<string>")
    rows = numbered(texts, ROW)
    return rows.select(ROW, "doc_id").join(_in_passes(rows, "text", items, blocks, window), ROW).select("doc_id", "n_words", "n_hit", "items")


def digest(found: DataFrame) -> DataFrame:
    """The digest columns of occurrences()."""
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def _cleaner(patterns, most: float, text_index: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = patterns.value
        for batch in batches:
            for a, b in W.pieces(batch.column(text_index)):
                part = batch.slice(a, b - a)
                n, n_hit, _, _ = search(part.column(text_index).cast(pa.string()), known)
                yield part.filter(pa.array(n_hit <= most * n))

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW, most: float = 0.0, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of docs with at most a share `most` of their words inside benchmark windows."""
    items = _items(benchmark, "item_id", "text", window)
    blocks = _blocks(items, block_bytes)
    if blocks > 1 and most:
        # The words that the blocks hit have to be united before their share is known.
        rows = numbered(docs, ROW)
        clean = _in_passes(rows, text_col, items, blocks, window).where(F.col("n_hit") <= F.lit(float(most)) * F.col("n_words"))
        return rows.join(clean.select(ROW), ROW, "left_semi").select(*(rows[c] for c in docs.columns))
    out = docs
    for k in range(blocks):
        patterns = _patterns(items, k, blocks, window)
        out = out.mapInArrow(_cleaner(patterns, most, docs.columns.index(text_col)), docs.schema)
        if blocks > 1:
            out = saved(out)
            patterns.unpersist()
    return out
