"""Substring deduplication by relative Lempel-Ziv parsing against an index of the whole corpus.

The reference of the parse is every document. Its index holds the sequences of `window` words, dealt by hash into blocks
(Spark's partitions), and knows for each the place where it stands first. A document is parsed against every block: a
window that stands earlier too can be copied from its first place. Parsing is greedy: a factor (start, length, source
document, start there) goes on as long as the next window can be copied from the next place of the same source. Every
window is looked up, those across the boundary of two factors like all others, so a boundary hides nothing. Factors
of at least `window` words are the duplicate spans; shorter matches are literals and stay.

The index works on hashes, the parse on words: a document says the digest of the words of each factor, its source that of
the same stretch of its own words, and the two have to agree. If they don't anywhere, two different windows have met in
the hash, and everything is done again with other hashes; so what is returned is exact.

Only windows that can match are looked up. Each window has a minimiser: the least hash among its runs of GRAM words.
Equal windows have equal minimisers, so a window whose minimiser occurs once in the corpus occurs once itself. There
are about eight times fewer minimisers than words; they are counted first, and windows without a repeated one drop out
before anything is sent.

Windows of one batch of documents with equal words travel as one row, so that a passage of a third of all documents
is a row for each batch and not for each document. A block is sorted and read as a stream: the first row of a window
is its first place, all further places are copies, and no window's places are gathered.

Defined results: a null or empty text has no words; a null id counts as smaller than all others (it stands at the place
of the smallest long); rows with equal id and text are one document, and each of them gets its result; rows with equal
ids but different texts stand at the same place, so neither is earlier; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import saved

WINDOW = 20
GRAM = 6
TRIES = 5
PIECE = 8 << 20
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def grams(h: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """A hash of each run of n words (the last n - 1 places are void)."""
    out, width, level = None, 0, h if not salt else W.mix(h ^ np.uint64(salt))
    k, size = 0, 1
    while size <= n:
        if n & size:
            out = level.copy() if out is None else out + _ahead(level, width) * np.uint64(_MULTIPLIERS[-1 - k])
            width += size
        level = W.mix(level * np.uint64(_MULTIPLIERS[k]) + _ahead(level, size))
        k, size = k + 1, size * 2
    return W.mix(out)


def _ahead(x: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros_like(x)
    if n < len(x):
        out[: len(x) - n] = x[n:]
    return out


def minimisers(g: np.ndarray, width: int) -> np.ndarray:
    """For each place the leftmost least of g among the width places from it on."""
    at = np.arange(len(g))

    def least(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(g[b] < g[a], b, a)

    def moved(a: np.ndarray, n: int) -> np.ndarray:
        return np.concatenate([a[n:], np.full(min(n, len(a)), len(g) - 1)])[: len(a)]

    size = 1
    while size * 2 <= width:
        at = least(at, moved(at, size))
        size *= 2
    return least(at, moved(at, width - size)) if size < width else at


class Parsed:
    """The words of some texts: hashes, windows and the minimiser of each window."""

    def __init__(self, texts: pa.Array, window: int, salt: int = 0):
        data, at = W.flat(texts)
        mapped = W.PLAIN[data]
        self.starts, self.ends, self.first = W.spans(mapped, at)
        self.h = W.hashes(mapped, self.starts, self.ends, salt)
        self.counts = np.diff(self.first)
        n = len(self.h)
        room = np.repeat(self.first[1:], self.counts) - np.arange(n)
        self.windows = np.flatnonzero(room >= window)
        gram = min(GRAM, window)
        g = grams(self.h, gram)
        self.anchor = minimisers(g, window - gram + 1)[self.windows] if n else np.zeros(0, np.int64)
        self.anchor_hash = g[self.anchor].view(np.int64)
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)[self.windows]


def _batches(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in W.pieces(batch.column(text), PIECE):
            yield batch.slice(a, b - a)


def _anchors(window: int, salt: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _batches(batches, 2):
            p = Parsed(part.column(2), window, salt)
            # One row for each minimiser of a document, with the number of its places there.
            new = np.ones(len(p.anchor), bool)
            new[1:] = np.diff(p.anchor) != 0
            doc, key = p.doc[new], p.anchor_hash[new]
            order = np.lexsort((key, doc))
            doc, key = doc[order], key[order]
            head = np.flatnonzero(np.concatenate([[True], (np.diff(doc) != 0) | (np.diff(key) != 0)])) if len(doc) else np.zeros(0, np.int64)
            n = np.diff(np.append(head, len(doc)))
            of = pa.array(doc[head])
            yield pa.RecordBatch.from_arrays([part.column(0).take(of), part.column(1).take(of), pa.array(key[head]), pa.array(n, pa.int64())], ["kd", "kt", "anchor", "n"])

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    press = zstandard.ZstdCompressor(level=3)
    for b in batches:
        z = [press.compress((x.as_py() or "").encode()) for x in b.column(3)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(z, pa.binary())], ["kd", "kt", "th", "z"])


def _unpacked(column: pa.Array) -> pa.Array:
    import zstandard

    press = zstandard.ZstdDecompressor()
    return pa.array([press.decompress(x.as_py()).decode() for x in column], pa.large_string())


def _windows(window: int, salt: int, bits: int):
    """Rows (h1, h2, kd, th, start, rest): a window's hashes, its first place in the batch, its other places there.

    th is 0 unless several texts have the id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _unpacked(batch.column(2))
            for a, b in W.pieces(texts, PIECE):
                p = Parsed(texts.slice(a, b - a), window, salt)
                wanted = batch.column(3).slice(a, b - a)
                lists = np.asarray(wanted.flatten())
                sizes = np.asarray(wanted.value_lengths().fill_null(0))
                # A pair of document and minimiser is wanted if it is in the document's list.
                known = W.mix(lists.view(np.uint64) + np.repeat(np.arange(b - a), sizes).astype(np.uint64) * np.uint64(_MULTIPLIERS[0]))
                mine = W.mix(p.anchor_hash.view(np.uint64) + p.doc.astype(np.uint64) * np.uint64(_MULTIPLIERS[0]))
                take = np.isin(mine, known)
                w, doc = p.windows[take], p.doc[take]
                h1, h2 = (grams(p.h, window, salt=x)[w].view(np.int64) for x in (0, 0x5BD1E995))
                if bits < 64:
                    h1, h2 = h1 & ((1 << bits) - 1), h2 & 0
                kd = np.asarray(batch.column(0))[a:b][doc]
                shared = batch.column(4).slice(a, b - a).to_numpy(zero_copy_only=False)
                th = np.where(shared, np.asarray(batch.column(1))[a:b], 0)[doc]
                start = w - p.first[doc]
                order = np.lexsort((start, kd, h2, h1))
                h1, h2, kd, th, start = (x[order] for x in (h1, h2, kd, th, start))
                head = np.ones(len(h1), bool)
                head[1:] = (np.diff(h1) != 0) | (np.diff(h2) != 0)
                heads = np.flatnonzero(head)
                n = np.diff(np.append(heads, len(h1)))
                rest = np.stack([kd, th, start], axis=1)[~head].astype("<i8")
                cuts = np.concatenate([[0], np.cumsum((n - 1) * 24)]).astype(np.int64)
                packed = pa.Array.from_buffers(pa.large_binary(), len(heads), [None, pa.py_buffer(cuts), pa.py_buffer(rest.tobytes())])
                cols = [pa.array(h1[heads]), pa.array(h2[heads].astype(np.int32)), pa.array(kd[heads]), pa.array(th[heads]), pa.array(start[heads], pa.int32()), packed.cast(pa.binary())]
                # By document and place, as neighbours that are alike take less room when they are sent.
                by_place = pa.array(np.lexsort((start[heads], kd[heads])))
                yield pa.RecordBatch.from_arrays([c.take(by_place) for c in cols], ["h1", "h2", "kd", "th", "start", "rest"])

    return run


def _later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by window and place: every window that has an earlier place, with its first place.

    kd, th, at (the start in the upper half, that of the first place in the lower), skd and sth.
    """
    key, first = None, (0, 0, 0)
    for b in batches:
        if not b.num_rows:
            continue
        h1, h2, kd, th, start = (np.asarray(b.column(k)).astype(np.int64) for k in range(5))
        same = np.zeros(len(h1), bool)
        same[1:] = (np.diff(h1) == 0) & (np.diff(h2) == 0)
        same[0] = key == (h1[0], h2[0])
        group = np.cumsum(~same)  # 0: the group of the batch before
        heads = np.flatnonzero(~same)
        at = np.stack([np.concatenate([[first[k]], x[heads]])[group] for k, x in enumerate((kd, th, start))], axis=1)
        own = same & ((kd != at[:, 0]) | (start != at[:, 2]))
        found = [np.concatenate([np.stack([kd, th, start], axis=1)[own], at[own]], axis=1)]
        rest = b.column(5).cast(pa.large_binary())
        ends = np.frombuffer(rest.buffers()[1], np.int64)[rest.offset : rest.offset + len(rest) + 1]
        if ends[-1] > ends[0]:
            places = np.frombuffer(rest.buffers()[2], "<i8", (ends[-1] - ends[0]) // 8, ends[0]).reshape(-1, 3)
            source = at[np.repeat(np.arange(len(h1)), np.diff(ends) // 24)]
            later = (places[:, 0] != source[:, 0]) | (places[:, 2] != source[:, 2])
            found.append(np.concatenate([places[later], source[later]], axis=1))
        key, first = (h1[-1], h2[-1]), tuple(at[-1])
        kd, th, start, skd, sth, sstart = np.concatenate(found).T
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (kd, th, start << 32 | sstart, skd, sth)], ["kd", "th", "at", "skd", "sth"])


_FACTOR = "array<struct<start:int,n:int,skd:long,sth:long,sstart:int>>"


def _factors(window: int):
    """The greedy parse: factors of each document from the places that can be copied."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, ends = [[] for _ in range(5)], [0]
            for at, skd, sth in zip(*(batch.column(k) for k in (2, 3, 4)), strict=True):
                at, skd, sth = (x.values.to_numpy() for x in (at, skd, sth))
                start, sstart = at >> 32, at & 0xFFFFFFFF
                order = np.argsort(start, kind="stable")
                start, sstart, skd, sth = (x[order] for x in (start, sstart, skd, sth))
                new = np.ones(len(start), bool)
                new[1:] = (np.diff(start) != 1) | (np.diff(sstart) != 1) | (np.diff(skd) != 0) | (np.diff(sth) != 0)
                at = np.flatnonzero(new)
                last = np.append(at[1:], len(start)) - 1
                for c, x in zip(found, (start[at], start[last] - start[at] + window, skd[at], sth[at], sstart[at]), strict=True):
                    c.append(x)
                ends.append(ends[-1] + len(at))
            names, kinds = ("start", "n", "skd", "sth", "sstart"), (np.int32, np.int32, np.int64, np.int64, np.int32)
            flat = pa.StructArray.from_arrays([pa.array(np.concatenate(c).astype(k) if c else np.zeros(0, k)) for c, k in zip(found, kinds, strict=True)], names)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)], ["kd", "th", "factors"])

    return run


def _digest(words: list[bytes]) -> int:
    return int.from_bytes(hashlib.blake2b(b" ".join(words), digest_size=8).digest(), "little", signed=True)


_STRETCH = "array<struct<skd:long,sth:long,sstart:int,n:int,digest:long>>"


def _removed(texts: bool):
    """The result of each document, what it says of its factors (claims), and what of stretches that others copy (proofs)."""
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    keys = ("skd", "sth", "sstart", "n")

    def stretches(lists: pa.Array, skd: pa.Array | None, digests: list[int]) -> pa.Array:
        """The lists with a digest for each entry; skd is that of the row where the entries have none."""
        entries = lists.flatten()
        sizes = np.asarray(lists.value_lengths().fill_null(0))
        ends = pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32))
        kd = entries.field("skd") if skd is None else skd.take(pa.array(np.repeat(np.arange(len(lists)), sizes)))
        return pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([kd, *(entries.field(k) for k in keys[1:]), pa.array(digests, pa.int64())], [*keys, "digest"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kd, z, factors, asked = batch.columns
            rows, claims, proofs = [], [], []
            at_of = lambda lists, name: zip(lists.flatten().field(name).to_pylist(), lists.flatten().field("n").to_pylist(), strict=True)
            of_factors, of_asked = at_of(factors, "start"), at_of(asked, "sstart")
            n_factors, n_asked = (x.value_lengths().fill_null(0).to_pylist() for x in (factors, asked))
            for i, text in enumerate(_unpacked(z)):
                words = text.as_py().encode().split()
                spans, keep, at = [], [], 0
                for start, n in islice(of_factors, n_factors[i]):
                    claims.append(_digest(words[start : start + n]))
                    if spans and start <= spans[-1][1]:
                        spans[-1][1] = max(start + n, spans[-1][1])
                    else:
                        spans.append([start, start + n])
                proofs += [_digest(words[start : start + n]) for start, n in islice(of_asked, n_asked[i])]
                for a, b in spans:
                    keep += words[at:a]
                    at = b
                keep += words[at:]
                kept = b" ".join(keep)
                rows.append((len(words), len(words) - len(keep), hashlib.sha256(kept).hexdigest(), kept.decode() if texts else None, [{"start": a, "end": b} for a, b in spans]))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), span)
            said = [stretches(factors, None, claims), stretches(asked, kd, proofs)]
            yield pa.RecordBatch.from_arrays([kd, *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True)), *said], ["kd", "n_words", "n_removed", "kept_sha256", "kept_text", "spans", "claims", "proofs"])

    return run


NULL_ID = -(1 << 63)


def _parse(docs: DataFrame, id_col: str, text_col: str, window: int, texts: bool, salt: int, bits: int = 64) -> DataFrame:
    """Results with claims and proofs, by hashes of one salt (of few bits in tests)."""
    text = F.col(text_col).cast("string")
    # Rows without an id share one place, but are documents of their own.
    source = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("kd"), F.when(F.col(id_col).isNull(), F.xxhash64(text)).otherwise(0).alias("kt"), F.xxhash64(text).alias("th"), text.alias("text"))
    anchors = source.select("kd", "kt", "text").mapInArrow(_anchors(window, salt), "kd long, kt long, anchor long, n long")
    repeated = saved(anchors.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor"))
    by_id = anchors.select("kd", "kt", "anchor").join(repeated, "anchor").groupBy("kd", "kt").agg(F.collect_list("anchor").alias("anchors"))
    shared = source.select("kd", "kt", "th").groupBy("kd", "kt").agg(((F.min("th") != F.max("th")) | (F.first("kt") != 0)).alias("shared")).where("shared")
    wanted = by_id.join(shared, ["kd", "kt"], "left").select("kd", "kt", "anchors", F.coalesce("shared", F.lit(False)).alias("shared"))
    # The texts are sent once: both joins below deal them by the same keys, and Spark reuses that exchange. For this
    # the first is an outer join too; documents without a wanted minimiser give no windows.
    packed = source.mapInArrow(_packed, "kd long, kt long, th long, z binary")
    windows = packed.join(wanted, ["kd", "kt"], "left").select("kd", "th", "z", F.coalesce("anchors", F.array().cast("array<long>")).alias("anchors"), F.coalesce("shared", F.lit(False)).alias("shared"))
    windows = windows.mapInArrow(_windows(window, salt, bits), "h1 long, h2 int, kd long, th long, start int, rest binary")
    blocks = windows.repartition("h1").sortWithinPartitions("h1", "h2", "kd", "start")
    places = blocks.mapInArrow(_later, "kd long, th long, at long, skd long, sth long").groupBy("kd", "th").agg(*(F.collect_list(c).alias(c) for c in ("at", "skd", "sth")))
    factors = places.mapInArrow(_factors(window), f"kd long, th long, factors {_FACTOR}")
    # A null id's th is its kt; that of another row is 0 unless its id has several texts.
    key = lambda kd, th: [F.col(kd), F.when(F.col(kd) == NULL_ID, F.col(th)).otherwise(0)]
    kd, kt = key("kd", "th")
    own = factors.select(kd.alias("kd2"), kt.alias("kt2"), F.col("th").alias("th2"), "factors")
    kd, kt = key("skd", "sth")
    asked = (
        factors.select(F.explode("factors").alias("f"))
        .select("f.skd", "f.sth", "f.sstart", "f.n")
        .distinct()
        .groupBy(kd.alias("kd3"), kt.alias("kt3"), F.col("sth").alias("th3"))
        .agg(F.collect_list(F.struct("sth", "sstart", "n")).alias("asked"))
    )
    same = lambda n: (F.col("kd") == F.col(f"kd{n}")) & (F.col("kt") == F.col(f"kt{n}")) & ((F.col(f"th{n}") == 0) | (F.col(f"th{n}") == F.col("th")))
    out = packed.join(own, same(2), "left").join(asked, same(3), "left").select("kd", "z", "factors", "asked")
    schema = f"kd long, n_words long, n_removed long, kept_sha256 string, kept_text string, spans array<struct<start:int,end:int>>, claims {_STRETCH}, proofs {_STRETCH}"
    return saved(out.mapInArrow(_removed(texts), schema))


def _contradicted(parsed: DataFrame) -> bool:
    """Whether any factor differs from its source in words."""
    said = lambda c: parsed.select(F.explode(c).alias("c")).select("c.*").distinct()
    at = ["skd", "sth", "sstart", "n"]
    proofs = said("proofs").withColumnRenamed("digest", "proof")
    return bool(said("claims").join(proofs, at, "left").where("proof is null or digest <> proof").head(1))


def remove_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, texts: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept_text and spans (start and end in words) for each row of docs.

    kept_text is null unless texts.
    """
    for salt in range(TRIES):
        out = _parse(docs, id_col, text_col, window, texts, salt)
        if not _contradicted(out):
            return out.select(F.when(F.col("kd") != NULL_ID, F.col("kd")).alias("doc_id"), "n_words", "n_removed", "kept_sha256", "kept_text", "spans")
    raise RuntimeError(f"different windows met in every one of {TRIES} hashes")
