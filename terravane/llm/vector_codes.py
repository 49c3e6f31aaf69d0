"""Vectors as short codes: product quantisation with integer codebooks, exact at every step.

A component x counts as the integer floor(scale * x). A vector is cut into `parts` equal consecutive parts, and each
part position has a codebook of `entries` integer entries. The codebooks are broadcast; tasks take Arrow batches and
get all squared distances of a batch by norms and one int64 matrix product, and the first smallest one wins. Each
round a task sums what it gave to each entry, and these sums meet in a shuffle keyed by part and entry, so what the
shuffle and the driver see is bounded by parts * entries rows a task and in all, whatever the number of vectors. Sums
travel as upper and lower 32 bits, which cannot overflow. Where a distance may pass 63 bits a batch is computed in
Python's integers, so results stay exact.

The table is read once a round; nothing else is kept between rounds than the codebooks, so a lost executor costs the
tasks it was running.

Defined results: vectors that are null or hold null or non-finite components are dropped. Of the others, those of
another length than most have (of the longest such length on a tie), those whose length is no multiple of `parts`,
empty ones, and those with an integer beyond 2^53 stay as rows with a null code and error. The first entries are
those of the smallest ids; equal ids are taken by their integers, null ids last. With fewer vectors than entries
there are fewer entries. An error or a sum of errors beyond a long is null, sums skip null errors, and a label none
of whose vectors has an error has a null one. Columns other than the three named are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved
from .vectors import finite, floored, matrix, usual_length

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Labels with their error sums are broadcast up to this many, joined by shuffle beyond.
BROADCAST_LABELS = 10_000
_LOW = 0xFFFFFFFF


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The index of the nearest entry (the first of equally near ones) for each row of x, and the squared distance."""
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(book).max(initial=0)))
    if 4 * x.shape[1] * top * top >= 2**63:
        x, book = x.astype(object), book.astype(object)
    turned = np.ascontiguousarray(book.T)
    far = (x * x).sum(axis=1)[:, None] - 2 * np.matmul(x, turned) + (book * book).sum(axis=1)
    at = far.argmin(axis=1)
    return at, far[np.arange(len(x)), at]


def _blocks(batches: Iterator[pa.RecordBatch], length: int, rows: int = 4096) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with the matrix of the vectors that are there (last column) and where these stand."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            lists = part.columns[-1]
            yield part, matrix(lists, length), np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False))


def _sums(books, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, k = books.value.shape
        n = np.zeros((parts, entries), np.int64)
        halves = np.zeros((2, parts, entries, k), np.int64)
        for _, x, _ in _blocks(batches, length):
            for p in range(parts if len(x) else 0):
                own = x[:, p * k : (p + 1) * k]
                at, _ = nearest(own, books.value[p])
                order = np.argsort(at, kind="stable")
                used, start = np.unique(at[order], return_index=True)
                n[p] += np.bincount(at, minlength=entries)
                halves[0, p, used] += np.add.reduceat(own[order] >> 32, start, axis=0)
                halves[1, p, used] += np.add.reduceat(own[order] & _LOW, start, axis=0)
        part, entry = np.nonzero(n)
        high, low = (pa.array(list(h[part, entry]), pa.list_(pa.int64())) for h in halves)
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(n[part, entry]), high, low], ["part", "entry", "n", "high", "low"])

    return run


def _encode(books, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, _, k = books.value.shape
        for block, x, where in _blocks(batches, length):
            codes: list[str | None] = [None] * block.num_rows
            errors: list[int | None] = [None] * block.num_rows
            got = [nearest(x[:, p * k : (p + 1) * k], books.value[p]) for p in range(parts)] if len(x) else []
            if got:
                said = np.stack([at for at, _ in got], axis=1).astype(np.uint8).tobytes().hex()
                for i, row in enumerate(where.tolist()):
                    codes[row] = said[2 * parts * i : 2 * parts * (i + 1)]
                    error = sum(int(d[i]) for _, d in got)
                    errors[row] = error if error < 2**63 else None
            yield pa.RecordBatch.from_arrays([*block.columns[:-1], pa.array(codes, pa.string()), pa.array(errors, pa.int64())], [*block.schema.names[:-1], "code", "error"])

    return run


def _integers(vectors: DataFrame, id_col: str, vec_col: str, label_col: str, scale: int, parts: int) -> tuple[DataFrame, int]:
    """vec_id, label and x (the integers, null where a vector cannot be coded), and the length of the coded vectors."""
    rows = vectors.where(finite(F.col(vec_col))).select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vec_col).alias("v"))
    length = usual_length(rows, "v")
    fits = (F.size("v") == length) & F.lit(length > 0 and length % parts == 0)
    return rows.select("vec_id", "label", F.when(fits, floored(F.col("v"), scale)).alias("x")), length


def train(ints: DataFrame, length: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks after the given rounds, as integers by part, entry and position. ints: vec_id and x, as _integers gives them.

    In the driver are at most `entries` vectors and parts * entries sums.
    """
    if not 1 <= entries <= 256:
        raise ValueError("an index has two hexadecimal digits: entries has to be from 1 to 256")
    there = ints.where("x is not null").select("vec_id", "x")
    first = np.array([r["x"] for r in there.orderBy(F.asc_nulls_last("vec_id"), "x").limit(entries).collect()], np.int64)
    k = length // parts
    books = first.reshape(-1, parts, k).transpose(1, 0, 2).copy() if len(first) else np.zeros((parts, 0, k), np.int64)
    context = ints.sparkSession.sparkContext
    for _ in range(rounds if len(first) else 0):
        sent = context.broadcast(books)
        given = there.select("x").mapInArrow(_sums(sent, length), "part int, entry int, n long, high array<long>, low array<long>")
        merged = given.groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(F.get(half, i)).alias(f"{half}{i}") for half in ("high", "low") for i in range(k)))
        books = books.copy()
        for r in merged.toLocalIterator():
            total = [(r[f"high{i}"] << 32) + r[f"low{i}"] for i in range(k)]
            books[r["part"], r["entry"]] = [t // r["n"] for t in total]
        sent.unpersist()
    return books


def codebooks_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error (error summed over equal labels, nulls together) and codebooks_sha256."""
    ints, length = _integers(vectors, id_col, vec_col, label_col, scale, parts)
    books = train(ints, length, parts, entries, rounds)
    sent = ints.sparkSession.sparkContext.broadcast(books)
    label = ints.schema["label"].dataType.simpleString()
    coded = saved(ints.mapInArrow(_encode(sent, length), f"vec_id long, label {label}, code string, error long"))
    sums = saved(coded.groupBy("label").agg(F.try_sum("error").alias("label_error")))
    if sums.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS:
        sums = F.broadcast(sums)
    sums = sums.withColumnRenamed("label", "of")
    return coded.join(sums, coded["label"].eqNullSafe(sums["of"])).select("vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
