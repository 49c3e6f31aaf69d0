"""Best-fit packing of tokenised documents into sequences of a fixed length, in bulk-synchronous supersteps.

A document longer than a sequence is cut into full pieces and one rest, which comes first. A piece longer than half a
sequence can share one with shorter pieces only, so each of these opens a sequence. The others meet the gaps:

1. Pieces and gaps are sorted by size over range partitions, pieces before gaps of their size.
2. Every partition sweeps its rows upwards: a gap takes the longest piece below it that is still free, so each pair is
   a piece and its successor. What a partition cannot pair among its own is a row of gaps, then a row of pieces. Only
   how many of them each partition has goes to the driver (a row for each partition), which says what ranks of
   one partition's pieces go to what ranks of a later partition's gaps. Of several pieces with one successor the one
   with the highest rank gets it.
3. Gaps shrink by what they took. Pieces longer than every gap that is left open new sequences. Repeat with the pieces
   that got none.

A gap that is several times as long as the longest piece offers several places in one superstep, so that many short
pieces do not take a superstep each. Places within a sequence are counted at the end, by windows over its pieces.

The driver sees counts by size (at most 2 * `size` rows) and by partition. A partition's sizes are held by its task.

Defined results: a null or empty text is the end token alone; repeated rows are packed as they come; other columns are
ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

SIZE = 1024
END = 2
#: White space of this length is beyond the stack of the fast encoder's regular expressions.
LONG_BLANK = 4096
_BLANKS = re.compile(r"\s{64,}")
_ENCODERS: dict[str, object] = {}


def encoder(path: str):
    """text -> ids, by the byte-level BPE of a tokenizers file.

    The vocabulary and merges are read from the file and handed to tiktoken, which gives the same ids several times
    faster. As in tokenizers, texts are first split at the added tokens, each of which gives its own id. Texts with
    LONG_BLANK characters of white space in a row go to tokenizers itself.
    """
    if path not in _ENCODERS:
        import json

        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, added = spec["model"]["vocab"], {x["content"]: x["id"] for x in spec.get("added_tokens", ())}
        if any(x[k] for x in spec.get("added_tokens", ()) for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"{path}: added tokens that take in their surroundings are not known here")
        # The printable characters that stand for bytes in such files.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
        ranks = {bytes(byte[c] for c in token): i for token, i in vocab.items() if token not in added}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        ordinary = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        # The longest of those that begin at one place.
        marks = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True))) or r"(?!)")

        slow = Tokenizer.from_file(path)

        def encode(text: str) -> list[int]:
            if len(text) >= LONG_BLANK and any(m.end() - m.start() >= LONG_BLANK for m in _BLANKS.finditer(text)):
                return slow.encode(text, add_special_tokens=False).ids
            out, at = [], 0
            for m in marks.finditer(text):
                out += [*ordinary(text[at : m.start()]), added[m.group()]]
                at = m.end()
            return out + ordinary(text[at:]) if at else ordinary(text)

        _ENCODERS[path] = encode
    return _ENCODERS[path]


def cut(n: int, size: int = SIZE) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens."""
    rest = n % size or size
    return [(0, rest), *((at, size) for at in range(rest, n, size))]


def _pieces(path: str, size: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*encode(text.as_py() or ""), end], "<u4")
                rows += [(doc, k, a, n, zlib.crc32(ids[a : a + n].tobytes())) for k, (a, n) in enumerate(cut(len(ids), size))]
            cols = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, end: int = END) -> DataFrame:
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(_pieces(tokenizer, size, end), "doc_id long, piece int, start long, length long, ids_crc32 long")


PIECE = ("doc_id", "piece", "start", "length", "ids_crc32")
_KINDS = {"doc_id": "long", "piece": "int", "start": "long", "length": "long", "ids_crc32": "long"}
_SWEPT = ", ".join(f"{c} {_KINDS[c]}" for c in PIECE) + ", tie long, seq long, gap boolean, part int, rank long"


def pair(is_gap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pieces, gaps): places in the sweep that belong together; is_gap says of each place what stands there."""
    height = np.cumsum(np.where(is_gap, -1, 1))
    floor = np.minimum.accumulate(np.minimum(height, 0))
    before = np.concatenate([[0], floor[:-1]])
    some = np.flatnonzero(~(is_gap & (height < before)))  # all but the gaps that find no piece
    level = (height - floor + is_gap)[some]
    order = np.argsort(level, kind="stable")
    at, level = some[order], level[order]
    met = ~is_gap[at[:-1]] & is_gap[at[1:]] & (level[:-1] == level[1:])
    return at[:-1][met], at[1:][met]


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range partition, in order -> its pieces, with a sequence where a gap of the partition took them, and its free gaps."""
    t = pa.Table.from_batches(list(batches))
    if not t.num_rows:
        return
    is_gap = t["gap"].combine_chunks().to_numpy(zero_copy_only=False)
    seq = t["seq"].combine_chunks().fill_null(0).to_numpy()
    mine, theirs = pair(is_gap)
    got, known = np.where(is_gap, seq, 0), is_gap.copy()
    got[mine], known[mine] = seq[theirs], True
    free = np.ones(len(is_gap), bool)
    free[mine] = free[theirs] = False
    rank = np.zeros(len(is_gap), np.int64)
    for kind in (True, False):
        at = np.flatnonzero(free & (is_gap == kind))
        rank[at] = np.arange(len(at))
    stay = np.flatnonzero(~is_gap | free)
    part = TaskContext.get().partitionId()
    cols = [t[c].combine_chunks().take(pa.array(stay)) for c in (*PIECE, "tie")]
    cols += [pa.array(got[stay], mask=~known[stay]), pa.array(is_gap[stay]), pa.array(np.full(len(stay), part, np.int32)), pa.array(rank[stay], mask=~free[stay])]
    for b in pa.Table.from_arrays(cols, [*PIECE, "tie", "seq", "gap", "part", "rank"]).to_batches(max_chunksize=65_536):
        yield b


def between(free: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """What free pieces of partitions go to free gaps of later ones.

    free: (partition, gaps, pieces) in order. A run (gap partition, first gap, piece partition, last piece, n) says
    that n gaps from the first one upwards take n pieces from the last one downwards.
    """
    stack: list[list[int]] = []
    runs = []
    for part, gaps, pieces in free:
        at = 0
        while at < gaps and stack:
            top = stack[-1]
            n = min(gaps - at, top[1])
            runs.append((part, at, top[0], top[1] - 1, n))
            at, top[1] = at + n, top[1] - n
            if not top[1]:
                stack.pop()
        if pieces:
            stack.append([part, pieces])
    return runs


def _across(swept: DataFrame) -> DataFrame:
    """The pieces that no gap of their own partition took, with the sequence of a later partition's gap, where there is one."""
    spark = swept.sparkSession
    alone = swept.where("rank is not null")
    free: dict[int, list[int]] = {}
    for r in alone.groupBy("part", "gap").count().collect():
        free.setdefault(r["part"], [0, 0])[0 if r["gap"] else 1] = r["count"]
    runs = between([(p, *free[p]) for p in sorted(free)])
    pieces = alone.where("not gap")
    if not runs:
        return pieces
    ups, downs, base = [], [], 0
    for gap_part, first, part, last, n in runs:
        ups.append((gap_part, first, first + n, base))
        downs.append((part, last - n + 1, last + 1, base + n - 1))
        base += n
    # At most a run for each partition and another for each time a partition is used up.
    table = lambda rows: F.broadcast(spark.createDataFrame(rows, "part int, low long, high long, base long"))
    inside = lambda x, y: (x["part"] == y["part"]) & (x["rank"] >= y["low"]) & (x["rank"] < y["high"])
    up, down, gaps = table(ups), table(downs), alone.where("gap")
    offered = gaps.join(up, inside(gaps, up)).select((up["base"] + gaps["rank"] - up["low"]).alias("meet"), gaps["seq"].alias("seq2"))
    asked = pieces.join(down, inside(pieces, down), "left").select(*(pieces[c] for c in (*PIECE, "tie")), (down["base"] - (pieces["rank"] - down["low"])).alias("meet"))
    return saved(asked.join(offered, "meet", "left").withColumnRenamed("seq2", "seq"))


def place(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """pieces (the columns PIECE) with sequence_id and offset."""
    spark = pieces.sparkSession
    rows = saved(pieces.select(*(F.col(c).cast(k).alias(c) for c, k in _KINDS.items())).withColumn("tie", F.monotonically_increasing_id()))
    full = rows.where(F.col("length") >= size).select(*PIECE, F.col("tie").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    long = rows.where((F.col("length") < size) & (2 * F.col("length") > size)).withColumn("seq", F.col("tie"))
    placed = [long.select(*PIECE, "tie", "seq")]
    gaps = long.select("seq", (size - F.col("length")).alias("room"))
    left = rows.where(2 * F.col("length") <= size)
    opened = 0
    while True:
        sizes = left.select(F.lit(False).alias("gap"), F.col("length").alias("n")).union(gaps.select(F.lit(True), "room"))
        counts = {(r["gap"], r["n"]): r["count"] for r in sizes.groupBy("gap", "n").count().collect()}
        lengths = {n: c for (gap, n), c in counts.items() if not gap}
        if not lengths:
            break
        most, least = max(lengths), min(lengths)
        rooms = {n: c for (gap, n), c in counts.items() if gap and n >= least}
        # Pieces longer than every gap need new sequences, as many as their lengths fill.
        new = -(-sum(n * c for n, c in lengths.items() if n > max(rooms, default=0)) // size)
        fresh = spark.range(new).select((-1 - opened - F.col("id")).alias("seq"), F.lit(size).cast("long").alias("room"))
        opened += new
        gaps = gaps.where(F.col("room") >= least).union(fresh)
        # No more places than twice the pieces, and one for each gap.
        each = max(1, 2 * sum(lengths.values()) // max(1, sum(rooms.values()) + new))
        times = F.greatest(F.lit(1), F.least(F.lit(each), F.floor(F.col("room") / most))).cast("int")
        offers = gaps.select("seq", "room", times.alias("times")).select("seq", F.floor(F.col("room") / F.col("times")).alias("at"), F.explode(F.sequence(F.lit(1), "times")).alias("k"))
        none = [F.lit(None).cast(k).alias(c) for c, k in _KINDS.items()]
        both = left.select(F.col("length").alias("at"), F.lit(False).alias("gap"), F.col("tie"), *PIECE, F.lit(None).cast("long").alias("seq")).union(
            offers.select("at", F.lit(True), F.xxhash64("seq", "k"), *none, "seq")
        )
        order = ("at", "gap", "tie")
        swept = saved(both.repartitionByRange(*order).sortWithinPartitions(*order).select(*PIECE, "tie", "seq", "gap").mapInArrow(_sweep, _SWEPT))
        across = _across(swept)
        now = swept.where("not gap and seq is not null").select(*PIECE, "tie", "seq").union(across.where("seq is not null").select(*PIECE, "tie", "seq"))
        placed.append(now)
        took = now.groupBy("seq").agg(F.sum("length").alias("took"))
        gaps = saved(gaps.join(took, "seq", "left").select("seq", (F.col("room") - F.coalesce("took", F.lit(0))).alias("room")).where("room > 0"))
        left = across.where("seq is null")
    # Every sequence holds `size` pieces at most.
    before = Window.partitionBy("seq").orderBy(F.desc("length"), "tie").rowsBetween(Window.unboundedPreceding, -1)
    shared = reduce(DataFrame.union, placed).select(*PIECE, F.col("seq").alias("sequence_id"), F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"))
    return full.union(shared)


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset for each piece."""
    return place(pieces(docs, tokenizer, id_col, text_col, size, end), size)
