"""Scores of texts by prediction by partial matching, and by word frequencies.

The trie holds contexts of `order`, `order` - 1, ... and no bytes with the counts of the bytes that follow, gathered
from the training texts. A byte is predicted in its longest known context; one not seen there costs an escape (method
C: as likely as the context has different followers) and is predicted in the next shorter context, from which the
symbols of the longer one are excluded; last comes an even choice of what is left. Texts are in lower case (A-Z only),
begin in the context of `order` boundary marks and end with one. The counts are learned first and fixed then (a
pretrained code).

The trie is a set of Spark tables, one for each level, keyed by context and symbol as one number. Tasks count the
distinct ones of a piece of text before anything is shuffled. As the counts are fixed, the probability of a symbol after
its context is one number for the whole corpus; a walk down the levels by joins gives it for every pair that
stands anywhere. Both tables grow with the corpus. A bounded list of the commonest pairs (`listed`) goes to all tasks,
which sum these themselves; documents meet all other pairs in a join. What is on the list changes no result.

The word score is an add-one unigram model over the tokens of all training texts, done in the same way: frequent tokens
(drawn from a sample, at most `frequent`) are counted as an array, all others are joined. Tokens are told apart by a 64-bit
hash. Rows of the documents are told apart by a number that is saved with them.

Defined results: a null or empty text is its end token alone; rows with a null id are training rows; repeated rows
count as often as they stand there; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import numbered, saved
from .language import held_out

ORDER = 4
FREQUENT = 65_536
LISTED = 1 << 18
SAMPLE_DOCS = 4_000
PIECE = 4 << 20
CHUNK = 1 << 20
ROW = "__terravane_row"
#: UTF-8 has no byte 255: it is the boundary of a text.
EDGE = 255
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
TOKEN = W.table(lambda b: 0 if b == 32 or 9 <= b <= 13 else (int(LOWER[b]) or 255))


def codes(texts: pa.Array, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For every byte and the end of every text: context and symbol as one number, and the text; chunk by chunk."""
    if not 0 <= order <= 6:
        raise ValueError("a context and its symbol have to fit into a long: order is 0 to 6")
    data, ends = W.flat(texts)
    sizes, pad = np.diff(ends), order + 1
    line = np.full(len(data) + pad * len(sizes), EDGE, np.uint8)
    if len(data):
        line[np.arange(len(data)) + np.repeat(pad * np.arange(len(sizes)) + order, sizes)] = LOWER[data]
    doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes + pad)
    # The first `order` marks of a text are no symbols.
    real = np.ones(len(line), bool)
    begins = ends[1:-1] + pad * np.arange(1, len(sizes))
    for i in range(1, pad):
        real[begins - i] = False
    for a in range(0, len(line) - order, CHUNK):
        b = min(a + CHUNK, len(line) - order)
        code = np.zeros(b - a, np.int64)
        for i in range(pad):
            code <<= 8
            code |= line[a + i : b + i]
        some = real[a:b]
        yield code[some], doc[a:b][some]


def _grams(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x, y in W.pieces(b.column(1), PIECE):
                part = b.slice(x, y - x)
                train = part.column(0).to_numpy(zero_copy_only=False).astype(bool)
                for code, doc in codes(part.column(1), order):
                    learned = train[doc]
                    u, n = np.unique(code[learned], return_counts=True)
                    v = np.unique(code[~learned])
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([u, v])), pa.array(np.concatenate([n, np.zeros(len(v), n.dtype)]))], ["code", "n"])

    return run


def grams(rows: DataFrame, order: int = ORDER) -> DataFrame:
    """code (context and symbol) and n (how often training texts have it, maybe 0) of all that rows (train, text) hold."""
    return rows.select("train", "text").mapInArrow(_grams(order), "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def log_table(pairs: DataFrame, order: int = ORDER) -> DataFrame:
    """code, n and lp (log10 of the symbol's probability in its context) for the pairs of grams()."""

    def small(level: int, df: DataFrame) -> DataFrame:
        """Tables keyed by at most two bytes have at most 65,536 rows."""
        return F.broadcast(df) if level <= 2 else df

    ending = lambda n: F.col("code").bitwiseAND(F.lit((1 << 8 * n) - 1))
    level = {order: saved(pairs.where("n > 0"))}
    for j in range(order - 1, -1, -1):
        level[j] = saved(level[j + 1].groupBy(ending(j + 1).alias("code")).agg(F.sum("n").alias("n")))
    now = pairs.select("code", F.col("n").alias("n"), F.lit(0.0).alias("lp"), F.lit(False).alias("done"), F.lit(0).cast("long").alias("gone"), F.lit(0).cast("long").alias("gone_kinds"))
    for j in range(order, -1, -1):
        # Of each context: all that follow it, how many kinds, and how often these follow the next shorter context.
        under = level[j].select("code", "n", F.shiftright("code", 8).alias("context"), ending(j).alias("shorter"))
        if j:
            under = under.join(small(j, level[j - 1].select(F.col("code").alias("shorter"), F.col("n").alias("below"))), "shorter")
        else:
            under = under.withColumn("below", F.lit(0))
        nodes = under.groupBy("context").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"), F.sum("below").alias("below"))
        here = level[j].select(F.col("code").alias("here"), F.col("n").alias("seen"))
        now = now.withColumn("here", ending(j + 1)).withColumn("context", F.shiftright(ending(j + 1), 8))
        now = now.join(small(j + 1, here), "here", "left").join(small(j, nodes), "context", "left")
        total = F.coalesce("total", F.lit(0)) - F.col("gone")
        kinds = F.coalesce("kinds", F.lit(0)) - F.col("gone_kinds")
        # Where nothing is left in this context, the escape is sure.
        step = F.when(F.col("done") | (total + kinds == 0), 0.0).otherwise(F.log10(F.coalesce("seen", kinds) / (total + kinds)))
        now = now.select(
            "code",
            "n",
            (F.col("lp") + step).alias("lp"),
            (F.col("done") | F.col("seen").isNotNull()).alias("done"),
            F.coalesce("below", F.lit(0)).alias("gone"),
            (F.coalesce("kinds", F.lit(0)) if j else F.greatest(F.lit(1), 256 - F.coalesce("kinds", F.lit(0)))).alias("gone_kinds"),
        )
    return now.select("code", "n", F.when(F.col("done"), F.col("lp")).otherwise(F.col("lp") - F.log10("gone_kinds")).alias("lp"))


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes, the text of each, and how many each text has."""
    data, ends = W.flat(texts)
    mapped = TOKEN[data]
    s, e, first = W.spans(mapped, ends)
    n = np.diff(first)
    return W.hashes(mapped, s, e).view(np.int64), np.repeat(np.arange(len(n)), n), n


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for x, y in W.pieces(b.column(0), PIECE):
            h, _, _ = _tokens(b.column(0).slice(x, y - x))
            u, n = np.unique(h, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(n, pa.int64())], ["h", "n"])


def _place(known: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(known, h)
    at[at == len(known)] = 0
    return at, known[at] == h if len(known) else np.zeros(len(h), bool)


def _learned(frequent):
    """Counts of training tokens: (place on the list, true, n) of those on it, (hash, false, n) of the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = frequent.value
        for b in batches:
            for x, y in W.pieces(b.column(0), PIECE):
                h, _, _ = _tokens(b.column(0).slice(x, y - x))
                u, n = np.unique(h, return_counts=True)
                at, there = _place(known, u)
                yield pa.RecordBatch.from_arrays([pa.array(np.where(there, at, u)), pa.array(there), pa.array(n, pa.int64())], ["h", "listed", "n"])

    return run


def _distinct(doc: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, value and count of the distinct values of each text."""
    order = np.lexsort((x, doc))
    doc, x = doc[order], x[order]
    heads = np.flatnonzero(np.concatenate([[True], (np.diff(doc) != 0) | (x[1:] != x[:-1])])) if len(x) else np.zeros(0, np.int64)
    return doc[heads], x[heads], np.diff(np.append(heads, len(x)))


class Listed:
    """Codes and their values in an open table with one place for each hash; a code whose place is taken is not on it."""

    def __init__(self, code: np.ndarray, value: np.ndarray):
        self.shift = np.uint64(64 - max(4, (8 * len(code)).bit_length()))
        size = 1 << (64 - int(self.shift))
        self.code, self.value = np.full(size, -1, np.int64), np.zeros(size)
        place, first = np.unique(self._at(code), return_index=True)
        self.code[place], self.value[place] = code[first], value[first]

    def _at(self, code: np.ndarray) -> np.ndarray:
        return (code.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).view(np.int64)

    def get(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which codes are on it, and the values of all (0 if not)."""
        at = self._at(code)
        there = self.code[at] == code
        return there, np.where(there, self.value[at], 0.0)


def _rare(lists, order: int):
    """Rows (h, gram, row, n, 0) of what is on no list: tokens, and pairs of context and symbol.

    Besides, a row (row, null, row, 0, bits) for each text, with its sum over the pairs on the list.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, code, lp = lists.value
        listed = Listed(code, lp)
        for b in batches:
            for x, y in W.pieces(b.column(1), PIECE):
                part = b.slice(x, y - x)
                h, doc, _ = _tokens(part.column(1))
                new = ~_place(known, h)[1]
                found = [(False, *_distinct(doc[new], h[new]))]
                bits = np.zeros(y - x)
                for code, doc in codes(part.column(1), order):
                    there, value = listed.get(code)
                    bits += np.bincount(doc, weights=value, minlength=y - x)
                    found.append((True, *_distinct(doc[~there], code[~there])))
                none = np.zeros(y - x, np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.nulls(y - x, pa.bool_()), part.column(0), pa.array(none), pa.array(bits)], ["h", "gram", ROW, "n", "bits"])
                for gram, doc, h, n in found:
                    if len(h):
                        yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(np.full(len(h), gram)), part.column(0).take(pa.array(doc)), pa.array(n, pa.int64()), pa.array(np.zeros(len(h)))], ["h", "gram", ROW, "n", "bits"])

    return run


def _scored(frequent, counted):
    """The token sums of each text over what is on the list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, _, _ = frequent.value
        counts, end = counted.value
        part_log = np.log10(counts + 1.0)
        for b in batches:
            for x, y in W.pieces(b.column(3), PIECE):
                part = b.slice(x, y - x)
                h, doc, n_words = _tokens(part.column(3))
                at, there = _place(known, h)
                sums = np.bincount(doc[there], weights=part_log[at[there]], minlength=y - x) + math.log10(end + 1)
                seen = np.bincount(doc[there], weights=counts[at[there]] > 0, minlength=y - x) + (end > 0)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array(n_words + 1, pa.int64()), pa.array(seen.astype(np.int64)), pa.array(sums)], [ROW, "doc_id", "train", "n_tokens", "known", "log_sum"])

    return run


def commonest(table: DataFrame, most: int) -> DataFrame:
    """At most `most` rows of table, those with the greatest n: all from the least eighth of a power of two on that has no more.

    Only counts by eighths of powers (some hundreds of rows) go to the driver to find it.
    """
    step = F.floor(8 * F.log2(F.col("n") + 1))
    counts = sorted(((r["step"], r["count"]) for r in table.groupBy(step.alias("step")).count().collect()), reverse=True)
    cut, have = math.inf, 0
    for k, n in counts:
        if (have := have + n) > most:
            break
        cut = k
    return table.where(step >= cut) if cut < math.inf else table.limit(0)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, frequent: int = FREQUENT, listed: int = LISTED, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score for each row of docs.

    Learned from the rows whose crc32 of the id, modulo 7, is not 2.
    """
    sc = docs.sparkSession.sparkContext
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = numbered(docs.select(F.col(id_col).cast("long").alias("doc_id"), (~held_out(id_col, 7, 2)).alias("train"), text.alias("text")), ROW)
    n_rows, n_train = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("train").cast("long")), F.lit(0))).first()
    # Context and symbol.
    table = saved(log_table(saved(grams(rows, order)), order))
    top = commonest(table, listed).toPandas().sort_values(["n", "code"], ascending=[False, True])
    # Tokens.
    some = rows.where(F.pmod(F.xxhash64(ROW), F.lit(1 << 30)) < int(min(1.0, sample_docs / max(1, n_rows)) * (1 << 30))).select("text")
    often = some.mapInArrow(_sampled, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "h").limit(frequent).toPandas()
    known = np.sort(often["h"].to_numpy(np.int64))
    tokens = rows.where("train").select("text").mapInArrow(_learned(sc.broadcast(known)), "h long, listed boolean, n long")
    learned = saved(tokens.groupBy("h", "listed").agg(F.sum("n").alias("n")))
    hot = learned.where("listed").toPandas()
    counts = np.zeros(max(1, len(known)), np.int64)
    counts[hot["h"].to_numpy(np.int64)] = hot["n"].to_numpy(np.int64)
    n_kinds, n_tokens = learned.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    total, kinds = int(n_tokens + n_train), int(n_kinds + (n_train > 0))
    # Tokens that training never saw add nothing but the constant.
    lists = sc.broadcast((known, top["code"].to_numpy(np.int64), top["lp"].to_numpy(np.float64)))
    values = learned.where("not listed").select("h", F.lit(False).alias("gram"), F.log10(F.col("n") + 1).alias("v")).union(table.select("code", F.lit(True), "lp"))
    # Sums over what is listed take part in the join, at keys of their own that meet nothing.
    rare = rows.select(ROW, "text").mapInArrow(_rare(lists, order), f"h long, gram boolean, {ROW} long, n long, bits double").join(values, ["h", "gram"], "left")
    gram, word, v = F.col("gram"), ~F.col("gram"), F.col("n") * F.col("v")
    by_row = rare.groupBy(ROW).agg(F.sum(F.when(word, v)).alias("rare_log"), F.sum(F.when(word & F.col("v").isNotNull(), F.col("n"))).alias("rare_known"), F.sum(F.when(gram, v).otherwise(F.col("bits"))).alias("score"))
    schema = f"{ROW} long, doc_id long, train boolean, n_tokens long, known long, log_sum double"
    each = rows.select(ROW, "doc_id", "train", "text").mapInArrow(_scored(lists, sc.broadcast((counts, int(n_train)))), schema)
    out = each.join(by_row, ROW)
    base = F.col("log_sum") + F.coalesce("rare_log", F.lit(0.0)) - F.col("n_tokens") * math.log10(total + kinds + 1)
    return out.select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"), "score"
    )
