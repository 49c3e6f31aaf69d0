"""Quality rules as a ledger of failure bits.

Every rule is evaluated once for each document. The ledger keeps the measurements and one integer whose bit r says
that rule r failed. A policy is a versioned set of rules: applying one, or asking what a rule alone removes, reads the
bits and never the texts again. All of it is built-in expressions within a row; no shuffle is needed but for the
counts of `ablations`.

Defined results: a null or empty text has no words and fails "few_words"; null ids and repeated rows are kept as they
are, one ledger row for each input row; columns of the input other than the id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, whole_text, word_list

SYMBOLS = "#*$%&|<>"
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """A rule fails where its condition over the measurements (by name) holds."""

    name: str
    fails: Callable[[dict[str, Column]], Column]


#: Bit r of the ledger belongs to RULES[r]; add new rules at the end.
RULES = (
    Rule("few_words", lambda m: m["n_words"] < 10),
    Rule("repeated_windows", lambda m: 100 * m["n_repeat_words"] > 20 * m["n_words"]),
    Rule("symbols", lambda m: 10 * m["n_symbols"] > 4 * m["n_words"]),
    Rule("repeated_lines", lambda m: (m["n_lines"] > 3) & (2 * m["n_dup_lines"] > m["n_lines"])),
    Rule("word_length", lambda m: (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 40 * m["n_words"])),
)
BASE_RULES = ("few_words", "repeated_windows")

#: Version of a policy: the rules that reject a document.
POLICIES = {
    "base": BASE_RULES,
    "v1": ("few_words", "repeated_windows", "symbols", "repeated_lines", "word_length"),
}


def mask(policy: str) -> int:
    names = [r.name for r in RULES]
    return sum(1 << names.index(x) for x in POLICIES[policy])


def _repeated_words(words: Column) -> Column:
    """Words inside 5-word windows that the text has twice or more.

    Window hashes say quickly that a text repeats nothing; only where two hashes are equal are the windows themselves
    compared.
    """

    def exact(w: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.struct(F.array_join(F.slice(w, i + 1, WINDOW), " ").alias("k"), i.alias("p"))
        )
        twice = let(
            F.array_sort(windows),
            lambda s: F.filter(s, lambda x, i: (x["k"] == F.get(s, i - 1)["k"]) | (x["k"] == F.get(s, i + 1)["k"])),
        )
        starts = F.array_sort(F.transform(twice, lambda x: x["p"]))
        return let(
            starts,
            lambda p: F.aggregate(
                F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))),
                F.lit(0),
                lambda a, x: a + x,
            ),
        )

    def windowed(w: Column) -> Column:
        hashes = let(
            F.transform(w, lambda x: F.xxhash64(x)),
            lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(WINDOW)))),
        )
        return let(hashes, lambda h: F.size(h) > F.size(F.array_distinct(h)))

    return F.when(F.size(words) <= WINDOW, F.lit(0)).when(windowed(words), exact(words)).otherwise(F.lit(0))


def _measure(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = let(word_list(text), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeated_words(w).cast("long").alias("n_repeat_words")))
    counted_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    spaces = " \t\n\x0b\f\r"
    chars = F.struct(
        F.char_length(F.translate(text, spaces, "")).cast("long").alias("word_chars"),
        (F.octet_length(text) - F.octet_length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    return F.struct(counted.alias("words"), counted_lines.alias("lines"), chars.alias("chars"))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
_PART = {"n_words": "words", "n_repeat_words": "words", "n_lines": "lines", "n_dup_lines": "lines", "word_chars": "chars", "n_symbols": "chars"}
_TAG = "__terravane_measures"


def fail_bits(m: dict[str, Column]) -> Column:
    """The bits of all rules over the measurements m."""
    return sum((F.when(r.fails(m), F.lit(1 << i)).otherwise(F.lit(0)) for i, r in enumerate(RULES)), F.lit(0)).cast("long")


def _measured(docs: DataFrame, text_col: str) -> tuple[DataFrame, dict[str, Column]]:
    marked = docs.withColumn(_TAG, _measure(whole_text(text_col)))
    return marked, {x: F.col(f"{_TAG}.{_PART[x]}.{x}") for x in MEASURES}


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: the id, MEASURES and fail_bits.

    >>> kept = apply_policy(ledger(docs), "v1").where("kept")
    """
    marked, m = _measured(docs.select(id_col, text_col), text_col)
    return marked.select(id_col, *(m[x].alias(x) for x in MEASURES), fail_bits(m).alias("fail_bits"))


def _passes(bits: Column, policy: str) -> Column:
    return bits.bitwiseAND(F.lit(mask(policy))) == 0


def apply_policy(led: DataFrame, policy: str = "v1") -> DataFrame:
    """The ledger with kept: no rule of the policy failed."""
    return led.withColumn("kept", _passes(F.col("fail_bits"), policy))


def ablations(led: DataFrame, policy: str = "v1") -> DataFrame:
    """For each rule of a policy: documents that fail it, and those that only it rejects.

    The ledger is first counted by its bits (at most 2 ** len(RULES) groups), so nothing but these counts is shuffled.
    """
    full = mask(policy)
    by_bits = led.groupBy((F.col("fail_bits").bitwiseAND(F.lit(full))).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rules = [r for r in enumerate(RULES) if full >> r[0] & 1]
    each = F.explode(F.array(*(F.struct(F.lit(r.name).alias("rule"), F.lit(1 << i).cast("long").alias("bit")) for i, r in rules)))
    return (
        by_bits.select("bits", "n", each.alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum("n").alias("n_docs"),
            F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only"),
            F.bit_or("bits").alias("any_bits"),
        )
        .withColumn("policy", F.lit(policy))
    )


def keep_good(docs: DataFrame, policy: str = "v1", text_col: str = "text") -> DataFrame:
    """The rows of docs whose failure bits the policy lets pass, with their columns as they are."""
    marked, m = _measured(docs, text_col)
    return marked.where(_passes(fail_bits(m), policy)).select(*(F.col(f"`{c}`") for c in docs.columns))
