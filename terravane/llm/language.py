"""Language identification by compression.

For each language a zstandard dictionary of raw content is put together from a bounded sample of labelled texts. A
text, in lower case like the dictionaries, is encoded with every dictionary; the language whose dictionary gives the fewest bytes is chosen. Where the best
two are nearly equal the decision is marked as rejected, and its score is low.

The sample: at most `docs_per_language` training documents of each language, those with the least hash of their id, and
of each an excerpt of `excerpt` characters, which begins at a place set by the text's hash; equal excerpts count once. This bounds what the driver gathers and broadcasts: languages * docs *
excerpt, 128 K characters a language by default. Scoring always reads whole texts.

Defined results: "und" with score 0 for a null text or one without a letter, or if nothing was learned; equal sizes
go to the language with more training documents, then to the first by name; rows with a null id are scored like all
others and never learned from; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DOCS_PER_LANGUAGE = 256
EXCERPT = 512
LEVEL = 6
MARGIN = 2
UNKNOWN = "und"
_CACHE: dict[int, list] = {}


def held_out(id_col: str = "doc_id", n: int = 3, k: int = 1) -> Column:
    """Whether crc32 of the id as text, modulo n, is k; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(n)) == k, F.lit(False))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", docs_per_language: int = DOCS_PER_LANGUAGE, excerpt: int = EXCERPT) -> list[tuple[str, bytes]]:
    """(language, dictionary content), the language with most documents first. docs: training rows only."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(lang_col).count().collect()}
    order = Window.partitionBy("lang").orderBy("at", "doc_id")
    # Every place at which a whole excerpt begins is as likely, so that what documents share at their head is no more than its share.
    begin = F.pmod(F.xxhash64(text_col), F.greatest(F.char_length(text_col) - excerpt, F.lit(0)) + 1) + 1
    some = (
        rows.select(F.col(lang_col).alias("lang"), F.struct(F.xxhash64(F.col(id_col).cast("string")).alias("at"), F.col(id_col).alias("doc_id")).alias("key"), F.substring(F.col(text_col), begin.cast("int"), F.lit(excerpt)).alias("part"))
        .groupBy("lang", "part")
        .agg(F.min("key").alias("key"))
        .select("lang", "key.*", "part")
        .withColumn("rank", F.row_number().over(order))  # Spark keeps only the first ranks of each task before it shuffles
        .where(F.col("rank") <= docs_per_language)
    )
    parts: dict[str, list[str]] = {}
    for r in sorted(some.select("lang", "rank", "part").collect(), key=lambda r: (r["lang"], r["rank"])):
        parts.setdefault(r["lang"], []).append(r["part"])
    return [(x, "\n".join(parts[x]).lower().encode()) for x in sorted(parts, key=lambda x: (-counts[x], x))]


def _compressors(learned: list[tuple[str, bytes]]) -> list:
    import zstandard

    key = hash(tuple(learned))
    if key not in _CACHE:
        made = []
        for lang, content in learned:
            d = zstandard.ZstdCompressionDict(content or b"\n" * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(LEVEL)
            made.append((lang, zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)))
        _CACHE.clear()
        _CACHE[key] = made
    return _CACHE[key]


def classify(text: str | None, compressors: list) -> tuple[str, float, bool]:
    """Language, score and whether the margin is too narrow."""
    if not compressors or not text or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0, True
    data = text.lower().encode()
    sizes = [len(c.compress(data)) for _, c in compressors]
    best = min(range(len(sizes)), key=lambda i: (sizes[i], i))
    # A byte less is eight bits less; a milder base allows for the noise of short texts.
    score = 1 / sum(2.0 ** -min(60, s - sizes[best]) for s in sizes)
    others = [s for i, s in enumerate(sizes) if i != best]
    return compressors[best][0], score, bool(others) and min(others) - sizes[best] < MARGIN


def _predict(learned):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = _compressors(learned.value)
        for b in batches:
            got = [classify(x.as_py(), compressors) for x in b.column(2)]
            lang, score, rejected = zip(*got, strict=True) if got else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    return run


def identify(docs: DataFrame, learned: list[tuple[str, bytes]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected for each row of docs."""
    known = docs.sparkSession.sparkContext.broadcast(learned)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_predict(known), "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")
