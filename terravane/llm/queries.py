"""The registered queries of the text operators, and their SQL where SQL can say them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, language, packing, ppm, quality_model, quality_rules, secrets, sharding, simhash, substrings, vector_codes, vector_dups, whitening
from .common import shared_folder, table


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents in 11 arrivals (four of a 32nd, seven of an 8th), compacted; every row that the last version holds, with digests of its text and of the row.

    The store is this query's own, so nothing of another writer has to be spared.
    """
    docs = table(spark, sf_dir, "documents")
    store = sharding.Store(spark, f"{shared_folder(spark)}/shards-{uuid.uuid4().hex}")
    part = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(32))
    store.append_by(docs, F.when(part < 4, part).otherwise(4 + F.floor((part - 4) / 4)).cast("int"))
    version = store.compact(docs.schema)
    store.vacuum(spared=0)
    rows = store.read(version, schema=docs.schema)
    row = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in docs.columns))
    return rows.select("doc_id", F.sha2("text", 256).alias("text_sha256"), F.sha2(row, 256).alias("row_sha256"))


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_duplicates(table(spark, sf_dir, "documents"), texts=False).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = quality_rules.apply_policy(quality_rules.ledger(table(spark, sf_dir, "documents")), "v1")
    failed = F.col("fail_bits").bitwiseAND(F.lit(quality_rules.mask("base"))) != 0
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), "kept", "fail_bits")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.occurrences(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op7_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(table(spark, sf_dir, "documents"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learned = language.learn(docs.where(~language.held_out("doc_id")))
    return language.identify(docs, learned)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_model.score(docs, quality_model.learn(docs, table(spark, sf_dir, "labels")))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.encode(table(spark, sf_dir, "embeddings"))


def op12_vector_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dups.near_duplicates(table(spark, sf_dir, "embeddings"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}


def oracle_sql() -> dict[str, str]:
    from .oracles import SQL

    return dict(SQL)
