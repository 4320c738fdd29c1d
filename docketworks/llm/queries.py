"""One query per operator, over whole tables, with the columns that its contract names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketworks.llm import (
    decontaminate, factorization, hilbert, languages, likelihood, main_text, minhash, packing, phrases,
    prefix_counts, records, warc, zone_clusters,
)
from docketworks.llm.sql import SQL
from docketworks.llm.tables import read
from docketworks.sources.scratch import Scratch

WORD_TOKENS = "word_bpe_49k.json"
BYTE_TOKENS = "byte_bpe_50k.json"
PACK_END, RECORD_END = 1, 2
TOKEN_LIMIT = 1024


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(
        read(spark, sf_dir, "documents"), vocabulary(WORD_TOKENS), PACK_END, Scratch(spark)
    )
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), Scratch(spark)
    ).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"), Scratch(spark))


def op4_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = hilbert.shard(read(spark, sf_dir, "documents"), Scratch(spark))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve",
    )


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = main_text.extract(read(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))


def op6_factorization(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    model = factorization.train(docs, read(spark, sf_dir, "labels"))
    return factorization.score(docs, model).select(
        "doc_id", factorization.held_out().alias("held_out"), "score",
        (F.col("score") >= factorization.GOOD).cast("int").alias("predicted"),
    )


def op7_likelihood_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return likelihood.judge(docs, read(spark, sf_dir, "labels"), Scratch(spark)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "score_steps",
    )


def op8_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = records.write_records(
        read(spark, sf_dir, "documents"), vocabulary(WORD_TOKENS), RECORD_END, Scratch(spark)
    )
    return records.read_records(manifest).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op9_prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = prefix_counts.count_prefixes(
        read(spark, sf_dir, "documents"), vocabulary(BYTE_TOKENS), TOKEN_LIMIT
    )
    return counted.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"),
        "fitting_chars",
    )


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archives(read(spark, sf_dir, "pages"), Scratch(spark))
    return warc.read_archives(index).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op11_zone_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_clusters.cluster(read(spark, sf_dir, "embeddings"), Scratch(spark))


def op12_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = read(spark, sf_dir, "documents").select("doc_id", "text", "lang"), Scratch(spark)
    found = languages.identify(docs, languages.train(docs, scratch), scratch)
    return found.select("doc_id", languages.held_out().alias("held_out"), "lang_pred", "score")


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents"), Scratch(spark))


__all__ = ["QUERIES", "SQL"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_decontamination": op2_decontamination,
    "op3_minhash": op3_minhash,
    "op4_hilbert_shards": op4_hilbert_shards,
    "op5_main_text": op5_main_text,
    "op6_factorization": op6_factorization,
    "op7_likelihood_rules": op7_likelihood_rules,
    "op8_binary_records": op8_binary_records,
    "op9_prefix_counts": op9_prefix_counts,
    "op10_warc": op10_warc,
    "op11_zone_clusters": op11_zone_clusters,
    "op12_languages": op12_languages,
    "op13_phrases": op13_phrases,
}
