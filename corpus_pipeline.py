"""The stages of a training corpus, from raw documents to packed sequences.

Each stage reads what its predecessor kept and returns the columns of ``documents``, but for the
last, which returns the pieces of the sequences. Between stages the rows are written as Parquet.

Rows without an id pass every stage by their text alone and are never taken for duplicates; of rows
that repeat an id and a text, the near-duplicate stage keeps one. Columns that the stages do not know, also such
with names that operators use, are carried along. An empty table gives empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketworks.llm import decontaminate, factorization, likelihood, minhash, packing
from docketworks.llm.queries import PACK_END, WORD_TOKENS, vocabulary
from docketworks.llm.tables import read, restore, set_aside
from docketworks.operators.dense_keys import add_dense_key
from docketworks.sources.scratch import Scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood ratio."""
    used = ["doc_id", "text"]
    judged = likelihood.judge(
        set_aside(docs, used), read(spark, sf_dir, "labels"), Scratch(spark), keep=[*used, "_rest"]
    )
    return restore(judged.filter("kept"), docs.columns, used)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine scores as good."""
    used = [c for c in ("doc_id", "text", "n_chars") if c in docs.columns]
    aside = set_aside(docs, used)
    scored = factorization.score(aside, factorization.train(aside, read(spark, sf_dir, "labels")))
    return restore(scored.filter(F.col("score") >= factorization.GOOD), docs.columns, used)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates, linked at a similarity of 0.85 or more as in op3.

    If ids repeat, every text of an id is a document of its own; of rows equal in both, one is kept.
    """
    repeated = docs.groupBy("doc_id").count().filter("doc_id IS NOT NULL AND count > 1").select("doc_id")
    if repeated.isEmpty():  # as it should be; the texts then are joined once
        dropped = minhash.near_duplicates(docs, Scratch(spark)).filter("NOT kept").select("doc_id").distinct()
        return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
    # numbered in the order of ids, so that the smallest id is kept as without repeated ones
    used = ["doc_id", "text"]
    rows = set_aside(docs, used).withColumn("_hash", F.xxhash64("text"))
    keys = add_dense_key(
        rows.filter("doc_id IS NOT NULL").select("doc_id", "_hash").distinct(), "_key", ["doc_id", "_hash"], Scratch(spark)
    )
    keyed = Scratch(spark).stage(rows.join(keys, ["doc_id", "_hash"], "left"), "keyed")
    found = minhash.near_duplicates(keyed.select(F.col("_key").alias("doc_id"), "text"), Scratch(spark))
    dropped = found.filter("NOT kept").select(F.col("doc_id").alias("_key")).distinct()
    kept = keyed.join(dropped, "_key", "left_anti")
    once = kept.filter("_key IS NOT NULL").dropDuplicates(["_key"])
    return restore(kept.filter("_key IS NULL").unionByName(once), docs.columns, used)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"), Scratch(spark))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of 2,048 ids."""
    return packing.pack(docs, vocabulary(WORD_TOKENS), PACK_END, Scratch(spark)).select(
        "doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packed),
]

#: Hashed models, tokenizer ids and packing order are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    scratch = Scratch(spark)
    rows = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        rows = scratch.stage(stage(spark, rows, sf_dir), name)
    return rows
