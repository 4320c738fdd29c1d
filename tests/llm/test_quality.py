"""Rules, classifier and shards."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from itertools import combinations, product

import numpy as np
import pytest
from conftest import SF_DIR
from helpers import LONG, awkward, empty, plain_words, table
from pyspark.sql import functions as F

from docketworks.llm import factorization, hilbert, likelihood
from docketworks.llm.queries import QUERIES
from docketworks.llm.zone_clusters import hilbert_keys
from docketworks.session import Sizing

LABELS = "doc_id long, quality int, toxic int"


# -- rules -----------------------------------------------------------------------


def plain_counts(text):
    text = text or ""
    words = plain_words(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    lines = [x for x in text.split("\n") if plain_words(x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered), failed)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_counts_of_the_tables(spark):
    rows = QUERIES["op7_likelihood_rules"](spark, SF_DIR).collect()
    assert {r["doc_id"]: tuple(r[c] for c in COUNTS) for r in rows} == {
        d: plain_counts(t) for d, t in table(SF_DIR, "documents", "doc_id", "text")
    }
    quality = dict(table(SF_DIR, "labels", "doc_id", "quality"))
    kept = {r["doc_id"]: r["kept"] for r in rows if not r["base_failed"]}
    assert all(kept[d] for d in kept if quality.get(d) == 1)
    bad = [kept[d] for d in kept if quality.get(d) == 0]
    assert sum(bad) <= 0.2 * len(bad)


def test_counts_of_awkward_texts(spark, scratch):
    texts = ["a b c a b c", "a a a a", "x\n\nx\n \nx y\nx", "#|<>&%$*\t\x0b\x0c\r\n", "\x1c \xa0", "a b c d a b c", None, "", LONG,
             "p q r " * 40, "\n".join(["same line"] * 30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = likelihood.with_counts(docs).withColumn("base_failed", likelihood.base_failed()).collect()
    assert {r["doc_id"]: tuple(r[c] for c in COUNTS) for r in rows} == {
        i: plain_counts(t) for i, t in enumerate(texts)
    }
    judged = likelihood.judge(awkward(spark), spark.createDataFrame([(6, 1, 0), (None, 1, 0), (7, None, 0)], LABELS), scratch,
                              keep=("doc_id", "lang"))
    assert judged.count() == 12
    assert [r["kept"] for r in judged.filter("n_words = 0").collect()] == [False] * 4


@pytest.mark.parametrize("place_bits", [0, 52, 58, 61])
def test_repeated_words_are_exact_however_few_bits_the_first_sort_has(spark, place_bits):
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{i}" for i in range(900)), " ".join(f"v{i}" for i in rng.integers(0, 12, 700)),
             " ".join(f"u{i % 150}" for i in range(400)), "a b c a b c", "a a", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = likelihood.with_counts(docs, place_bits).select("doc_id", "n_repeat_words").collect()
    assert dict(rows) == {i: plain_counts(t)[4] for i, t in enumerate(texts)}


def test_log_ratios_are_those_of_the_two_counts(spark):
    docs = spark.createDataFrame([(1, "a b a", True), (2, "c", False), (3, None, False)], "doc_id long, text string, _trusted boolean")
    weights = likelihood.log_ratios(docs, 1 << 12)
    grams = docs.select(F.explode(likelihood.buckets("w", 1 << 12)).alias("b")) if "w" in docs.columns else None
    assert grams is None and len(weights) == 1 << 12
    size = 1 << 12
    # five n-grams are trusted (two of them equal), one more is not
    neutral = round(1000 * np.log((6 + size) / (5 + size)))
    assert Counter(weights)[neutral] == size - 1 and min(weights) == round(1000 * np.log(0.5 * (6 + size) / (5 + size)))


def test_without_trusted_documents_the_base_rules_decide(spark, scratch):
    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(60))), (2, "few")], "doc_id long, text string")
    rows = likelihood.judge(docs, spark.createDataFrame([], LABELS), scratch).collect()
    assert {r["doc_id"]: r["kept"] for r in rows} == {1: True, 2: False}
    nothing = likelihood.judge(docs.limit(0), spark.createDataFrame([(1, 1, 0)], LABELS), scratch)
    assert nothing.collect() == []


def test_the_threshold_leaves_a_stated_share_below(spark):
    scored = spark.createDataFrame([(i,) for i in range(1000)] + [(None,)], "score_steps long")
    assert likelihood.threshold(scored, 0.002) == 2
    assert likelihood.threshold(scored, 0) == 0


# -- classifier ------------------------------------------------------------------


def test_the_identity_equals_the_sum_over_pairs():
    rng = np.random.default_rng(2)
    model = factorization.Model(rng.normal(size=30), rng.normal(size=(30, 4)))
    which, values = np.array([3, 7, 7 + 9, 29]), rng.normal(size=4)
    pairs = sum(model.factors[a] @ model.factors[b] * x * y
                for (a, x), (b, y) in combinations(zip(which, values), 2))
    assert model.margins(which, values, np.array([0]))[0] == pytest.approx(model.weights[which] @ values + pairs)


def test_held_out_labels_are_not_learnt_and_are_met(spark):
    sf_dir = SF_DIR.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = factorization.train(docs, labels)
    turned = labels.withColumn("quality", F.when(factorization.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = factorization.train(docs, turned)
    assert (model.weights == again.weights).all() and (model.factors == again.factors).all()
    rows = factorization.score(docs.select("doc_id", "text", "n_chars"), model).join(labels, "doc_id").collect()
    outside = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    right = [(r["score"] >= 0.5) == (r["quality"] == 1) for r in outside]
    assert len(right) > 80 and sum(right) >= 0.97 * len(right)


def test_scores_of_awkward_rows(spark):
    labels = spark.createDataFrame([(6, 1, 0), (8, 0, 0), (8, 1, 0), (None, 1, 0), (4, None, 1)], LABELS)
    docs = awkward(spark).drop("score")
    model = factorization.train(docs, labels)
    rows = factorization.score(docs, model).collect()
    assert len(rows) == 12 and all(0 <= r["score"] <= 1 for r in rows)
    assert rows[0].asDict().keys() - {"score"} == set(docs.columns)
    assert factorization.score(empty(spark).drop("score"), model).collect() == []
    untrained = factorization.train(docs, labels.limit(0))
    assert {r["score"] for r in factorization.score(docs.select("text"), untrained).collect()} == {0.5}


# -- shards ----------------------------------------------------------------------


@pytest.mark.parametrize("dimensions, bits", [(2, 3), (3, 2), (4, 2), (1, 4)])
def test_neighbours_on_the_curve_are_neighbours_in_the_grid(spark, dimensions, bits):
    names = [f"c{i}" for i in range(dimensions)]
    cells = list(product(range(1 << bits), repeat=dimensions))
    frame = spark.createDataFrame(cells, ", ".join(f"{n} long" for n in names))
    rows = hilbert.with_curve(frame, {n: F.col(n) for n in names}, bits, "h").orderBy("h").collect()
    assert [r["h"] for r in rows] == list(range(len(cells)))
    for a, b in zip(rows, rows[1:]):
        assert sum(abs(a[n] - b[n]) for n in names) == 1


def test_size_cells_follow_the_size(spark):
    sizes = [8, 9, 10, 12, 16, 20, 31, 32, 1000, 10**6, 10**12]
    rows = spark.createDataFrame([(s,) for s in sizes], "s long").select("s", hilbert.of_size(F.col("s")).alias("c")).orderBy("s").collect()
    cells = [r["c"] for r in rows]
    assert cells == sorted(cells) and min(cells) >= 0 and max(cells) <= 63 and len(set(cells)) >= 9


@pytest.mark.parametrize("sizing", [Sizing(), Sizing(numbering_rows=50)])
def test_shards_of_the_tables(spark, scratch, sizing):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = hilbert.shard(docs, scratch, sizing=sizing).collect()
    source = {d: (t or "").encode() for d, t in table(SF_DIR, "documents", "doc_id", "text")}
    assert len(rows) == len(source)
    assert all(r["size"] == len(source[r["doc_id"]]) + 8 and r["text_crc32"] == zlib.crc32(source[r["doc_id"]]) for r in rows)
    counts = Counter(r["shard"] for r in rows)
    assert set(counts) == set(range(24)) and max(counts.values()) - min(counts.values()) <= 1
    for shard, count in counts.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(count))
    order = [r["curve"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))]
    assert order == sorted(order)


def test_slices_give_the_shards_of_one_window(spark, scratch):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    one, other = (
        sorted((r["doc_id"], r["shard"], r["slot"]) for r in hilbert.shard(docs, scratch, sizing=s).collect())
        for s in (Sizing(), Sizing(numbering_rows=30))
    )
    assert one == other


def test_shards_of_awkward_rows(spark, scratch):
    rows = hilbert.shard(awkward(spark), scratch, keep=("kept",)).collect()
    assert len(rows) == 12 and all(r["slot"] == 0 for r in rows) and len({r["shard"] for r in rows}) == 12
    assert hilbert.shard(empty(spark), scratch).collect() == []


def test_score_query_is_the_plain_sum_over_all_pairs(spark):
    rows = table(SF_DIR, "documents", "doc_id", "text", "n_chars")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "n_chars")
    model = factorization.train(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    found = {r["doc_id"]: r for r in QUERIES["op6_factorization"](spark, SF_DIR).collect()}
    assert len(found) == len(rows)
    for doc_id, text, recorded in rows:
        which, values = factorization.inputs(text, recorded)
        values = values.astype(np.float64)
        scaled = model.factors[which] * values[:, None]
        pairs = np.triu(scaled @ scaled.T, 1).sum()
        score = 1 / (1 + np.exp(-np.clip((model.weights[which] * values).sum() + pairs, -500, 500)))
        assert abs(found[doc_id]["score"] - score) < 1e-6
        assert found[doc_id]["predicted"] == int(found[doc_id]["score"] >= 0.5)
        assert found[doc_id]["held_out"] == (zlib.crc32(str(doc_id).encode()) % 3 == 1)


def test_shard_query_against_a_plain_curve(spark):
    rows = table(SF_DIR, "documents", "doc_id", "text", "lang", "source")
    found = {r["doc_id"]: r for r in QUERIES["op4_hilbert_shards"](spark, SF_DIR).collect()}

    def category(value):
        return zlib.crc32(("" if value is None else f"={value}").encode()) >> 26

    def size_cell(size):
        width = size.bit_length()
        return min(4 * width + (size * 4 >> (width - 1)) - 8, 63)

    sizes = {i: len((t or "").encode()) + 8 for i, t, _, _ in rows}
    cells = np.array([[category(lang), category(source), size_cell(sizes[i])] for i, _, lang, source in rows])
    places = []
    for key in hilbert_keys(cells, 6):  # three bits of each byte, the highest first
        place = 0
        for level in key:
            place = place * 8 + (level >> 5)
        places.append(place)
    order = sorted(range(len(rows)), key=lambda n: (places[n], rows[n][0]))
    per_shard = Counter()
    for number, n in enumerate(order):
        r = found[rows[n][0]]
        assert r["curve"] == places[n] and r["size"] == sizes[rows[n][0]]
        assert r["text_crc32"] == zlib.crc32((rows[n][1] or "").encode())
        assert r["shard"] == number * 24 // len(rows) and r["slot"] == per_shard[r["shard"]]
        per_shard[r["shard"]] += 1
    assert max(per_shard.values()) - min(per_shard.values()) <= 1 and len(per_shard) == 24
