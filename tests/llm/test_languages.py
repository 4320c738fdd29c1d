from __future__ import annotations

import math
import unicodedata
import zlib
from collections import Counter

import pytest
from conftest import SF_DIR
from helpers import awkward, empty, table

from docketworks.llm import languages
from docketworks.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string"


def held_out(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def grams(text):
    """Buckets of all n-grams, letter by letter in Python integers."""
    letters = [c if unicodedata.category(c)[0] in "LM" else " " for c in (text or "").lower()]
    if not any(unicodedata.category(c)[0] == "L" for c in letters):
        return []
    word = " " + " ".join("".join(letters).split(" ")) + " "
    while "  " in word:
        word = word.replace("  ", " ")
    found, whole = [], (1 << 64) - 1
    for order in languages.ORDERS:
        for i in range(len(word) - order + 1):
            mixed = order
            for c in word[i:i + order]:
                mixed = ((mixed ^ ord(c)) * int(languages.FACTOR)) & whole
                mixed ^= mixed >> 29
            found.append((mixed * int(languages.FACTOR) & whole) >> (64 - languages.BUCKET_BITS))
    return found


def plain(rows):
    counts, texts = {}, Counter()
    for doc_id, text, lang in rows:
        if doc_id is not None and lang is not None and not held_out(doc_id) and (mine := grams(text)):
            counts.setdefault(lang, Counter()).update(mine)
            texts[lang] += 1
    found = []
    for doc_id, text, _ in rows:
        mine, sums = Counter(grams(text)), {}
        for lang in sorted(counts):
            whole = sum(counts[lang].values()) + languages.SMOOTHING * languages.BUCKETS
            sums[lang] = len(languages.ORDERS) * math.log(texts[lang] / sum(texts.values())) + sum(
                n * math.log((counts[lang][g] + languages.SMOOTHING) / whole) for g, n in mine.items())
        if not mine or not sums:
            found.append((doc_id, "und", 0.0))
            continue
        best = max(sums, key=lambda lang: (sums[lang]))
        mass = sum(math.exp((s - sums[best]) / len(languages.ORDERS)) for s in sums.values())
        found.append((doc_id, best, 1 / mass))
    return found


def run(spark, rows, scratch, **settings):
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    found = languages.identify(docs, languages.train(docs, scratch), scratch, **settings)
    return sorted((tuple(r) for r in found.collect()), key=str)


SMALL = [
    (i, text, lang) for i, (text, lang) in enumerate([
        ("the cat and the dog", "en"), ("der hund und die katze", "de"), ("le chien et le chat", "fr"),
        ("this is the house", "en"), ("das ist das haus", "de"), ("c'est la maison", "fr"), ("ΤΟ σπίτι", "el"),
        ("the dog is in the house", None), (None, "en"), ("", "en"), ("123 !?", "de"), ("Straße ÉTÉ", "de"),
        ("हिन्दी में", "hi"), ("x", None), ("cat " * 50, "en"), ("퟿\U0001f642 a", "xx"),
    ] * 3)
] + [(None, "the cat", "zz"), (5, "der hund", "de"), (5, "der hund", "de")]


def test_against_a_plain_version(spark, scratch):
    expected = sorted(plain(SMALL), key=str)
    for at_once in (1, 2, 64):
        found = run(spark, SMALL, scratch, at_once=at_once)
        assert [r[:2] for r in found] == [r[:2] for r in expected]
        assert [r[2] for r in found] == pytest.approx([r[2] for r in expected], abs=1e-4)


def test_very_long_texts_are_read_whole(spark, scratch, monkeypatch):
    rows = [(0, "the cat and " * 100, "en"), (1, "und der hund " * 100, "de"), (2, "the cat and " * 300, "en"),
            (3, "und der hund " * 300, "de"), (4, "q" * 1000 + " und der hund " * 900 + "the", None)]
    whole = run(spark, rows, scratch)
    assert [r[1] for r in whole if r[0] == 4] == ["de"]
    codes = languages.characters(rows[4][1])
    expected = [languages.buckets(codes)]
    assert sum(len(b) for b in expected[0]) == sum(len(codes) - n + 1 for n in languages.ORDERS)
    monkeypatch.setattr(languages, "GATHERED", 100)
    short = [b for b in languages.buckets(codes)]
    assert max(map(len, short)) <= 100 and sum(map(len, short)) == sum(len(codes) - n + 1 for n in languages.ORDERS)


def test_awkward_and_empty_tables(spark, scratch):
    found = languages.identify(awkward(spark), languages.train(awkward(spark), scratch), scratch).collect()
    assert len(found) == awkward(spark).count()
    assert all(0 <= r["score"] <= 1 for r in found)
    assert {r["lang_pred"] for r in found if r["doc_id"] in (3, 4, 5)} == {"und"}
    assert languages.identify(empty(spark), languages.train(awkward(spark), scratch), scratch).collect() == []
    nothing = languages.identify(awkward(spark), languages.train(empty(spark), scratch), scratch).collect()
    assert {(r["lang_pred"], r["score"]) for r in nothing} == {("und", 0.0)}


def test_query_on_texts_that_were_held_out(spark):
    found = {r["doc_id"]: r for r in QUERIES["op12_languages"](spark, SF_DIR).collect()}
    rows = table(SF_DIR, "documents", "doc_id", "lang")
    assert len(found) == len(rows)
    assert all(found[i]["held_out"] == held_out(i) for i, _ in rows)
    unseen = [(found[i]["lang_pred"], lang) for i, lang in rows if held_out(i)]
    assert sum(a == b for a, b in unseen) >= 0.98 * len(unseen)


def test_held_out_labels_are_not_learnt(spark, scratch):
    spoiled = [(i, t, "zz" if i is not None and held_out(i) else lang) for i, t, lang in SMALL]
    assert run(spark, spoiled, scratch) == run(spark, SMALL, scratch)
