from __future__ import annotations

import re
from collections import Counter, defaultdict
from itertools import count

import pytest
from helpers import awkward, empty, lower_ascii

from docketworks.llm import phrases
from docketworks.llm.tables import slices

DOCS = "doc_id long, text string, lang string, rank string, score string"


def plain(rows, least, longest=3, reported=2000):
    counts = defaultdict(Counter)
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower_ascii(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in range(1, len(words) + 1):
                for i in range(len(words) - size + 1):
                    if size <= longest:
                        counts[lang if lang is not None else "und"][tuple(words[i:i + size])] += 1
    out = []
    for lang, f in counts.items():
        n = sum(v for k, v in f.items() if len(k) == 1)
        chosen = {k: v for k, v in f.items() if len(k) > 1 and v >= least}
        found = []
        for phrase, a in chosen.items():
            if any(len(p) > len(phrase) and 100 * v >= 50 * a
                   and any(p[i:i + len(phrase)] == phrase for i in range(len(p))) for p, v in chosen.items()):
                continue
            score, _, l, r = min((1_000_000 * a * a // (f[phrase[:k]] * f[phrase[k:]]), k, f[phrase[:k]], f[phrase[k:]])
                                 for k in range(1, len(phrase)))
            found.append((-score, -a, " ".join(phrase).encode(), l, r))
        for rank, (score, a, phrase, l, r) in zip(count(1), sorted(found)[:reported]):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def run(frame, scratch, **settings):
    return sorted(tuple(r) for r in phrases.collocations(frame, scratch, **settings).collect())


ODD = ["a b c d. a b c d, a b c", "A B\tC  d\x0ba b c d;a b c d", "x x x x x x! x x x", "new york city new york",
       "New York, new york new\x1cyork", None, "", " \t ", ".,;", "Ä ä Ä ä Ä", "a b" * 30,
       "b c d e f b c d e g", "\x00 \x00 \x00 \x00", "one"]


def test_against_a_plain_version(spark, scratch):
    rows = [(t, lang) for t in ODD for lang in ("en", "de", None, "")] * 2 + [(ODD[0], "und"), ("solo", "fr")]
    frame = spark.createDataFrame([(i, t, lang, "", "") for i, (t, lang) in enumerate(rows)], DOCS)
    for partitions in (1, 5):
        spread = frame.repartition(partitions)
        for least, longest in ((2, 3), (3, 2)) if partitions == 1 else ((5, 3), (2, 4), (10_000, 3)):
            assert run(spread, scratch, least=least, longest=longest) == plain(rows, least, longest)
    assert run(frame, scratch, least=2, reported=3) == plain(rows, 2, reported=3)


def test_awkward_and_empty_tables(spark, scratch):
    rows = [(r["text"], r["lang"]) for r in awkward(spark).collect()]
    assert run(awkward(spark), scratch, least=2) == plain(rows, 2)
    assert run(empty(spark), scratch) == []


def test_counts_do_not_depend_on_the_segments(spark, scratch, monkeypatch):
    rows = [(f"the court of law {i % 7} said the court of law, {i % 3} times", "en") for i in range(300)]
    frame = spark.createDataFrame([(i, t, lang, "", "") for i, (t, lang) in enumerate(rows)], DOCS).repartition(2)
    expected = plain(rows, 10)
    assert run(frame, scratch) == expected
    texts = frame.select("lang", frame["text"].cast("binary").alias("text"))
    several = _cut_small(500, 100_000)
    assert phrases.through(texts, phrases.WORDS, several).count() > 10
    monkeypatch.setattr(phrases, "_segments", several)
    monkeypatch.setattr(phrases, "PART_WORDS", 300)
    assert run(frame, scratch) == expected
    monkeypatch.setattr(phrases, "_segments", _cut_small(100_000, 500))
    monkeypatch.setattr(slices, "__defaults__", (300,))
    assert run(frame, scratch) == expected


def _cut_small(segment_bytes, held_bytes):
    """Tasks with small limits of their own; they run in other processes."""
    usual = phrases._segments

    def work(batches):
        phrases.SEGMENT_BYTES, phrases.HELD_BYTES = segment_bytes, held_bytes
        try:
            yield from usual(batches)
        finally:
            phrases.SEGMENT_BYTES, phrases.HELD_BYTES = 16_000_000, 48_000_000

    return work


def test_products_beyond_64_bits_are_exact(spark):
    big = 9_000_000_000_123
    rows = [(big - 7, [big], [big + 11]), (big - 7, [big, 3 * big], [big + 11, big + 5])]
    frame = spark.createDataFrame(rows, "a long, heads array<long>, tails array<long>")
    found = [[tuple(c) for c in r[0]] for r in frame.select(phrases._cuts()).collect()]
    for (a, heads, tails), cuts in zip(rows, found):
        parts = [(heads[i], tails[len(heads) - 1 - i]) for i in range(len(heads))]
        assert cuts == [(1_000_000 * a * a // (l * r), i, l, r) for i, (l, r) in enumerate(parts)]


@pytest.mark.parametrize("texts,expected", [
    ([b"A b.c"], ([0, 1, 3], [b"a", b"b", b"c"])),
    ([b"a", b"a"], ([0, 2], [b"a"])),
    ([b""], ([], [])),
])
def test_borders_keep_pieces_apart(texts, expected):
    places, codes, words = phrases.occurrences(texts)
    assert (places.tolist(), words) == expected
    assert len(codes) == len(places)
