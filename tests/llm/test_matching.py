"""Decontamination and near-duplicates against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF_DIR
from helpers import LONG, awkward, empty, lower_ascii, plain_words, table

from docketworks.llm import decontaminate, minhash
from docketworks.llm.components import components
from docketworks.llm.queries import QUERIES
from docketworks.llm.shingles import hash_family, shingle_set, signature


def joined(links):
    """Smallest reachable node of every node."""
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    return {x: root(x) for x in parent}


# -- decontamination -------------------------------------------------------------


def plain_hits(docs, items, size=10):
    cut = {}
    for item, text in items:
        found = re.findall(decontaminate.WORD, lower_ascii(text))
        for i in range(max(1, len(found) - size + 1) if found else 0):
            cut.setdefault(tuple(found[i:i + size]), set()).add(item)
    lengths = {len(w) for w in cut}
    for doc_id, text in docs:
        found, hit, who = re.findall(decontaminate.WORD, lower_ascii(text)), set(), set()
        for i in range(len(found)):
            for n in lengths:
                window = tuple(found[i:i + n])
                if len(window) == n and window in cut:
                    hit |= set(range(i, i + n))
                    who |= cut[window]
        names = sorted(str(w) for w in who if w is not None)
        yield (doc_id, len(found), len(hit), len(names),
               hashlib.sha256(",".join(names).encode()).hexdigest(), len(hit) > 0)


def test_contamination_of_the_tables(spark):
    docs, items = table(SF_DIR, "documents", "doc_id", "text"), table(SF_DIR, "benchmark", "item_id", "text")
    found = sorted(tuple(r) for r in QUERIES["op2_decontamination"](spark, SF_DIR).collect())
    assert found == sorted(plain_hits(docs, items))
    assert any(r[5] for r in found)


ITEMS = [(1, "Three four FIVE six, seven eight nine ten eleven twelve"), (2, "short"), (2, "漢字"), (3, None), (4, "?!"),
         (None, "ghi jkl"), (10, "one two three four five six seven eight nine ten eleven twelve thirteen")]


@pytest.mark.parametrize("block_chars", [10**6, 200])
def test_contamination_of_awkward_rows(spark, scratch, block_chars):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = awkward(spark)
    rows = decontaminate.scan(docs, benchmark, scratch, block_chars=block_chars).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    found = sorted(((r["doc_id"], r["n_words"], len(r["hit_words"]), len(r["items"])) for r in rows), key=key)
    source = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found == sorted((e[:4] for e in plain_hits(source, ITEMS)), key=key)
    long = next(r for r in rows if r["doc_id"] == 6)
    assert [LONG[s["start"]:s["end"]] for s in long["spans"][:2]] == ["ghi jkl", "ghi jkl"]
    clean = decontaminate.drop_contaminated(docs, benchmark, scratch, block_chars=block_chars)
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in clean.collect()} == {3, 4, 5, None}


def test_contamination_of_empty_tables(spark, scratch):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.report(empty(spark), nothing, scratch).collect() == []
    rows = decontaminate.report(awkward(spark), nothing, scratch).collect()
    assert len(rows) == 12 and not any(r["contaminated"] for r in rows)


# -- near-duplicates -------------------------------------------------------------


def plain_sets(docs):
    for doc_id, text in docs:
        found = plain_words(lower_ascii(text))
        yield doc_id, {tuple(found[i:i + 5]) for i in range(max(1, len(found) - 4))} if found else set()


def plain_components(sets):
    holders, shared = defaultdict(list), Counter()
    for doc_id, shingles in sets.items():
        for s in shingles:
            holders[s].append(doc_id)
    for same in holders.values():
        shared.update((a, b) for i, a in enumerate(same) for b in same[i + 1:])
    return joined((a, b) for (a, b), n in shared.items() if 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n))


def test_near_duplicates_of_the_tables(spark):
    sets = dict(plain_sets(table(SF_DIR, "documents", "doc_id", "text")))
    owner = plain_components(sets)
    rows = QUERIES["op3_minhash"](spark, SF_DIR).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows} == {
        d: (len(s), owner.get(d, d), owner.get(d, d) == d) for d, s in sets.items()
    }
    assert len(rows) == len(sets) and not all(r["kept"] for r in rows)


def family(rng, copies):
    """One text and copies of it, each with a few words of its own changed."""
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    yield " ".join(base)
    for _ in range(copies):
        mine = list(base)
        for _ in range(rng.randrange(1, 6)):
            mine[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        yield " ".join(mine)


@pytest.mark.parametrize("block", [512, 7])
def test_no_link_of_a_large_group_is_lost(spark, scratch, block):
    rng = random.Random(11)
    texts = [*family(rng, 90), *family(rng, 12), *family(rng, 3)]
    rng.shuffle(texts)
    docs = list(enumerate(texts, 100))
    found = minhash.near_duplicates(
        spark.createDataFrame(docs, "doc_id long, text string"), scratch, block=block
    ).collect()
    sets = dict(plain_sets(docs))
    owner = plain_components(sets)
    assert {r["doc_id"]: r["component_id"] for r in found} == {d: owner.get(d, d) for d in sets}


def test_near_duplicates_of_awkward_rows(spark, scratch):
    rows = minhash.near_duplicates(awkward(spark), scratch).collect()
    assert len(rows) == 12
    known = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in rows}
    assert {k for k in known if k[0] in (1, 2, 9)} == {(1, 8, 1, True), (2, 8, 1, False), (9, 9, 1, False)}
    assert {k for k in known if k[0] in (3, 4, 5)} == {(i, 0, i, True) for i in (3, 4, 5)}
    assert {k for k in known if k[0] is None} == {(None, 8, None, True), (None, 0, None, True)}
    assert {k[1] for k in known if k[0] == 8} == {1}
    assert minhash.near_duplicates(empty(spark), scratch).collect() == []


def test_components_of_chains_stars_and_repeats(spark, scratch):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(0, 40)] + [(200, i) for i in range(201, 230)] + [(5, 5), (300, 299), (299, 300)]
    links += [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(90)]
    frame = spark.createDataFrame(links, "u long, v long")
    found = {r["node"]: r["component"] for r in components(frame, scratch).collect()}
    expected = joined((a, b) for a, b in links if a != b)
    assert found == {x: r for x, r in expected.items() if x != r}
    assert components(frame.filter("u = v"), scratch).collect() == []


def test_minima_agree_as_often_as_sets_overlap():
    values = np.random.default_rng(3).integers(0, 1 << 63, 1150).astype(np.uint64)
    one, other = values[:1000], values[150:]
    hashes = hash_family(2000)
    share = (signature(one, hashes) == signature(other, hashes)).mean()
    assert abs(share - 850 / 1150) < 0.04
    assert len(shingle_set("a b c d e f")) == 2 and len(shingle_set("A b")) == 1
    assert (shingle_set("A b") == shingle_set("a B")).all() and (shingle_set("a b") != shingle_set("b a")).all()
