from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from conftest import SF_DIR
from helpers import LONG, awkward, empty, table
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docketworks.llm import packing, prefix_counts, records
from docketworks.llm.queries import QUERIES, vocabulary
from docketworks.llm.tokens import ChunkEncoder, tokenizer

WORD, BYTE = vocabulary("word_bpe_49k.json"), vocabulary("byte_bpe_50k.json")
PIECES = st.sampled_from(list("abTHE re'sl'ld  \n\n\t\r .,!éñİΣς漢\U0001f6420123==\x1c\x85\xa0　\x00Á") +
                         ["<|endoftext|>", "<|startoftext|>", "'re", " the", "  ", "ing", "----", "́"])
TEXT = st.lists(PIECES, max_size=40).map("".join)


@pytest.fixture(scope="module")
def library():
    return {path: tokenizer(path) for path in (WORD, BYTE)}


@pytest.fixture(scope="module")
def encoder():
    return ChunkEncoder(WORD)


@pytest.fixture(scope="module")
def tables():
    return prefix_counts.PrefixTables(BYTE)


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(TEXT, max_size=6))
def test_chunks_give_the_ids_of_the_library(texts, library, encoder):
    expected = [e.ids for e in library[WORD].encode_batch(texts, add_special_tokens=False)]
    assert [ids.tolist() for ids in encoder.encode(texts)] == expected


def test_a_full_chunk_table_is_forgotten(library, monkeypatch):
    monkeypatch.setattr("docketworks.llm.tokens.KEPT_CHUNKS", 3)
    encoder = ChunkEncoder(WORD)
    for text in ("a b c d e f", "d e f g", "", None, LONG):
        expected = library[WORD].encode(text or "", add_special_tokens=False).ids
        assert encoder.encode([text])[0].tolist() == expected


@settings(max_examples=100, deadline=None)
@given(text=TEXT)
def test_every_prefix_counts_as_in_the_library(text, library, tables):
    counts = np.cumsum(tables.tables([text])[0], dtype=np.int64).tolist()
    prefixes = [text[:k] for k in range(1, len(text) + 1)]
    assert counts == [len(e.ids) for e in library[BYTE].encode_batch(prefixes, add_special_tokens=False)]


def test_long_pieces_and_runs_of_white_space(library, tables):
    texts = ["x" * 3000, " " * 700 + "a", "\n" * 300, "=" * 1000 + "b", "é" * 500, LONG, "ab" * 2000 + "  \n c"]
    found = [int(t.sum(dtype=np.int64)) for t in tables.tables(texts)]
    assert found == [len(e.ids) for e in library[BYTE].encode_batch(texts, add_special_tokens=False)]


def test_counts_and_truncation_of_a_table(spark, library):
    rows = prefix_counts.count_prefixes(awkward(spark), BYTE, 7, keep_tables=True).collect()
    assert len(rows) == 12
    texts = {(r["doc_id"], r["text"]) for r in awkward(spark).collect()}
    for r in rows:
        mine = [t for d, t in texts if d == r["doc_id"] and len((t or "").encode()) == r["n_bytes"]]
        expected = library[BYTE].encode(mine[0] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(expected) == prefix_counts.tokens_at(r["prefix_table"], 10**9)
        assert r["fitting_chars"] == prefix_counts.longest_prefix(r["prefix_table"], 7)
        cut = (mine[0] or "")[:r["fitting_chars"]]
        assert len(library[BYTE].encode(cut, add_special_tokens=False).ids) <= 7
    assert prefix_counts.count_prefixes(empty(spark), BYTE, 7).collect() == []


def check_pieces(pieces, docs, library, window):
    """Every id once, in order; sequences without gaps and within the window."""
    expected = sorted(
        (d is not None, d or 0, tuple(library[WORD].encode(t or "", add_special_tokens=False).ids) + (1,))
        for d, t in docs
    )
    by_sequence, parts = {}, {}
    for p in pieces:
        ids = np.frombuffer(p["ids"], "<u4").tolist()
        assert len(ids) == p["length"] > 0
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
        parts.setdefault((p["doc_id"], p["doc_tokens"]), []).append((p["start"], ids))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= window
    total = sum(len(ids) for *_, ids in expected)
    assert total == sum(p["length"] for p in pieces)
    for (doc_id, size), found in parts.items():
        same = [list(ids) for known, d, ids in expected if (d if known else None) == doc_id and len(ids) == size]
        assert sum(len(ids) for _, ids in found) == size * len(same)
        for start, ids in found:
            assert any(ids == one[start:start + len(ids)] for one in same)
    return by_sequence


@pytest.mark.parametrize("window, partitions", [(2048, 3), (16, 7)])
def test_packing_of_awkward_rows(spark, scratch, library, monkeypatch, window, partitions):
    monkeypatch.setattr("docketworks.llm.packing.MERGED_TASKS", 2)
    docs = awkward(spark, partitions)
    found = packing.pack(docs, WORD, 1, scratch, window, 2).collect()
    sequences = check_pieces(found, [(r["doc_id"], r["text"]) for r in docs.collect()], library, window)
    used = sum(length for places in sequences.values() for _, length in places)
    assert len(sequences) * window - used < window + 8 * len(sequences)
    assert packing.pack(empty(spark), WORD, 1, scratch).collect() == []


def test_the_packer_keeps_a_bounded_number_open():
    packer, out = packing.Packer(10, 2), []
    for i, size in enumerate([6, 7, 3, 9, 4, 25, 1, 8]):
        out += list(packer.add(packing.Piece(i, 0, size, np.arange(size))))
        assert len(packer.open) <= 2
    out += packer.rest()
    assert sum(w.used for w in out) == 63 and all(w.used <= 10 for w in out)


def test_best_fit_takes_the_smallest_gap():
    packer = packing.Packer(10, 3)
    for i, size in enumerate([5, 8, 6]):
        list(packer.add(packing.Piece(i, 0, size, np.arange(size))))
    done = list(packer.add(packing.Piece(9, 0, 4, np.arange(4))))
    assert [[p.doc_id for p in w.pieces] for w in done] == [[2, 9]]


def test_records_round_trip(spark, scratch, library):
    docs = awkward(spark)
    manifest = records.write_records(docs, WORD, 2, scratch)
    rows = records.read_records(manifest).orderBy("start").collect()
    at, last = 0, None
    for r in rows:
        assert r["start"] == at
        assert last is None or r["doc_id"] >= last
        at, last = at + r["n_tokens"], r["doc_id"]
    expected = sorted(
        (r["doc_id"] is not None, r["doc_id"] or 0,
         library[WORD].encode(r["text"] or "", add_special_tokens=False).ids + [2]) for r in docs.collect()
    )
    found = sorted((r["doc_id"] is not None, r["doc_id"] or 0, np.frombuffer(r["ids"], "<u4").tolist()) for r in rows)
    assert found == expected
    taken = records.fetch(manifest.collect(), [2, 6, 77])
    assert [len(taken[i]) for i in (2, 6, 77)] == [2, 1, 0]
    assert taken[6][0].tolist() == next(ids for _, d, ids in expected if d == 6)
    assert records.read_records(records.write_records(empty(spark), WORD, 2, scratch)).collect() == []


@pytest.mark.parametrize("at", [0, 9, 14, -1])
def test_a_changed_byte_is_noticed(at):
    data = bytearray(records.frame(records.payload_of(5, np.arange(4), 2)))
    data[at] ^= 1
    place = [0]

    def take(n):
        part = bytes(data[place[0]:place[0] + n])
        place[0] += n
        return part

    with pytest.raises(records.BrokenRecord):
        records.unframe(take)


def test_every_plain_character_alone_and_beside_others(library, encoder):
    texts = [f"{c} a{c} {c}b {c}{c} A{c}B. {c}, it{c}s {c}'re x'{c} 1{c}2" for c in map(chr, range(0x250))]
    expected = [e.ids for e in library[WORD].encode_batch(texts, add_special_tokens=False)]
    assert [ids.tolist() for ids in encoder.encode(texts)] == expected


def test_the_table_of_words_is_emptied(library, monkeypatch):
    monkeypatch.setattr("docketworks.llm.tokens.KEPT_WORDS", 2)
    encoder = ChunkEncoder(WORD)
    for text in ("one two three, four", "ONE Two (three) é", "five's one", "one"):
        assert encoder.encode([text])[0].tolist() == library[WORD].encode(text, add_special_tokens=False).ids


def test_other_files_are_left_to_the_library(library):
    assert ChunkEncoder(BYTE)._words is None and ChunkEncoder(WORD)._words is not None


@pytest.fixture(scope="module")
def ids_of(library):
    """Ids of every document of the table by the library alone."""
    rows = sorted(table(SF_DIR, "documents", "doc_id", "text"))
    return {path: {i: e.ids for (i, _), e in zip(rows, library[path].encode_batch(
        [t or "" for _, t in rows], add_special_tokens=False))} for path in (WORD, BYTE)}


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_packing_query(spark, ids_of):
    rows = QUERIES["op1_packing"](spark, SF_DIR).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = [*ids_of[WORD][r["doc_id"]], 1]
        assert r["doc_tokens"] == len(ids)
        assert r["ids_crc32"] == crc(ids[r["start"]:r["start"] + r["length"]])
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, ids in ids_of[WORD].items():
        assert follow(pieces[i]) == len(ids) + 1
    sizes = [follow(places) for places in sequences.values()]
    assert max(sizes) <= 2048 and sum(2048 - s for s in sizes) < 0.02 * 2048 * len(sizes) + 2048


def follow(parts) -> int:
    """End of parts that follow each other from 0 without a gap."""
    end = 0
    for start, length in sorted(parts):
        assert start == end and length > 0
        end += length
    return end


def test_record_query(spark, ids_of):
    rows = sorted(QUERIES["op8_binary_records"](spark, SF_DIR).collect(), key=lambda r: r["doc_id"])
    expected, before = [], 0
    for i, ids in sorted(ids_of[WORD].items()):
        expected.append((i, before, len(ids) + 1, crc([*ids, 2])))
        before += len(ids) + 1
    assert [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows] == expected


def test_count_query(spark, ids_of):
    rows = {r["doc_id"]: r for r in QUERIES["op9_prefix_counts"](spark, SF_DIR).collect()}
    texts = dict(table(SF_DIR, "documents", "doc_id", "text"))
    assert {i: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for i, r in rows.items()} == {
        i: (len((texts[i] or "").encode()), len(ids), len(ids) > 1024) for i, ids in ids_of[BYTE].items()}


def test_record_files_are_read_by_many_tasks(spark, scratch, monkeypatch):
    docs = spark.range(4000).selectExpr("id AS doc_id", "repeat(concat('word', id, ' '), 20) AS text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = records.write_records(docs, WORD, 2, scratch)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert manifest.count() > 1
    monkeypatch.setattr(records, "TASK_BYTES", 50_000)
    read = records.read_records(manifest)
    assert read.count() == 4000
    tasks = read.select(F.spark_partition_id().alias("task")).distinct().count()
    assert tasks > 1
