"""The pipeline stage by stage, and the registration of all queries."""

from __future__ import annotations

import numpy as np
import pytest
from conftest import SF_DIR
from helpers import awkward, empty, table
from oracle_check import connect, difference

import __spark_entry__ as contract
import corpus_pipeline
from docketworks.llm.queries import QUERIES, SQL
from docketworks.sources.scratch import Scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    scratch, rows, found = Scratch(spark), spark.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        rows = found[name] = scratch.stage(stage(spark, rows, SF_DIR), name)
    return found


def ids(frame):
    return {r["doc_id"] for r in frame.select("doc_id").collect()}


def test_stages_keep_the_columns_and_only_remove_rows(stages):
    before = {d for d, in table(SF_DIR, "documents", "doc_id")}
    for name, frame in stages.items():
        assert ids(frame) <= before and frame.count() > 0
        if name != "packing":
            assert frame.columns == COLUMNS
            before = ids(frame)
    assert ids(stages["packing"]) == before


def test_decisions_are_those_of_the_operators(spark, stages):
    rules = QUERIES["op7_likelihood_rules"](spark, SF_DIR)
    assert ids(stages["quality_rules"]) == ids(rules.filter("kept"))
    assert not ids(stages["decontamination"]) & ids(QUERIES["op2_decontamination"](spark, SF_DIR).filter("contaminated"))
    quality = dict(table(SF_DIR, "labels", "doc_id", "quality"))
    after = ids(stages["quality_classifier"])
    assert {d for d in ids(stages["quality_rules"]) if quality.get(d) == 1} <= after
    assert not {d for d in after if quality.get(d) == 0}
    kept = ids(stages["near_duplicates"])
    owner = {r["doc_id"]: r["component_id"] for r in QUERIES["op3_minhash"](spark, SF_DIR).collect()}
    assert len({owner[d] for d in kept}) == len(kept) and {owner[d] for d in after} == {owner[d] for d in kept}


def test_the_pieces_are_whole(stages):
    pieces = stages["packing"].collect()
    total = {p["doc_id"]: p["doc_tokens"] for p in pieces}
    assert sum(total.values()) == sum(p["length"] for p in pieces)
    assert all(len(np.frombuffer(p["ids"], "<u4")) == p["length"] for p in pieces)


def test_awkward_rows_pass_every_stage(spark):
    docs = awkward(spark)
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs, SF_DIR)
        if name != "packing":
            assert rows.columns == docs.columns
        rows.collect()
        nothing = stage(spark, empty(spark), SF_DIR)
        assert nothing.collect() == [] and (name == "packing" or nothing.columns == docs.columns)
    kept = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, SF_DIR).collect()
    assert sorted(r["doc_id"] or -1 for r in kept) == [-1, -1, 1, 3, 4, 5, 6, 7, 8]


def test_different_texts_of_one_id_are_kept(spark):
    one, two, three = (" ".join(f"{c}{i}" for i in range(30)) for c in "abc")
    rows = [(1, one), (2, one), (2, two), (3, two), (3, three), (3, three), (None, one)]
    docs = spark.createDataFrame([(*r, "en", "a", 1) for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    kept = corpus_pipeline.near_duplicates(spark, docs, SF_DIR)
    assert kept.columns == COLUMNS
    found = [(r["doc_id"] or 0, r["text"]) for r in kept.collect()]
    assert sorted(found) == [(0, one), (1, one), (2, two), (3, three)]


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_its_sql(name, spark):
    assert difference(QUERIES[name](spark, SF_DIR), connect(SF_DIR), SQL[name]) == ""


def test_every_operator_is_registered():
    names = contract.queries()
    for number in range(1, 11):
        assert len([n for n in names if n.startswith(f"op{number}_")]) == 1
    assert names["pipeline"] is corpus_pipeline.run
    assert set(SQL) <= set(QUERIES)
