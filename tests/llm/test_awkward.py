"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns, for every operator on documents."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from tidefetch.llm import chat, decontamination, host_rules, licenses, queries, rule_ensemble, token_files, toxicity


def _labels(spark, label):
    return spark.createDataFrame([(i, i % 2) for i in range(12)] + [(3, None), (None, 1)], f"doc_id long, {label} int")


def _token_files(spark, docs):
    return token_files.read_token_files(*token_files.write_token_files(docs, queries.tokenizer_path()))


OPERATORS = {
    "host_rules": lambda spark, docs: host_rules.judge(docs),
    "rule_ensemble": lambda spark, docs: rule_ensemble.classify(docs, _labels(spark, "quality")),
    "licenses": lambda spark, docs: licenses.scan(docs),
    "toxicity": lambda spark, docs: toxicity.classify(docs, _labels(spark, "toxic")),
    "token_files": _token_files,
    "decontamination": lambda spark, docs: decontamination.find_hits(
        docs, spark.createDataFrame([("b", prose(2, 20)), (None, "x y"), ("c", None)], "item_id string, text string")
    ),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_every_row_of_an_awkward_table_gets_a_result(spark, awkward, name):
    run = OPERATORS[name]
    twice = awkward.unionByName(awkward).withColumn("hits", F.lit(1)).withColumn("votes", F.lit("x")).withColumn("frame", F.lit(2))
    rows = run(spark, twice)
    ids = sorted((r.doc_id is not None, r.doc_id or 0) for r in rows.select("doc_id").collect())
    assert ids == sorted((r.doc_id is not None, r.doc_id or 0) for r in twice.collect())
    assert run(spark, twice.limit(0)).count() == 0


def test_chats_of_awkward_turns(spark):
    rows = [(1, 0, "user", "a", 5), (1, 0, "user", "a", 5), (1, None, None, None, 5), (None, 1, "assistant", "b", 5), (2, 1, "assistant", "", 5)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, loss_runs int")
    found = {r.conv_id: r for r in chat.digest(chat.format_chats(turns)).collect()}
    assert {k: (r.n_turns, r.loss_chars) for k, r in found.items()} == {1: (3, 0), None: (1, 1), 2: (1, 0)}


def test_losses_are_read_through_the_mask(spark):
    texts = ["</s>[INST] é\\", "日本[/INST]", "", "<s>\\</s>", "x" * 3000]
    rows = [(c, t, "assistant" if (t + c) % 2 else "user", texts[(t * c) % 5]) for c in range(4) for t in range(600 if c == 3 else 9)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    chats = chat.format_chats(turns)
    for r in chat.loss_texts(chats).collect():
        wanted = [x for c, t, role, x in rows if c == r.conv_id and role == "assistant" and x]
        assert r.loss_texts == wanted
    # A mask that is moved gives other texts, so it is the mask that is read.
    moved = chats.withColumn("loss_bytes", F.transform("loss_bytes", lambda n, i: F.when(i == 0, n + 1).otherwise(n)))
    assert chat.digest(moved).select("loss_sha256").collect() != chat.digest(chats).select("loss_sha256").collect()
