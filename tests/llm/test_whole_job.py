"""Cases in which a cut of candidates or rows would lose a part of the result."""

from __future__ import annotations

import random
import time

import numpy as np
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from tidefetch.llm import host_rules, licenses, near_dedup, packing, rule_ensemble


def test_near_duplicates_in_a_large_template_equal_all_pairs(spark, monkeypatch):
    # What is drawn must only decide how soon links are found.
    monkeypatch.setattr(near_dedup, "DRAWN", 1)
    draw = np.random.default_rng(3)
    # Ten fields of twenty values each in 300 words: most pairs are some 0.72 alike, few reach 0.8.
    texts = []
    for _ in range(500):
        words = [f"t{i}x" for i in range(300)]
        for field, value in enumerate(draw.integers(0, 20, 10)):
            words[30 * field + 15] = f"t{(30 * field + 40 + int(value)) % 300}x"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    weights = near_dedup._idfs(docs)
    sets = [weights.shingles(t.encode()) for t in texts]
    roots = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            x, y = roots[i], roots[j]
            if x != y and near_dedup.weighted_jaccard(sets[i], sets[j]) >= near_dedup.SIMILARITY:
                roots = [min(x, y) if r in (x, y) else r for r in roots]
    found = near_dedup.near_duplicates(docs).collect()
    assert len(texts) / 2 < len(set(roots)) < len(texts) - 20
    assert {r.doc_id: r.class_id for r in found} == dict(enumerate(roots))


def test_licences_of_a_text_with_several_notices(spark):
    notices = [text for text, _ in licenses.TEMPLATES.values()]
    mit, apache = licenses.TEMPLATES["mit-text"][0], licenses.TEMPLATES["apache-2.0"][0]
    rows = [(1, f"{mit} x {apache}"), (2, " x ".join(notices)), *((10 + i, f"apache {i}") for i in range(60))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = {r.doc_id: set(r.labels.split(",")) for r in licenses.scan(docs).collect()}
    assert labels[1] == {"mit-text", "apache-2.0", "apache"}
    assert labels[2] >= set(licenses.TEMPLATES)


def test_verdicts_on_hosts_change_what_is_kept(spark):
    good, symbols = lambda i: prose(i, 60), lambda i: prose(i, 60) + " #" * 40
    rows = [("mixed", good(i) if i % 5 else symbols(i)) for i in range(1500)]
    rows += [("bad", symbols(i) if i % 10 else good(i)) for i in range(600)]
    rows += [("clean", symbols(i) if i == 7 else good(i)) for i in range(1200)]
    rows += [("tiny", symbols(1)), ("tiny", good(2))]
    docs = spark.createDataFrame([(i, h, t) for i, (h, t) in enumerate(rows)], "doc_id long, source string, text string")
    judged = host_rules.judge(docs)
    found = {}
    for r in judged.collect():
        plain = not r.base_failed and not r.rules_failed
        verdict, kept = found.setdefault(r.host, (r.host_verdict, set()))
        kept.add((plain, r.kept))
    assert found["bad"] == ("rejected", {(True, False), (False, False)})
    assert found["clean"] == ("trusted", {(True, True), (False, True)})
    assert found["mixed"] == ("watched", {(True, True), (False, False)})
    assert found["tiny"] == ("watched", {(True, True), (False, False)})


def test_no_text_is_shuffled_to_learn_quality(spark):
    docs = spark.createDataFrame([(i, prose(i, 30)) for i in range(50)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, quality int")
    plans = []
    settle = rule_ensemble.settle

    def noted(df, label="table"):
        plans.append((label, df._jdf.queryExecution().executedPlan().toString()))
        return settle(df, label)

    rule_ensemble.settle, kept = noted, None
    try:
        kept = rule_ensemble.keep_good(docs, labels)
    finally:
        rule_ensemble.settle = settle
    plans.append(("kept", kept._jdf.queryExecution().executedPlan().toString()))
    train = dict(plans)["train"]
    assert "BroadcastHashJoin" in train and "Generate" in train
    for label, plan in plans:
        moved = [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line]
        assert label == "labels" or not moved


def test_labelled_rows_of_a_hash_bound_are_those_of_a_sort(spark):
    labels = spark.range(5_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    few = rule_ensemble.labelled(labels, "quality", 300, (3, 1)).collect()
    every = rule_ensemble.labelled(labels, "quality", 10_000, (3, 1)).withColumn("h", F.xxhash64("doc_id"))
    assert sorted(r.doc_id for r in few) == sorted(r.doc_id for r in every.orderBy("h").limit(300).collect())


def test_notices_equal_brute_force(spark):
    draw = random.Random(11)
    library = licenses._LIBRARY
    rows = []
    for i in range(250):
        words = []
        for _ in range(draw.randint(0, 4)):
            part = list(draw.choice(library)[2])
            cut = draw.randint(0, 3)
            part = part[cut if draw.random() < 0.3 else 0 : len(part) - (draw.randint(0, 4) if draw.random() < 0.3 else 0)]
            for _ in range(draw.randint(0, 2)):
                if part:
                    part[draw.randrange(len(part))] = draw.choice(["zzz", "license", "the"])
            words += part + [draw.choice(["and", "x", "license", "public"]) for _ in range(draw.randint(0, 3))]
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in licenses.scan(docs).collect()}
    idf = licenses._idfs(licenses.find_words(docs))
    several = 0
    for i, text in rows:
        words = text.split()
        wanted = []
        for kind, label, notice, at, n in library:
            if kind == "base":
                continue
            for start in range(-len(notice), len(words)):
                there = [0 <= start + k < len(words) and words[start + k] == w for k, w in enumerate(notice)]
                score = sum(idf[w] for w, t in zip(notice, there) if t) / sum(idf[w] for w in notice)
                if all(there[at : at + n]) and score >= licenses.LEAST_SCORE:
                    wanted.append((label, start, score))
        assert [tuple(f) for f in found[i].found] == sorted(wanted)
        several += len(wanted) > 1
    assert several > 20


def test_a_text_of_very_many_notices_takes_seconds(spark):
    docs = spark.createDataFrame([(1, "mit license " * 16_000), (2, "MIT \u212aLICENSE")], "doc_id long, text string")
    started = time.time()
    found = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert time.time() - started < 60
    assert (found[1].n_base, found[1].first_word, found[1].last_word) == (16_000, 0, 31_998)
    # A Kelvin sign is no k.
    assert (found[2].n_words, found[2].n_base) == (2, 0)


def test_pieces_without_an_id_spread_over_shards(spark):
    pieces = spark.range(0, 4_000, 1, 4).select(
        F.when(F.col("id") % 3 > 0, F.lit(7)).alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"),
        F.lit(50).cast("long").alias("length"),
    )
    placed = packing.place(pieces, capacity=100, shard_tokens=20_000)
    shards = placed.groupBy(F.shiftright("sequence_id", 32).alias("s")).agg(F.sum("length").alias("n")).collect()
    assert len(shards) == 10 and max(r.n for r in shards) < 30_000
    assert placed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 100").count() == 0
