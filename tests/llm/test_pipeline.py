"""Each stage of the pipeline against a version in memory, on the rows that the stage before kept."""

from __future__ import annotations

import re

import numpy as np
import pytest

import corpus_pipeline
from tests.llm.conftest import prose
from tidefetch.llm import near_dedup, queries
from tidefetch.llm.common import fresh_path

LOWER = {c: c + 32 for c in range(65, 91)}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    home = tmp_path_factory.mktemp("tables")
    shared, item = prose(70, 70), prose(71, 14)
    rows = []
    for i in range(240):
        text = prose(i + 100, 60 + i % 50)
        if i % 4 == 0:
            text = "$$$ " * 60 + prose(i + 100, 9)
        elif i % 10 == 1:
            text = f"{prose(i + 100, 15)} {shared} {prose(i + 300, 40)}"
        elif i % 10 == 3:
            text = f"{prose(i + 100, 30)} {item}, {prose(i + 300, 30)}"
        elif i % 10 == 7 and i > 30:
            text = prose(107, 67).replace(prose(107, 67).split()[i % 60], "changed", 1)
        rows.append((i, text, "en", "s", len(text)))
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    documents.write.parquet(f"{home}/documents.parquet")
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(240)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{home}/labels.parquet")
    spark.createDataFrame([("q1", item), ("q2", "not there at all")], "item_id string, text string").write.parquet(f"{home}/benchmark.parquet")
    return str(home)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def test_stages_equal_versions_in_memory(spark, folder):
    docs, tables = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = fresh_path(spark, "stage")
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        tables.append({r[0]: r for r in docs.collect()} if name != "best-fit packing" else docs.collect())
    good, single, cut, clean, packed = tables
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(set(next(iter(t.values())).asDict()) == set(columns) for t in tables[:4])

    assert set(good) == {i for i in range(240) if i % 4}

    # One of each class of pairs at the similarity stays, the least.
    weights = near_dedup._idfs(spark.createDataFrame([(i, r.text) for i, r in good.items()], "doc_id long, text string"))
    ids = sorted(good)
    sets = {i: weights.shingles(good[i].text.encode()) for i in ids}
    root = {i: i for i in ids}
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if root[i] != root[j] and near_dedup.weighted_jaccard(sets[i], sets[j]) >= near_dedup.SIMILARITY:
                low, high = sorted((root[i], root[j]))
                root = {k: low if v == high else v for k, v in root.items()}
    assert set(single) == set(root.values()) and len(single) < len(good)

    first = {}
    for i in sorted(single):
        w = words(single[i].text)
        for a in range(len(w) - 49):
            first.setdefault(tuple(w[a : a + 50]), i)
    removed = 0
    for i in single:
        w = words(single[i].text)
        gone = {k for a in range(len(w) - 49) if first[tuple(w[a : a + 50])] < i for k in range(a, a + 50)}
        removed += len(gone)
        assert words(cut[i].text) == [x for k, x in enumerate(w) if k not in gone]
    assert removed > 500 and set(cut) == set(single)

    item = words(prose(71, 14))
    hits = 0
    for i in cut:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", cut[i].text.translate(LOWER))
        windows = {tuple(item[a : a + 10]) for a in range(len(item) - 9)}
        gone = {k for a in range(len(w) - 9) if tuple(w[a : a + 10]) in windows for k in range(a, a + 10)}
        hits += len(gone)
        left = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", clean[i].text.translate(LOWER))
        assert left == [x for k, x in enumerate(w) if k not in gone]
    assert hits >= 14 and set(clean) == set(cut)

    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.tokenizer_path())
    lengths = {i: len(library.encode(r.text, add_special_tokens=False).ids) + 1 for i, r in clean.items()}
    assert {r.doc_id: r.length for r in packed} == lengths
    places = {}
    for r in packed:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for found in places.values():
        ends = np.cumsum([n for _, n in sorted(found)])
        assert [o for o, _ in sorted(found)] == [0, *ends[:-1].tolist()] and ends[-1] <= 4096
    assert len(places) <= sum(lengths.values()) // 4096 + 2
