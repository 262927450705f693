"""What tasks hold at once."""

from __future__ import annotations

import os
import tracemalloc

import numpy as np
import pyarrow as pa

from tidefetch.llm import decontamination, near_dedup
from tidefetch.llm.common import settle, word_hashes
from tidefetch.session import ARROW_BYTES, BATCH


def _texts(n: int, words: int) -> list[str]:
    return [" ".join(f"w{(i * 7 + j) % (2 * words)}" for j in range(words)) for i in range(n)]


def _batches(texts: list[str], rows: int):
    for at in range(0, len(texts), rows):
        yield pa.RecordBatch.from_arrays([pa.array(texts[at : at + rows])], ["text"])


def test_a_settled_table_has_no_file_that_the_driver_writes(spark):
    for rows in (0, 30):
        settled = settle(spark.range(0, rows, 1, 3))
        files = [name for name in os.listdir(settled._settled_in.removeprefix("file:")) if not name.startswith(".")]
        assert files and all(name.startswith("part-") for name in files)
        assert sorted(r.id for r in settled.collect()) == list(range(rows))


def test_tasks_of_a_settled_table_get_small_batches(spark):
    docs = spark.range(0, 6000, 1, 1).selectExpr("repeat('some words ', 300) as text")

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "bytes"])

    def largest() -> int:
        found = settle(docs.mapInArrow(sizes, "n long, bytes long")).collect()
        assert sum(r.n for r in found) == 6000
        return max(r.bytes for r in found)

    assert spark.conf.get(ARROW_BYTES, None) is None
    assert largest() < 1.1 * BATCH
    assert spark.conf.get(ARROW_BYTES, None) is None
    spark.conf.set(ARROW_BYTES, "1m")
    try:
        assert largest() < 1.1 * (1 << 20)
        assert spark.conf.get(ARROW_BYTES) == "1m"
    finally:
        spark.conf.unset(ARROW_BYTES)


def test_counting_words_holds_no_more_for_more_texts():
    texts = _texts(2500, 1000)
    tracemalloc.start()
    try:
        rows = list(near_dedup._count_words(_batches(texts, 100)))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
        word_hashes.clear()
    assert sum(r.num_rows for r in rows) == 2000
    assert peak < 20 << 20


def test_counts_of_words_do_not_depend_on_where_they_are_held(monkeypatch):
    texts = [*_texts(40, 30), "", " ", "a a b", "b", None]
    expected: dict[int, int] = {}
    for text in texts:
        for word in set((text or "").encode().split()):
            hashed = int(word_hashes.of([word]).view(np.int64)[0])
            expected[hashed] = expected.get(hashed, 0) + 1
    for counted, uncounted in ((10**6, 10**6), (10**6, 7), (20, 7), (0, 0)):
        monkeypatch.setattr(near_dedup, "COUNTED", counted)
        monkeypatch.setattr(near_dedup, "UNCOUNTED", max(1, uncounted))
        got: dict[int, int] = {}
        for r in near_dedup._count_words(_batches(texts, 9)):
            for word, n in zip(r.column(0).to_pylist(), r.column(1).to_pylist()):
                got[word] = got.get(word, 0) + n
        assert got == expected
    assert not list(near_dedup._count_words(iter(())))


def test_decontamination_takes_one_python_worker_for_a_task(spark, monkeypatch):
    items = spark.createDataFrame([("a", " ".join(f"w{i}" for i in range(12))), ("b", "q r s")], "item_id string, text string")
    docs = spark.createDataFrame(
        [(1, "x " + " ".join(f"w{i}" for i in range(12)) + " y"), (2, "Q r, S t"), (3, None), (4, "")], "doc_id long, text string"
    )
    cleaned = decontamination.decontaminate(docs, items)
    assert cleaned._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    expected = [(1, "x y"), (2, "t"), (3, None), (4, "")]
    assert sorted(map(tuple, cleaned.collect())) == expected
    monkeypatch.setattr(decontamination, "MOST_WINDOWS", 1)
    assert sorted(map(tuple, decontamination.decontaminate(docs, items).collect())) == expected


def test_the_driver_holds_two_numbers_for_each_common_word(spark):
    docs = spark.createDataFrame([(" ".join(f"w{i}" for i in range(60_000)),)] * 4, "text string")
    tracemalloc.start()
    try:
        weights = near_dedup._idfs(docs)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(weights.words) == 60_000 and set(weights.idfs) == {1.0}
    assert peak < 6 << 20


def test_counts_of_cells_reach_the_driver_packed(spark, monkeypatch):
    words = " ".join(f"w{i}" for i in range(60_000))
    docs = spark.createDataFrame([(words,), (words,), (words + " z",), ("a b c d e f",), ("",), (None,)], "text string")
    weights = near_dedup._idfs(docs)
    expected = np.zeros(near_dedup.CELLS, np.int64)
    for r in docs.collect():
        np.add.at(expected, near_dedup._cell(weights.shingles(r.text and r.text.encode())[0]), 1)
    sent, as_arrow = [], type(docs).toArrow

    def counted(df):
        found = as_arrow(df)
        sent.append(found.nbytes)
        return found

    monkeypatch.setattr(type(docs), "toArrow", counted)
    counts = near_dedup._cell_counts(docs.repartition(3), spark.sparkContext.broadcast(weights))
    assert (counts == np.maximum(expected, 1)).all() and counts.max() >= 3
    assert (expected > 1).sum() > 59_000 and 0 < sum(sent) < 8 * 59_000  # as rows 16 bytes each
    # Texts without shingles leave nothing to count.
    none = near_dedup._cell_counts(docs.where("text = ''"), spark.sparkContext.broadcast(weights))
    assert (none == 1).all()
