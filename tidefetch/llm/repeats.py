"""Substring dedup: removes words of passages that an earlier document already has.

A window is ``size`` consecutive words of one document. A word goes if a window over it also
starts in a document with a smaller doc_id. Three passes:

1. Each document gives its anchors: in every window, the least hash of its ``GRAM``-word
   grams. Equal windows have equal anchors, so an anchor is in at least as many documents as
   each window it stands for. Neighbouring windows mostly share one, which leaves one anchor
   for about 16 words.
2. Count-min sketches count the documents of each anchor: ``DEPTH`` rows of cells, counted in
   each partition and then merged cell by cell. The width follows the number of anchors, so
   the share of wrong alarms is the same at every size. Merged counts only overestimate.
3. Only windows whose anchor is estimated in two documents or more are read again and
   grouped exactly, by a 128-bit hash of their words. None that repeats is lost.

Exact copies of a text need no windows: all but those with the least doc_id go whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefetch.llm.common import (
    among,
    lists,
    narrow_batches,
    ngrams,
    releasing,
    schema_with,
    settle,
    ship_package,
    sliding_min,
    utf8,
    with_columns,
    word_hashes,
)

WINDOW = 50
GRAM = 20
DEPTH = 2
#: Cells of a sketch row for each anchor.
CELLS = 4


def _anchors(words: list[bytes], size: int) -> np.ndarray:
    """The anchor of each window, by its start."""
    gram = min(GRAM, size)
    grams = ngrams(word_hashes.of(words), gram)
    return sliding_min(grams, size - gram + 1).view(np.int64) if len(words) >= size else np.empty(0, np.int64)


def _key(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


def _mark(key: bytes) -> int:
    """Tells rows of one doc_id apart."""
    return int.from_bytes(key[:8], "little", signed=True)


def _read_anchors(size: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in narrow_batches(batches, ("doc_id", "text")):
            keys, counts, anchors = [], [], []
            for text in utf8(texts):
                words = text.split() if text else []
                keys.append(_key(words))
                counts.append(len(words))
                anchors.append(np.unique(_anchors(words, size)))
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(keys, pa.binary()),
                    pa.array(map(_mark, keys), pa.int64()),
                    pa.array(counts, pa.int64()),
                    lists(anchors, pa.int64()),
                ],
                ["doc_id", "key", "mark", "n_words", "anchors"],
            )

    return read


def _read_windows(size: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, suspects in narrow_batches(batches, ("doc_id", "text", "suspects")):
            for doc_id, text, wanted in zip(ids.to_pylist(), utf8(texts), suspects):
                words = text.split() if text else []
                starts = np.flatnonzero(among(_anchors(words, size), np.sort(wanted.values.to_numpy())))
                if len(starts):
                    windows = b"".join([_key(words[s : s + size]) for s in starts.tolist()])
                    halves = np.frombuffer(windows, "<i8").reshape(-1, 2)
                    n = len(halves)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([doc_id] * n, pa.int64()),
                            pa.array([_mark(_key(words))] * n, pa.int64()),
                            pa.array(halves[:, 0].copy()),
                            pa.array(halves[:, 1].copy()),
                            pa.array(starts.astype(np.int32)),
                        ],
                        ["doc_id", "mark", "window", "window2", "start"],
                    )

    return read


def _cut(text: bytes, gone: np.ndarray) -> bytes:
    """The text without the words marked as gone and the white space after them."""
    data = np.frombuffer(text, np.uint8)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    starts = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    word = np.searchsorted(starts, np.arange(len(data)), side="right") - 1
    return data[np.where(word < 0, True, ~gone[np.maximum(word, 0)])].tobytes()


def _apply(size: int, columns: list[str]):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(batch.schema.get_field_index("text")))
            found = batch.column(batch.schema.get_field_index("__repeats")).to_pylist()
            out, total, removed = [], [], []
            for text, marks in zip(texts, found):
                words = text.split() if text else []
                gone = np.zeros(len(words), bool)
                own = _mark(_key(words)) if marks else 0
                for mark in marks or ():
                    if mark["mark"] != own:
                        continue
                    if mark["starts"] is None:  # a copy of an earlier document
                        gone[:] = True
                    else:
                        edges = np.zeros(len(words) + 1, np.int32)
                        starts = np.unique(np.asarray(mark["starts"], np.int64))
                        edges[starts] += 1
                        edges[starts + size] -= 1
                        gone |= np.cumsum(edges[:-1]) > 0
                total.append(len(words))
                removed.append(int(gone.sum()))
                out.append(_cut(text, gone) if removed[-1] else text)
            made = {
                "text": pa.array(out, pa.binary()).cast(pa.string()),
                "n_words": pa.array(total, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
            }
            yield with_columns(batch, made, ["__repeats"]).select(columns)

    return apply


def remove_repeats(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` with the repeated words cut out of ``text``, and n_words and n_removed.

    Words are runs of anything but ASCII white space. Windows are judged on the input. A null
    text stays null and has no words. A null doc_id is before or after nothing: such rows
    stay whole and remove nothing. Rows that repeat a doc_id are one document as to what is
    smaller, each with its own words. All columns of ``docs`` are kept, but n_words and
    n_removed replace columns of these names.
    """
    spark = docs.sparkSession
    ship_package(spark)
    input_ = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("doc_id is not null")
    read = settle(
        input_.mapInArrow(releasing(_read_anchors(size)), "doc_id long, key binary, mark long, n_words long, anchors array<long>"), "anchors"
    )

    copies = (
        read.where(F.col("n_words") >= size).groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    )
    later = (
        read.where(F.col("n_words") >= size)
        .join(copies.where("first < last").select("key", "first"), "key")
        .where("doc_id > first")
        .select("doc_id", "mark")
        .distinct()
    )
    later = settle(later, "copies")
    anchors = (
        read.where(F.size("anchors") > 0)
        .join(later, ["doc_id", "mark"], "left_anti")
        .select("doc_id", F.explode("anchors").alias("anchor"))
    )
    count = read.agg(F.sum(F.size("anchors"))).first()[0] or 0
    width = CELLS << max(0, int(count - 1)).bit_length()

    def cell(row: int):
        return F.pmod(F.xxhash64("anchor", F.lit(row)), F.lit(width)).alias("cell")

    # The partial counts of each partition are its sketch; the shuffle merges them.
    for row in range(DEPTH):
        sketch = anchors.select(cell(row)).groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
        at = anchors.select("doc_id", "anchor", cell(row))
        anchors = at.join(sketch, "cell", "left_semi").select("doc_id", "anchor")
    suspects = settle(anchors.groupBy("doc_id").agg(F.collect_set("anchor").alias("suspects")), "suspects")

    windows = settle(
        input_.join(suspects, "doc_id").mapInArrow(
            releasing(_read_windows(size)), "doc_id long, mark long, window long, window2 long, start int"
        ),
        "windows",
    )
    exact = (
        windows.groupBy("window", "window2")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where("first < last")
        .select("window", "window2", "first")
    )
    repeated = (
        windows.join(exact, ["window", "window2"])
        .where("doc_id > first")
        .groupBy("doc_id", "mark")
        .agg(F.collect_list("start").alias("starts"))
    )
    marks = reduce(
        DataFrame.unionByName,
        [repeated, later.withColumn("starts", F.lit(None).cast("array<int>"))],
    )
    marks = marks.groupBy(F.col("doc_id").alias("__id")).agg(F.collect_list(F.struct("mark", "starts")).alias("__repeats"))
    marks = settle(marks, "repeats")

    added = {"n_words": T.LongType(), "n_removed": T.LongType()}
    schema = schema_with(docs.withColumn("text", F.col("text").cast("string")).schema, {"text": T.StringType(), **added})
    joined = docs.join(marks, docs["doc_id"] == marks["__id"], "left").drop("__id")
    return joined.mapInArrow(_apply(size, schema.names), schema)


def digest(cleaned: DataFrame) -> DataFrame:
    """doc_id, the two counts and the hash of the words that are left, joined by one space."""
    words = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2(words, 256).alias("kept_sha256"))
