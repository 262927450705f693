"""Benchmark decontamination: words of documents that are in a window of a benchmark item.

The windows of all items are hashed and broadcast; tasks hash every window of a document and
look it up. A hash that is found is verified by its words. The broadcast has a checked size:
more than ``MOST_WINDOWS`` windows are searched in blocks of that many, each in its own pass,
and what the blocks find is put together.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefetch.llm.common import (
    WordHashes,
    among,
    lists,
    ngrams,
    plain,
    plain_words,
    releasing,
    schema_with,
    settle,
    ship_package,
    utf8,
    with_columns,
    word_hashes,
)

WINDOW = 10
MOST_WINDOWS = 1_000_000


def _item_windows(size: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, windows = [], []
            for name, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                words = plain_words(text) if text else []
                n = min(size, len(words))
                for i in range(len(words) - n + 1 if words else 0):
                    names.append(name)
                    windows.append(b" ".join(words[i : i + n]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(windows, pa.binary()), pa.array(names, pa.string())], ["window", "item"]
            )

    return read


class WindowIndex:
    """Windows of items by length and hash. It is broadcast."""

    def __init__(self, rows: list[tuple[bytes, list[str]]]):
        self.items: dict[bytes, tuple[str, ...]] = {bytes(w): tuple(names) for w, names in rows}
        hashes = WordHashes(1 << 62)
        by_length: dict[int, list[int]] = defaultdict(list)
        for window in self.items:
            words = window.split()
            by_length[len(words)].append(int(ngrams(hashes.of(words), len(words))[0]))
        self.hashes = {n: np.unique(np.asarray(h, np.uint64)) for n, h in by_length.items()}
        # A first look at 22 bits of a hash spares most windows the search.
        self.seen = {n: np.zeros(1 << 22, bool) for n in self.hashes}
        for n, h in self.hashes.items():
            self.seen[n][(h >> np.uint64(42)).astype(np.int64)] = True

    def find(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """The words that are hit, as marks, and the items."""
        hit, names = np.zeros(len(words) + 1, np.int32), set()
        hashes = word_hashes.of(words)
        for n, known in self.hashes.items():
            grams = ngrams(hashes, n)
            starts = np.flatnonzero(self.seen[n][(grams >> np.uint64(42)).astype(np.int64)])
            for start in starts[among(grams[starts], known)].tolist():
                owners = self.items.get(b" ".join(words[start : start + n]))
                if owners:
                    hit[start] += 1
                    hit[start + n] -= 1
                    names.update(owners)
        return np.cumsum(hit[:-1]) > 0, names


def _runs(marks: np.ndarray) -> np.ndarray:
    """The first and the end of each run of marks, flat."""
    return np.flatnonzero(np.diff(np.concatenate([[0], marks.view(np.int8), [0]]))).astype(np.int32)


def _scan(shared):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            counts, runs, items = [], [], []
            for text in utf8(batch.column(batch.schema.get_field_index("text"))):
                words = plain_words(text) if text else []
                marks, names = index.find(words)
                counts.append(len(words))
                runs.append(_runs(marks))
                items.append(sorted(names))
            made = {
                "n_words": pa.array(counts, pa.int64()),
                "hit_runs": lists(runs, pa.int32()),
                "items": pa.array(items, pa.list_(pa.string())),
            }
            yield with_columns(batch, made)

    return scan


def _merge_runs(runs: pa.Array) -> pa.Array:
    """Puts overlapping runs of several blocks together."""
    out = []
    for flat in runs.to_pylist():
        ends: list[int] = []
        for a, b in sorted(zip(flat[::2], flat[1::2])):
            if ends and a <= ends[-1]:
                ends[-1] = max(ends[-1], b)
            else:
                ends += [a, b]
        out.append(np.asarray(ends, np.int32))
    return lists(out, pa.int32())


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index
        items = [sorted(set(names)) for names in batch.column(at("items")).to_pylist()]
        made = {"hit_runs": _merge_runs(batch.column(at("hit_runs"))), "items": pa.array(items, pa.list_(pa.string()))}
        yield with_columns(batch, made).select(batch.schema.names)


_FOUND = {
    "n_words": T.LongType(),
    "hit_runs": T.ArrayType(T.IntegerType()),
    "items": T.ArrayType(T.StringType()),
}


def find_hits(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, most: int = MOST_WINDOWS) -> DataFrame:
    """``docs`` with n_words, hit_runs (first word and end of each run of hit words, flat) and items.

    Words are lower-cased (A-Z only) runs of ASCII letters, digits and characters beyond
    ASCII. An item of fewer words than a window is one window; one without words or with a
    null id is none. A null or empty text has no words. The three columns replace columns of
    these names. Rows of ``docs`` may repeat: each gets its own result.
    """
    return _found(docs, benchmark, size, most)


def _then(*runs):
    """One task function that passes batches through several, so that a task needs one Python worker."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs:
            batches = run(batches)
        yield from batches

    return task


def _found(docs: DataFrame, benchmark: DataFrame, size: int, most: int, *after) -> DataFrame:
    """What ``find_hits`` returns, passed through the task functions ``after`` in the last pass."""
    spark = docs.sparkSession
    ship_package(spark)
    windows = settle(
        benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
        .where("item_id is not null")
        .mapInArrow(_item_windows(size), "window binary, item string")
        .groupBy("window")
        .agg(F.collect_set("item").alias("items"))
        .withColumn("block", F.xxhash64("window")),
        "windows",
    )
    blocks = max(1, -(-windows.count() // most))
    docs = docs.withColumn("text", F.col("text").cast("string"))
    schema = schema_with(docs.schema, _FOUND)
    whole = None
    for block in range(blocks):
        rows = windows.where(F.pmod("block", F.lit(blocks)) == block).select("window", "items").collect()
        shared = spark.sparkContext.broadcast(WindowIndex([(r[0], r[1]) for r in rows]))
        if whole is None:
            whole = docs.mapInArrow(releasing(_then(_scan(shared), *after) if blocks == 1 else _scan(shared)), schema)
        else:
            old = {n: F.col(n).alias(f"__{n}") for n in ("hit_runs", "items")}
            kept = whole.select("*", *old.values())
            more = schema_with(kept.schema, _FOUND)
            whole = kept.mapInArrow(releasing(_scan(shared)), more)
            for name in old:
                whole = whole.withColumn(name, F.concat(name, f"__{name}")).drop(f"__{name}")
            whole = whole.select(*schema.names)
    return whole if blocks == 1 else whole.mapInArrow(_then(_merge, *after), schema)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index
        texts = utf8(batch.column(at("text")))
        for i, flat in enumerate(batch.column(at("hit_runs")).to_pylist()):
            if flat:
                data = np.frombuffer(plain(texts[i]), np.uint8)
                blank = data == 32
                starts = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
                bounds = np.append(starts, len(data))
                keep = np.ones(len(data), bool)
                for a, b in zip(flat[::2], flat[1::2]):
                    keep[bounds[a] : bounds[b]] = False
                texts[i] = np.frombuffer(texts[i], np.uint8)[keep].tobytes()
        made = {"text": pa.array(texts, pa.binary()).cast(pa.string())}
        yield with_columns(batch, made).select(batch.schema.names)


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "spans", size: int = WINDOW) -> DataFrame:
    """``docs`` without what ``benchmark`` has: without the hit words and what stands after each, or
    with ``remove="documents"`` without the documents that have any. Columns as in ``docs``."""
    if remove == "documents":
        return find_hits(docs, benchmark, size).where(F.size("hit_runs") == 0).select(*docs.columns)
    if remove != "spans":
        raise ValueError(f"remove is 'spans' or 'documents', not {remove!r}")
    clashing = [n for n in _FOUND if n in docs.columns]
    if clashing:  # carry the document's own columns past the scan
        safe = docs.select(*[F.col(n).alias(f"__own_{n}") if n in clashing else F.col(n) for n in docs.columns])
        cut = decontaminate(safe, benchmark, remove, size)
        return cut.select(*[F.col(f"__own_{n}").alias(n) if n in clashing else F.col(n) for n in docs.columns])
    return _found(docs, benchmark, size, MOST_WINDOWS, _cut).select(*docs.columns)


def digest(found: DataFrame) -> DataFrame:
    runs = F.col("hit_runs")
    hit = F.aggregate(
        F.transform(runs, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0).cast("long"), lambda s, x: s + x
    )
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size(runs) > 0).alias("contaminated"),
    )
