"""Best-fit packing of documents into sequences of tokens by the sum-of-squares rule.

A piece goes where the squared counts of open sequences per residual gap add up to least
afterwards: into an open sequence, or into a new one. Pieces are dealt at random over shards of
about ``SHARD_TOKENS`` tokens, so no task grows with the input; each shard is packed by itself,
its largest pieces first.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefetch.llm.common import schema_with, settle, ship_package
from tidefetch.llm.tokens import encoder, frugal

CAPACITY = 4096
#: Some thousand documents, a thousand sequences.
SHARD_TOKENS = 1 << 22


def _pieces(path: str, capacity: int, end_id: int):
    end = np.asarray([end_id], "<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, size = encoder(path).encode, 4 * capacity
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                out = [[], [], [], []]
                for doc_id, ids in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist())):
                    ids += end
                    for number, start in enumerate(range(0, len(ids), size)):
                        for column, value in zip(out, (doc_id, number, start // 4, ids[start : start + size])):
                            column.append(value)
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, k) for v, k in zip(out, kinds)], ["doc_id", "piece", "start", "ids"]
                )

    return pieces


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length and ids (little-endian unsigned 32-bit) of each piece.

    Each row of ``docs`` is a document: its ids and the end id. A null or empty text is the end
    id alone. Only documents longer than ``capacity`` are cut. Rows that repeat a doc_id, or
    have none, are packed as documents of their own. Other columns play no part.
    """
    ship_package(docs.sparkSession)
    return (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .mapInArrow(frugal(_pieces(tokenizer, capacity, end_id)), "doc_id long, piece int, start long, ids binary")
        .select("doc_id", "piece", "start", (F.length("ids") / 4).cast("long").alias("length"), "ids")
    )


def sum_of_squares(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """The sequence and the place in it of each piece, in the order in which they come."""
    open_with = np.zeros(capacity + 1, np.int64)  # open sequences by gap; a full one is not open
    waiting: dict[int, list[int]] = defaultdict(list)
    never = np.iinfo(np.int64).max
    sequences, offsets, used = [], [], 0
    for length in lengths:
        # Moving a sequence from gap g to g - length changes the sum by 2 * (N[g - length] - N[g]) + 2.
        cost = 2 * (open_with[: capacity - length + 1] - open_with[length:]) + 2
        cost[0] -= 1  # a sequence that becomes full is counted nowhere
        cost[open_with[length:] == 0] = never
        cost[capacity - length] = 2 * open_with[capacity - length] + 1 if length < capacity else 0
        gap = int(cost.argmin()) + length
        if gap == capacity:
            sequence, used = used, used + 1
        else:
            sequence = waiting[gap].pop()
            open_with[gap] -= 1
        sequences.append(sequence)
        offsets.append(capacity - gap)
        if gap > length:
            waiting[gap - length].append(sequence)
            open_with[gap - length] += 1
    return sequences, offsets


def _pack(capacity: int):
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        sequences, offsets = sum_of_squares(rows["length"].tolist(), capacity)
        rows["sequence_id"] = (rows["__shard"].astype("int64") * (1 << 32)) + np.asarray(sequences, np.int64)
        rows["offset"] = np.asarray(offsets, np.int64)
        return rows.drop(columns="__shard")

    return pack


def place(pieces: DataFrame, capacity: int = CAPACITY, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """``pieces`` (doc_id, piece, length and any others) with sequence_id and offset.

    The table is read twice, once for the number of tokens, so it should be a written one. Pieces
    are dealt by their rows, so those of one doc_id, or without one, spread like all others. No
    pieces give no rows. sequence_id and offset replace columns of these names.
    """
    tokens = pieces.agg(F.sum("length")).first()[0] or 0
    shards = max(1, -(-tokens // shard_tokens))
    schema = schema_with(pieces.schema, {"sequence_id": T.LongType(), "offset": T.LongType()})
    dealt = pieces.drop("sequence_id", "offset").withColumn(
        "__shard", F.pmod(F.xxhash64("doc_id", "piece", "start", F.monotonically_increasing_id()), F.lit(shards))
    )
    return dealt.groupBy("__shard").applyInPandas(_pack(capacity), schema)


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id and the ids of each packed sequence, from placed pieces that kept their ids."""
    rows = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    whole = F.aggregate("parts", F.lit(b""), lambda all_, part: F.concat(all_, part["ids"]))
    return rows.select("sequence_id", whole.alias("ids"))


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of ``docs``."""
    pieces = cut_pieces(docs, tokenizer, end_id, capacity)
    narrow = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return place(settle(narrow, "pieces"), capacity)
