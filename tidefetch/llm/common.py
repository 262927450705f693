"""What the corpus operators share: words and their hashes, and Arrow batches with columns replaced."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefetch.session import discard, fresh_path, settle, shared_folder, ship_package

__all__ = ["discard", "fresh_path", "settle", "shared_folder", "ship_package"]

#: Lower-cases A-Z and turns every ASCII character that is no letter or digit into a space.
_PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_FACTOR = 0x9E3779B97F4A7C15
_ALL = (1 << 64) - 1


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """The UTF-8 bytes of a text column."""
    return column.cast(pa.binary()).to_pylist()


def plain(text: bytes) -> bytes:
    return text.translate(_PLAIN)


def plain_words(text: bytes) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and all other characters beyond ASCII."""
    return text.translate(_PLAIN).split()


class WordHashes(dict):
    """64-bit hashes of words. Forgets all of them when it has grown to ``most``."""

    def __init__(self, most: int = 200_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.most:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


#: One table for all operators that run in a Python worker.
word_hashes = WordHashes()


#: What else an operator keeps in a Python worker from task to task, by name: the function that gives it up.
kept: dict[str, Callable[[], None]] = {}


def releasing(run):
    """A task function that gives up the word hashes and freed Arrow memory at its end, as workers live on for other stages.

    What other operators have kept is given up at its start.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for give_up in kept.values():
                give_up()
            yield from run(batches)
        finally:
            word_hashes.clear()
            pa.default_memory_pool().release_unused()

    return task


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all others."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def ngrams(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive words: blocks of doubled length are put together."""
    if len(hashes) < size:
        return hashes[:0]
    whole, done, block, length, power = None, 0, hashes, 1, _FACTOR
    while True:
        if size & length:
            if whole is None:
                whole, done = block, length
            else:
                n = len(hashes) - done - length + 1
                whole = whole[:n] * np.uint64(power) + block[done : done + n]
                done += length
        if done == size:
            return mix(whole)
        n = len(hashes) - 2 * length + 1
        block = block[:n] * np.uint64(power) + block[length : length + n]
        length, power = 2 * length, power * power & _ALL


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """The least of every ``size`` consecutive values."""
    length = 1
    while 2 * length <= size:
        values = np.minimum(values[: len(values) - length], values[length:])
        length *= 2
    rest = size - length
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in ``known``, which is sorted."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def lists(arrays: Iterable[np.ndarray], kind: pa.DataType) -> pa.Array:
    """An Arrow list column, one list for each array."""
    arrays = list(arrays)
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


def with_columns(batch: pa.RecordBatch, columns: dict[str, pa.Array], drop: Iterable[str] = ()) -> pa.RecordBatch:
    """The batch with these columns, in place of those of the same name, and without ``drop``."""
    gone = {*columns, *drop}
    kept = [i for i, name in enumerate(batch.schema.names) if name not in gone]
    return pa.RecordBatch.from_arrays(
        [batch.column(i) for i in kept] + list(columns.values()),
        [batch.schema.names[i] for i in kept] + list(columns),
    )


def schema_with(schema: T.StructType, columns: dict[str, T.DataType], drop: Iterable[str] = ()) -> T.StructType:
    """The schema that ``with_columns`` makes."""
    gone = {*columns, *drop}
    return T.StructType(
        [f for f in schema.fields if f.name not in gone] + [T.StructField(n, t) for n, t in columns.items()]
    )


def narrow_batches(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[list]:
    """The columns ``names`` of each batch that has rows."""
    for batch in batches:
        if batch.num_rows:
            yield [batch.column(batch.schema.get_field_index(n)) for n in names]


def evaluate_once(docs: DataFrame, name: str, **columns: Column) -> DataFrame:
    """``docs`` with these columns as the fields of a struct ``name``.

    A plain projection may be merged into later ones, and then a costly expression would be
    computed at each place, or for each element of an array, where it is used. Spark does not
    merge what stands below a generator.
    """
    fields = F.struct(*[column.alias(field) for field, column in columns.items()])
    return docs.select("*", F.explode(F.array(fields)).alias(name))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(doc_id: Column, modulus: int, rest: int) -> Column:
    """Whether crc32 of the id as text leaves ``rest``; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == rest, F.lit(False))
