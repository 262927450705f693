"""Payloads packed into blobs, and their addresses: a file is a range of bytes of a blob.

A table of payloads becomes some large blobs in a folder that all tasks reach, and an index of
addresses (name, blob, offset, length). Listing, order and spread then move addresses only, and
each task reads the ranges of its own files.
"""

from __future__ import annotations

import uuid
from collections import OrderedDict
from collections.abc import Iterator, Mapping
from threading import Lock

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidefetch.operators.download import DownloadError
from tidefetch.operators.payload import NOT_FOUND
from tidefetch.session import fresh_path, settle, ship_package

#: Bytes after which a task begins a new blob.
BLOB_BYTES = 128 << 20
#: Blobs that a task holds open at once.
OPEN_BLOBS = 16

ADDRESS = T.StructType(
    [T.StructField("blob", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("length", T.LongType())]
)
ADDRESSES = T.StructType([T.StructField("name", T.StringType()), *ADDRESS.fields])


def _pack(folder: str, blob_bytes: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        # Named for the attempt, so a lost or repeated task spoils nothing that has an address.
        task, number, out, size = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}", 0, None, 0
        for batch in batches:
            rows = []
            for name, content in zip(batch.column(0), batch.column(1)):
                if not content.is_valid:
                    continue
                if out is None:
                    blob = f"{folder}/{task}-{number:04d}.blob"
                    system.create_dir(root, recursive=True)
                    out, size = system.open_output_stream(f"{root}/{task}-{number:04d}.blob", compression=None), 0
                data = content.as_buffer()
                out.write(data)
                rows.append((name.as_py(), blob, size, data.size))
                size += data.size
                if size >= blob_bytes:
                    out.close()
                    out, number = None, number + 1
            columns = list(zip(*rows)) or [[]] * 4
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ADDRESSES.fieldNames())
        if out is not None:
            out.close()

    return pack


def write_blobs(payload: DataFrame, folder: str | None = None, blob_bytes: int = BLOB_BYTES) -> DataFrame:
    """Packs payloads (``name``, binary ``content``) into blobs; the written table of their addresses.

    Payloads are written where they are read and never shuffled. A null content has no address.
    """
    spark = payload.sparkSession
    ship_package(spark)
    packed = payload.select("name", "content").mapInArrow(_pack(folder or fresh_path(spark, "blobs"), blob_bytes), ADDRESSES)
    return settle(packed, "addresses")


def with_addresses(index: DataFrame, addresses: DataFrame) -> DataFrame:
    """The index with blob, offset and length of each file; nulls for a file that is not in a blob."""
    return index.join(addresses, "name", "left")


class BlobReader:
    """Fetches ranges of blobs: the ``fetch`` of an index with addresses. A task has one of its own.

    Blobs stay open for the files to come, as neighbours are often in one. Threads of a read-ahead
    share them.
    """

    def __init__(self, options: Mapping[str, str] | None = None):
        self._open: OrderedDict[str, pa.NativeFile] = OrderedDict()
        self._lock = Lock()

    def _blob(self, blob: str) -> pa.NativeFile:
        with self._lock:
            file = self._open.get(blob)
            if file is None:
                system, path = fs.FileSystem.from_uri(blob)
                file = self._open[blob] = system.open_input_file(path)
                if len(self._open) > OPEN_BLOBS:
                    # Closed once nobody reads it any more.
                    self._open.popitem(last=False)
            self._open.move_to_end(blob)
            return file

    def fetch(self, file: dict, options: Mapping[str, str]) -> bytes:
        if file["blob"] is None:
            raise DownloadError(NOT_FOUND + file["name"])
        try:
            data = self._blob(file["blob"]).read_at(file["length"], file["offset"])
        except FileNotFoundError as missing:
            raise DownloadError(NOT_FOUND + file["name"]) from missing
        if len(data) != file["length"]:
            raise DownloadError(f"Range beyond the end of the blob: {file['name']}")
        return data

    def close(self) -> None:
        for file in self._open.values():
            file.close()
        self._open.clear()
