"""Download the files of a plan inside Spark tasks with a function of the user.

``fetch(file, options)`` gets the columns of one plan row as a dict and returns either the
payload as bytes, or its records as dicts with the keys ``logMetadata``, ``logContent``,
``rawFileBinary`` and ``error``. It raises ``DownloadError`` for a file that cannot be had:
that becomes one row with an error. Any other exception fails the task.

Records may come from a generator, which is drawn record by record, so a file of any number of
them takes the memory of one output batch. If it raises ``DownloadError`` on the way, the records
before stay, one row with the error follows, and the file counts as failed, without its bytes.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Collection, Iterator, Mapping
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass, field
from itertools import chain, islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidefetch.schema import INDEX_COLUMNS
from tidefetch.session import ship_package
from tidefetch.sources.client import opened

Fetch = Callable[[dict, Mapping[str, str]], "bytes | Iterator[dict]"]
Split = Callable[[bytes], dict]

# An output batch is closed at either bound: a row may hold a whole file.
BATCH_BYTES = 32 << 20
BATCH_ROWS = 2_000

_OUTCOME = [
    T.StructField("content", T.BinaryType()),
    T.StructField("logMetadata", T.StringType()),
    T.StructField("logContent", T.BinaryType()),
    T.StructField("rawFileBinary", T.BinaryType()),
    T.StructField("error", T.StringType()),
    T.StructField("_missing", T.StringType()),
    T.StructField("downloadTimestamp", T.TimestampType(), False),
    T.StructField("file_ok", T.IntegerType(), False),
    T.StructField("file_failed", T.IntegerType(), False),
    T.StructField("bytes", T.LongType(), False),
    T.StructField("ms", T.LongType(), False),
    # Figures of the whole task, on its last row only.
    T.StructField("task_files", T.LongType()),
    T.StructField("task_failed", T.LongType()),
    T.StructField("task_records", T.LongType()),
    T.StructField("task_bytes", T.LongType()),
    T.StructField("task_ms", T.LongType()),
    # A row of a task whose files hold no record; it is there for the figures alone.
    T.StructField("no_record", T.BooleanType(), False),
]


class DownloadError(Exception):
    """A file that cannot be downloaded; its text becomes the ``error`` of the row."""


@dataclass(frozen=True)
class ReadAhead:
    """Keep up to ``files`` downloads in flight on ``threads`` threads of a task.

    Rows come in the order in which downloads finish. The task fails when none of them
    finishes within ``wait_seconds``. Records of a generator are drawn when its turn has come.
    """

    files: int = 20
    threads: int = 4
    wait_seconds: float = 120.0


@dataclass
class _Download:
    """A file that was asked for: its payload, its records still to come, or the error."""

    row: dict
    got: bytes | Iterator[dict] | None
    error: str | None
    ms: int
    size: int = 0

    def records(self, split: Split | None = None) -> Iterator[dict]:
        if self.error is not None:
            yield {"_missing": self.error}
        elif isinstance(self.got, bytes):
            self.size = len(self.got)
            yield {"content": self.got} if split is None else split(self.got)
        else:
            while (record := self._next()) is not None:
                yield record

    def _next(self) -> dict | None:
        started = time.monotonic()
        try:
            record = next(self.got, None)
            self.size += _weight(record or {})
        except DownloadError as failure:
            self.error, self.size, self.got = str(failure), 0, iter(())
            record = {"_missing": self.error}
        self.ms += int((time.monotonic() - started) * 1000)
        return record


@dataclass
class _Figures:
    started: float = field(default_factory=time.monotonic)
    files: int = 0
    failed: int = 0
    records: int = 0
    size: int = 0

    def add(self, download: _Download) -> None:
        self.files += download.error is None
        self.failed += download.error is not None
        self.size += download.size

    def columns(self) -> dict:
        return {
            "task_files": self.files,
            "task_failed": self.failed,
            "task_records": self.records,
            "task_bytes": self.size,
            "task_ms": int((time.monotonic() - self.started) * 1000),
        }


def download(
    plan: DataFrame,
    fetch: Fetch | type,
    options: Mapping[str, str] | None = None,
    read_ahead: ReadAhead | None = None,
    without: Collection[str] = (),
    split: Split | None = None,
) -> DataFrame:
    """Rows of every file of ``plan``, downloaded in the tasks of its partitions.

    The plan keeps its index columns; other columns are for ``fetch`` alone, except
    ``partition_id``, ``rn`` and ``step``, which are passed on as well. Instead of a function
    ``fetch`` may be a client class; each task then opens a client and closes it at its end.

    ``file_ok``, ``file_failed``, ``bytes`` and ``ms`` of a file are on its last row, the figures of
    a task on its last row. A task whose files hold no record has one row with ``no_record``, which
    ``as_records`` leaves out.

    ``without`` names payload columns that are not wanted: they do not leave the task. ``split`` then
    makes the columns of a payload's record in the task, where Spark could not any more.
    """
    ship_package(plan.sparkSession)
    kept = [f for f in plan.schema.fields if f.name in (*INDEX_COLUMNS, "partition_id", "rn", "step")]
    schema = T.StructType(kept + [f for f in _OUTCOME if f.name not in without])
    arrow = to_arrow_schema(schema)
    settings = dict(options or {})
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not isinstance(fetch, type):
            yield from task(batches, fetch)
            return
        # A task without files opens no client.
        filled = (batch for batch in batches if batch.num_rows)
        first = next(filled, None)
        if first is None:
            return
        batches = chain([first], filled)
        with opened(fetch, settings) as client:
            yield from task(batches, client.fetch)

    def task(batches: Iterator[pa.RecordBatch], fetch: Fetch) -> Iterator[pa.RecordBatch]:
        figures = _Figures()
        rows = (row for batch in batches for row in _rows(batch))
        done = _one_by_one(rows, fetch, settings) if read_ahead is None else _ahead(rows, fetch, settings, read_ahead)
        last: dict | None = None
        file: dict = {}
        batch = _Batch(arrow)
        for file_ in done:
            own = False
            file = {name: file_.row[name] for name in names}
            for record in file_.records(split):
                if last is not None and batch.add(last):
                    yield batch.close()
                last, own = _output(file, record), True
                figures.records += 1
            figures.add(file_)
            if own:
                ok = file_.error is None
                last |= {"file_ok": int(ok), "file_failed": int(not ok), "bytes": file_.size, "ms": file_.ms}
        if last is None and file:
            last = {**_output(file, {}), "no_record": True}
        if last is not None:
            batch.add({**last, **figures.columns()})
            yield batch.close()

    return plan.mapInArrow(run, schema)


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    columns = batch.schema.names
    for i in range(batch.num_rows):
        yield {name: batch.column(c)[i].as_py() for c, name in enumerate(columns)}


def _attempt(row: dict, fetch: Fetch, options: Mapping[str, str]) -> _Download:
    started, error = time.monotonic(), None
    try:
        got = fetch(row, options)
        got = bytes(got) if isinstance(got, (bytes, bytearray, memoryview)) else iter(got)
    except DownloadError as failure:
        got, error = None, str(failure)
    return _Download(row, got, error, int((time.monotonic() - started) * 1000))


def _weight(record: dict) -> int:
    return sum(len(record.get(c) or b"") for c in ("content", "logContent", "rawFileBinary"))


def _one_by_one(rows: Iterator[dict], fetch: Fetch, options: Mapping[str, str]) -> Iterator[_Download]:
    for row in rows:
        yield _attempt(row, fetch, options)


def _ahead(
    rows: Iterator[dict], fetch: Fetch, options: Mapping[str, str], ahead: ReadAhead
) -> Iterator[_Download]:
    pool = ThreadPoolExecutor(ahead.threads)
    flying = set()
    try:
        while True:
            flying |= {pool.submit(_attempt, row, fetch, options) for row in islice(rows, ahead.files - len(flying))}
            if not flying:
                return
            done, flying = wait(flying, ahead.wait_seconds, FIRST_COMPLETED)
            if not done:
                raise TimeoutError(f"no download finished within {ahead.wait_seconds} s")
            for finished in done:
                yield finished.result()
    finally:
        pool.shutdown(wait=False, cancel_futures=True)


def _output(file: dict, record: dict) -> dict:
    return {
        **file,
        **record,
        "downloadTimestamp": int(time.time() * 1000) * 1000,
        "file_ok": 0,
        "file_failed": 0,
        "bytes": 0,
        "ms": 0,
        "no_record": False,
    }


class _Batch:
    """Rows of one Arrow batch, closed before it grows past the bounds."""

    def __init__(self, schema: pa.Schema):
        self.schema = schema
        self.rows: list[dict] = []
        self.size = 0

    def add(self, row: dict) -> bool:
        """Add a row; tell whether the batch should be closed."""
        self.rows.append(row)
        self.size += _weight(row)
        return self.size >= BATCH_BYTES or len(self.rows) >= BATCH_ROWS

    def close(self) -> pa.RecordBatch:
        batch = pa.RecordBatch.from_pylist(self.rows, self.schema)
        self.rows, self.size = [], 0
        return batch
