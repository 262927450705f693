"""The named format: ``spark.read.format("tidefetch")`` over a published listing.

A listing is written to a folder by the partition that reads it. The data source plans pointers to
those parts only, so no listing passes the driver; each task reads the files of its own part,
downloads them and gives records under the fixed schema.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import datetime

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from tidefetch.operators.download import _ahead, _Batch, _one_by_one, _rows
from tidefetch.operators.ordering import BY_TIME, round_robin, used_partitions
from tidefetch.operators.payload import separate
from tidefetch.schema import INDEX_COLUMNS, INDEX_SCHEMA, RECORD_SCHEMA
from tidefetch.session import fresh_path, ship_package
from tidefetch.sources.client import opened
from tidefetch.sources.options import RemoteOptions, client_class
from tidefetch.streaming.plan import read_steps

NAME = "tidefetch"
_TIMES = [f.name for f in INDEX_SCHEMA.fields if isinstance(f.dataType, T.TimestampType)]


def publish(
    index: DataFrame, partitions: int = 4, order_by: Sequence[str | Column] = BY_TIME, folder: str | None = None
) -> str:
    """Writes an index for the named format, spread round-robin over ``partitions``; the folder.

    Columns beside the index columns, such as addresses, are passed on to the client's ``fetch``.
    """
    spark = index.sparkSession
    folder = folder or fresh_path(spark, "published")
    dealt = round_robin(index, partitions, order_by).withColumn("step", F.lit(0))
    parts = used_partitions(dealt, partitions)
    placed = dealt.repartitionById(parts, F.col("partition_id")).sortWithinPartitions("partition_id", "rn")
    placed.write.partitionBy("step", "partition_id").parquet(folder)
    return folder


def register(spark: SparkSession) -> None:
    """Make the format known to a session."""
    ship_package(spark)
    spark.dataSource.register(TidefetchSource)


class TidefetchSource(DataSource):
    """Options: ``listing`` (a published folder), ``remoteClient`` (``module:Class``), and those of a remote read."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> T.StructType:
        return RECORD_SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        if [(f.name, f.dataType) for f in schema.fields] != [(f.name, f.dataType) for f in RECORD_SCHEMA.fields]:
            raise ValueError("a remote source has a fixed schema and takes no other")
        given = dict(self.options)
        if not given.get("listing"):
            raise ValueError("'listing' must name a folder that publish() has written")
        return _Reader(given)


class _Reader(DataSourceReader):
    def __init__(self, given: dict[str, str]):
        self.listing = given["listing"].rstrip("/")
        self.kind = client_class(next((v for k, v in given.items() if k.lower() == "remoteclient"), None))
        own = {k: v for k, v in given.items() if k.lower() not in ("listing", "remoteclient")}
        self.options = RemoteOptions.parse(own if {"uri", "path"} & {k.lower() for k in own} else {**own, "path": self.listing})
        if self.kind.parser not in (None, "separator"):
            raise ValueError("the named format splits payloads by separator or not at all; use remote(spark) for others")

    def partitions(self) -> list[InputPartition]:
        system, root = fs.FileSystem.from_uri(self.listing)
        found = system.get_file_info(fs.FileSelector(f"{root}/step=0", allow_not_found=True))
        parts = sorted(int(i.base_name.removeprefix("partition_id=")) for i in found if i.base_name.startswith("partition_id="))
        return [InputPartition(p) for p in parts] or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition.value is None:
            return
        pointer = pa.RecordBatch.from_pydict({"step": [0], "partition_id": [partition.value]})
        files = (row for batch in read_steps(self.listing, None)(iter([pointer])) for row in _rows(batch))
        with opened(self.kind, self.options.passed) as client:
            ahead = self.options.read_ahead
            how = (client.fetch, self.options.passed)
            done = _one_by_one(files, *how) if ahead is None else _ahead(files, *how, ahead)
            batch = _Batch(to_arrow_schema(RECORD_SCHEMA))
            for download in done:
                for record in download.records():
                    if batch.add(_record(download.row, record, self.kind.parser)):
                        yield batch.close()
            if batch.rows:
                yield batch.close()


def _millis(value: datetime | None) -> datetime | None:
    return value and value.replace(microsecond=value.microsecond // 1000 * 1000)


def _record(file: dict, got: dict, parser: str | None) -> dict:
    """A record as ``as_records`` makes it."""
    source = {name: file.get(name) for name in INDEX_COLUMNS}
    if source["name"] is None or source["fetchedAt"] is None:
        raise ValueError("a listed file needs a name and the time it was listed")
    source |= {name: _millis(source[name]) for name in _TIMES}
    row = {f.name: got.get(f.name) for f in RECORD_SCHEMA.fields}
    row |= {"sourceFile": source, "downloadTimestamp": _millis(datetime.now().astimezone())}
    if "_missing" in got:
        row["error"] = got["_missing"]
    elif "content" in got:
        row |= {"rawFileBinary": got["content"]} if parser is None else separate(got["content"])
    return row
