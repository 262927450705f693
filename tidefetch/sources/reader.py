"""Front door: read a remote source as a batch or as a stream."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefetch.operators.download import Fetch, ReadAhead, Split, download
from tidefetch.operators.merge import unique_index
from tidefetch.operators.metrics import observe_metrics
from tidefetch.operators.ordering import BY_TIME, place, round_robin, used_partitions
from tidefetch.operators.payload import as_records, separate, with_payload
from tidefetch.schema import RECORD_SCHEMA
from tidefetch.session import settle
from tidefetch.sources.client import opened
from tidefetch.sources.options import RemoteOptions, client_class
from tidefetch.streaming.stream import RemoteStream


def read_remote(
    index: DataFrame,
    fetch: Fetch | type,
    partitions: int = 4,
    order_by: Sequence[str | Column] = BY_TIME,
    parser: str | None = "separator",
    options: Mapping[str, str] | None = None,
    read_ahead: ReadAhead | None = None,
    observation: Observation | None = None,
    broadcastable: bool = False,
    keep: Sequence[str] = (),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Records of all files of an index: order, spread, download, split.

    Only the index is shuffled; payloads are read in the tasks. Fewer files than ``partitions``
    make as many tasks as there are files. Filter the index to read
    less, as Spark cannot move filters through a download. With ``columns`` only these fields of the
    records are given, and payloads that none of them needs do not leave the tasks.
    """
    dealt = round_robin(index, partitions, order_by)
    plan = place(dealt, used_partitions(dealt, partitions))
    wanted = set(RECORD_SCHEMA.fieldNames() if columns is None else columns)
    without, split = _pruned(wanted, parser)
    downloaded = download(plan, fetch, options, read_ahead, without, split)
    records = _records(downloaded, parser, observation, broadcastable, keep)
    return records if columns is None else records.select(*keep, *[c for c in records.columns if c in wanted])


def _pruned(wanted: set[str], parser: str | None) -> tuple[tuple[str, ...], Split | None]:
    """Payload columns that need not leave the tasks, and how payloads are then split inside them."""
    if wanted & {"logContent", "rawFileBinary"} or parser not in (None, "separator"):
        return (), None
    return ("content", "logContent", "rawFileBinary"), separate if parser else _nothing


def _nothing(content: bytes) -> dict:
    return {}


def _records(
    downloaded: DataFrame,
    parser: str | None,
    observation: Observation | str | None,
    broadcastable: bool,
    keep: Sequence[str] = (),
) -> DataFrame:
    if observation is not None:
        downloaded = observe_metrics(downloaded, observation)
    records = as_records(downloaded, parser, keep)
    # The estimated size is that of the index, far below that of the payloads: without
    # the hint Spark would broadcast downloaded files.
    return records if broadcastable else records.hint("merge")


def read_table(
    index: DataFrame,
    payload: DataFrame,
    partitions: int = 4,
    order_by: Sequence[str | Column] = BY_TIME,
    parser: str | None = "separator",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Records of all files of an index whose payloads are a table (``name``, ``content``).

    Payloads stay on the JVM side and are shuffled once, by name; the spread only shows
    in ``partition_id`` and ``slot``.
    """
    plan = round_robin(index, partitions, order_by)
    found = with_payload(plan, payload).withColumn("downloadTimestamp", F.current_timestamp())
    return as_records(found, parser, keep)


class RemoteReader:
    """``remote(spark).option(...).load()``, in the manner of ``spark.read``."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._options: dict[str, object] = {}
        self._client: object = None
        self._observation: Observation | str | None = None
        self._broadcastable = False

    def option(self, key: str, value: object) -> RemoteReader:
        if key.lower() == "remoteclient":
            self._client = value
        else:
            self._options[key] = str(value).lower() if isinstance(value, bool) else value
        return self

    def options(self, **options: object) -> RemoteReader:
        for key, value in options.items():
            self.option(key, value)
        return self

    def schema(self, schema: T.StructType) -> RemoteReader:
        """The schema is fixed: any other one is refused."""
        if [(f.name, f.dataType) for f in schema.fields] != [(f.name, f.dataType) for f in RECORD_SCHEMA.fields]:
            raise ValueError("a remote source has a fixed schema and takes no other")
        return self

    def observe(self, observation: Observation | str) -> RemoteReader:
        """Collect the download metrics while the result is read."""
        self._observation = observation
        return self

    def broadcastable(self, value: bool = True) -> RemoteReader:
        """Let Spark broadcast the result in a join, for results known to be small."""
        self._broadcastable = value
        return self

    def _checked(self, path: str | None) -> tuple[type, RemoteOptions]:
        given = self._options if path is None else {**self._options, "path": path}
        return client_class(self._client), RemoteOptions.parse(given)

    def load(self, path: str | None = None) -> DataFrame:
        """All files listed now, as a batch."""
        kind, options = self._checked(path)
        with opened(kind, options.passed) as client:
            # Read before the client closes, which may end what its listing needs.
            index = settle(unique_index(client.list_files(self._spark)), "listing")
            order_by, parser = client.order_by() or BY_TIME, client.parser
        return read_remote(
            index,
            kind,
            options.partitions,
            order_by,
            parser,
            options.passed,
            options.read_ahead,
            self._observation,
            self._broadcastable,
        )

    def stream(self, folder: str, path: str | None = None, unlimited: bool = False):
        """A ``RemoteStream`` whose plan is kept in ``folder``."""
        kind, options = self._checked(path)
        return RemoteStream(self._spark, folder, kind, options, self._observation, unlimited)


def remote(spark: SparkSession) -> RemoteReader:
    return RemoteReader(spark)
