"""Read a planned stream: the plan folder drives Spark's file stream source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefetch.operators.download import Fetch, ReadAhead, download
from tidefetch.operators.merge import unique_index
from tidefetch.operators.metrics import observe_metrics
from tidefetch.operators.payload import as_records
from tidefetch.session import settle, ship_package
from tidefetch.sources.client import opened
from tidefetch.sources.options import RemoteOptions
from tidefetch.streaming.plan import MARKER, StreamPlan, read_steps


def planned_files(plan: StreamPlan) -> DataFrame:
    """Streaming DataFrame of the plan, a step per micro-batch, each file in the partition it was dealt to.

    The stream carries markers only; tasks read the files planned for their partition. Restart,
    exactly-once and available-now are those of the file source.
    """
    spark = plan._spark
    ship_package(spark)
    markers = spark.readStream.schema(MARKER).option("maxFilesPerTrigger", 1).json(f"{plan.folder}/markers")
    placed = markers.repartitionById(plan.partitions, F.col("partition_id")).select("step", "partition_id")
    return placed.mapInArrow(read_steps(f"{plan.folder}/plan", plan.schema), plan.schema)


def stream_records(
    files: DataFrame,
    fetch: Fetch | type,
    partitions: int | None = None,
    parser: str | None = "separator",
    options: Mapping[str, str] | None = None,
    read_ahead: ReadAhead | None = None,
    observation: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Streaming DataFrame of the records of planned files, for any sink.

    ``planned_files`` has placed the files. ``partitions`` moves those that come otherwise.
    """
    if partitions is not None:
        files = files.repartitionById(partitions, F.col("partition_id"))
    downloaded = download(files, fetch, options, read_ahead)
    if observation is not None:
        downloaded = observe_metrics(downloaded, observation)
    return as_records(downloaded, parser, keep).hint("merge")


class RemoteStream:
    """A polled source as a stream, made by ``remote(spark).option(...).stream(folder)``.

    ``records()`` is read with ``writeStream``. Micro-batches are planned by
    ``plan_snapshot()`` for a run with the available-now trigger, or by ``start_planning()``
    for one that goes on. ``unlimited`` lifts the limit of files per micro-batch.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        kind: type,
        options: RemoteOptions,
        observation: str | None = None,
        unlimited: bool = False,
    ):
        self._spark = spark
        self._kind = kind
        self._options = options
        self._observation = observation
        self.plan = StreamPlan(
            spark,
            folder,
            max_files=None if unlimited else options.max_files_per_trigger,
            partitions=options.partitions,
            start_offset=options.start_offset,
            poll_interval=options.poll_interval,
            keep_old_on_failure=options.async_list_files,
        )

    def list_files(self) -> DataFrame:
        with opened(self._kind, self._options.passed) as client:
            # Read before the client closes, which may end what its listing needs.
            return settle(unique_index(client.list_files(self._spark)), "listing")

    def plan_snapshot(self) -> int:
        return self.plan.drain(self.list_files)

    def plan_next(self) -> int | None:
        return self.plan.advance(self.list_files)

    def plan_backlog(self) -> int:
        """Plan all listed files that are left, cut into steps. The number of steps."""
        return self.plan.advance_all(self.list_files)

    def start_planning(self, checkpoint: str):
        """A streaming query that plans all that is due at each poll interval until it is stopped."""
        ticks = self._spark.readStream.format("rate").load()
        interval = f"{int(self._options.poll_interval * 1000)} milliseconds"
        return (
            ticks.writeStream.foreachBatch(lambda batch, number: self.plan_backlog())
            .option("checkpointLocation", checkpoint)
            .trigger(processingTime=interval)
            .start()
        )

    def records(self, keep: Sequence[str] = ()) -> DataFrame:
        return stream_records(
            planned_files(self.plan),
            self._kind,
            None,
            self._kind.parser,
            self._options.passed,
            self._options.read_ahead,
            self._observation,
            keep,
        )
