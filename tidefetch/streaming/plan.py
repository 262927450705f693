"""The plan of a stream: a small marker for each micro-batch, and its files by partition.

Layout of the plan folder::

    start/                          names skipped by the start offset
    plan/step=N/partition_id=P/     files of micro-batch N that are read in partition P, in order
    markers/step-N.json             which partitions of step N have files
    forgotten/step=N/               delisted names that leave the position with step N
    position/step=N/                the whole position after step N, written now and then
    work/                           the listing and the steps at hand, overwritten in turn

Files are written by as many tasks as there are partitions, whatever the size of a step. A step
counts once its marker is there. It is written last and renamed into place, so a failed listing or
a lost driver leaves no part of a step behind: what has no marker is written anew. The stream
reads markers, one a micro-batch, and each task then reads the files of its own partition.

Markers are published in order, with names that rise with the steps: a store that lists by name
keeps the order even where file times are equal and cannot be set.
"""

from __future__ import annotations

import json
import logging
import time
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidefetch.operators.merge import merge_listings
from tidefetch.operators.ordering import BY_NAME, BY_TIME, deal, number_rows
from tidefetch.operators.position import StartOffset, drain_plan, plan_step, start_position, unprocessed
from tidefetch.schema import INDEX_SCHEMA

log = logging.getLogger("tidefetch")

NAMES = T.StructType([T.StructField("name", T.StringType())])
PLACED = [
    T.StructField("rn", T.LongType()),
    T.StructField("partition_id", T.IntegerType()),
    T.StructField("slot", T.LongType()),
]
STEP = T.StructField("step", T.LongType())

MARKER = T.StructType(
    [
        STEP,
        T.StructField("partition_id", T.IntegerType()),
        T.StructField("files", T.LongType()),
        T.StructField("planned_ms", T.LongType()),
    ]
)

ListFiles = Callable[[], DataFrame]


class StreamPlan:
    """Plans the micro-batches of one stream in a shared folder.

    The only writer of the folder. ``extra`` are columns of the index that the download
    needs besides the index columns, such as an address.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        max_files: int | None = 100,
        partitions: int = 4,
        start_offset: str = "earliest",
        poll_interval: float = 2.0,
        keep_old_on_failure: bool = False,
        snapshot_position_every: int = 100,
        extra: list[T.StructField] | None = None,
    ):
        StartOffset.parse(start_offset)
        self._spark = spark
        self.folder = folder.rstrip("/")
        self.max_files = max_files
        self.partitions = partitions
        self.start_offset = start_offset
        self._poll_interval = poll_interval
        self._keep_old = keep_old_on_failure
        self._turn: dict[str, int] = {}
        self._every = snapshot_position_every
        self._index_schema = T.StructType(INDEX_SCHEMA.fields + (extra or []))
        self._index: DataFrame | None = None
        self._polled_at = float("-inf")
        self._fs = _Folder(spark, self.folder)
        self._fs.make("markers")
        self._fs.make("plan")
        self._fs.make("position")
        # Folders are listed here once and kept track of from then on.
        steps = self._fs.markers()
        self.last_step = steps[-1] if steps else -1
        self._stamp = self._fs.time(_marker(self.last_step)) if steps else 0
        #: When the last step was planned, in milliseconds since 1970.
        self.planned_ms = self._stamp or None
        self._base = max((s for s in self._fs.steps("position") if s <= self.last_step), default=-1)
        self._forgotten = {s for s in self._fs.steps("forgotten") if self._base < s <= self.last_step}

    @property
    def schema(self) -> T.StructType:
        """Columns of the plan: the index, the spread and the step."""
        return T.StructType(self._index_schema.fields + PLACED + [STEP])

    @property
    def discovered(self) -> int:
        """Number of files in the listing that is known now."""
        return 0 if self._index is None else self._index.count()

    def poll(self, list_files: ListFiles) -> None:
        """List the source, unless the last listing is younger than the poll interval.

        Entries known from earlier listings keep the time they were first seen.
        """
        now = time.monotonic()
        if now - self._polled_at < self._poll_interval:
            return
        try:
            fresh = self._columns(list_files())
            old = fresh.where(F.lit(False)) if self._index is None else self._index
            self._index = self._keep(merge_listings(old, fresh), "listing")
        except Exception as failure:
            if self._index is None or not self._keep_old:
                raise
            log.warning("listing failed, the last one is used again: %s", failure)
        self._polled_at = now

    def advance(self, list_files: ListFiles) -> int | None:
        """Plan the next micro-batch of a polled source. Its number, or None if none is due."""
        self._start(list_files)
        self.poll(list_files)
        position = self._keep(self.position(), "position")
        step = plan_step(self._index, position, self.max_files, keep=self._keep)
        if step is None:
            return None
        number = self.last_step + 1
        self._forget(position, number)
        placed = number_rows(step.taken, BY_NAME).withColumn("step", F.lit(number).cast("bigint"))
        self._publish(placed, step.taken.count())
        self._snapshot(step.position)
        return number

    def advance_all(self, list_files: ListFiles) -> int:
        """Plan all that a polled source has due, cut into micro-batches. Their number.

        The steps are those that ``advance`` would plan one by one from this listing, but they are
        written together, and the position is read once.
        """
        self._start(list_files)
        self.poll(list_files)
        position = self._keep(self.position(), "position")
        due = self._keep(unprocessed(self._index, position), "due")
        files = due.count()
        if not files:
            return 0
        first = self.last_step + 1
        size = self.max_files or files
        cut = number_rows(due, BY_TIME, "at").withColumn("step", F.expr(f"at div {size}") + first).drop("at")
        placed = number_rows(cut, ("step", *BY_NAME)).withColumn("rn", F.col("rn") % size)
        self._forget(position, first)
        steps = self._publish(placed, files)
        self._snapshot(self._index.select("name"))
        return steps

    def drain(self, list_files: ListFiles) -> int:
        """List once and plan all that is left, by name. The number of new micro-batches.

        A failing listing raises and leaves the plan as it was.
        """
        self._start(list_files)
        snapshot = self._keep(self._columns(list_files()), "snapshot")
        first = self.last_step + 1
        before = self._keep(self.position(), "position")
        planned = drain_plan(snapshot, before, self.max_files).withColumn("step", F.col("step") + first)
        if self.max_files is not None:
            planned = planned.withColumn("rn", F.col("rn") % self.max_files)
        files = planned.count()
        if files and self._fs.exists(f"forgotten/step={first}"):
            # Left by a step whose planner was lost before it counted.
            before.where(F.lit(False)).write.mode("overwrite").parquet(self._fs.path(f"forgotten/step={first}"))
        steps = self._publish(planned, files)
        self._snapshot(before.unionByName(unprocessed(snapshot, before).select("name")))
        return steps

    def position(self) -> DataFrame:
        """Names that are done or skipped, by all steps planned so far."""
        names = self._read("start" if self._base < 0 else f"position/step={self._base}")
        later = range(self._base + 1, self.last_step + 1)
        if not later:
            return names
        kept = names.select("name", F.lit(self._base).alias("step"), F.lit(True).alias("kept"))
        for table, value in (("plan", True), ("forgotten", False)):
            steps = later if value else sorted(self._forgotten)
            kept = kept.unionByName(
                self._steps(table, steps).select("name", "step", F.lit(value).alias("kept"))
            )
        return kept.groupBy("name").agg(F.max_by("kept", "step").alias("kept")).where("kept").select("name")

    def progress(self) -> DataFrame:
        """One row: names in the position, files discovered, last step and when it was planned. Empty before any step."""
        planned = F.timestamp_millis(F.lit(self.planned_ms).cast("bigint"))
        # Nothing is written before the first planning.
        position = self.position() if self.last_step >= 0 else self._spark.createDataFrame([], NAMES)
        return (
            position
            .agg(F.count(F.lit(1)).alias("consumed"))
            .select(
                "consumed",
                F.lit(self.discovered).alias("discovered"),
                F.lit(self.last_step).alias("step"),
                planned.alias("planned_at"),
            )
            .where(F.lit(self.last_step >= 0))
        )

    def _keep(self, df: DataFrame, label: str) -> DataFrame:
        """Settle in a place of its own, next to the copy that ``df`` may be made from."""
        self._turn[label] = 1 - self._turn.get(label, 1)
        path = self._fs.path(f"work/{label}-{self._turn[label]}")
        df.write.mode("overwrite").parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def _start(self, list_files: ListFiles) -> None:
        """Fix the start position once, at the very first planning."""
        if self._fs.exists("start/_SUCCESS"):
            return
        mode = StartOffset.parse(self.start_offset).mode
        if mode == "earliest":
            names = self._spark.createDataFrame([], NAMES)
        else:
            names = start_position(list_files(), self.start_offset)
        names.write.mode("overwrite").parquet(self._fs.path("start"))

    def _columns(self, listed: DataFrame) -> DataFrame:
        return listed.select(
            *[
                (F.col(f.name) if f.name in listed.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in self._index_schema.fields
            ]
        )

    def _read(self, path: str) -> DataFrame:
        return self._spark.read.schema(NAMES).parquet(self._fs.path(path))

    def _steps(self, table: str, steps: Iterable[int]) -> DataFrame:
        """Names of some steps. Only their folders are listed."""
        schema = T.StructType(NAMES.fields + [STEP])
        paths = [self._fs.path(f"{table}/step={s}") for s in steps]
        if not paths:
            return self._spark.createDataFrame([], schema)
        return self._spark.read.schema(schema).option("basePath", self._fs.path(table)).parquet(*paths)

    def _write_position(self, position: DataFrame) -> None:
        # Moved into place whole: a planner that is lost meanwhile leaves no position that looks complete.
        staged = self._staging()
        position.write.parquet(self._fs.path(staged))
        self._fs.move(staged, f"position/step={self.last_step}")
        self._base = self.last_step
        self._forgotten.clear()

    def _staging(self) -> str:
        return f"staging/{uuid.uuid4().hex}"

    def _forget(self, position: DataFrame, step: int) -> None:
        gone = position.join(self._index.select("name"), "name", "left_anti").select("name")
        gone.write.mode("overwrite").parquet(self._fs.path(f"forgotten/step={step}"))
        self._forgotten.add(step)

    def _snapshot(self, position: DataFrame) -> None:
        if self.last_step - self._base >= self._every:
            self._write_position(position)

    def _publish(self, numbered: DataFrame, files: int) -> int:
        """Write the files of the steps from the next one on, numbered by ``step`` and ``rn``, and mark them."""
        if not files:
            return 0
        first = self.last_step + 1
        size = self.max_files or files
        for lost in self._fs.steps("plan"):
            if lost >= first:
                self._fs.delete(f"plan/step={lost}")
        placed = deal(numbered, self.partitions).select(*self.schema.fieldNames())
        (
            placed.repartitionById(self.partitions, F.col("partition_id"))
            .sortWithinPartitions("step", "partition_id", "rn")
            .write.mode("append")
            .partitionBy("step", "partition_id")
            .parquet(self._fs.path("plan"))
        )
        steps = -(-files // size)
        for step in range(first, first + steps):
            self._mark(step, min(size, files - (step - first) * size))
        return steps

    def _mark(self, step: int, files: int) -> None:
        now = int(time.time() * 1000)
        # The file source reads in order of file times, so where they can be set they rise with the steps.
        self._stamp = max(self._stamp + 1, now)
        lines = [
            {"step": step, "partition_id": p, "files": -(-(files - p) // self.partitions), "planned_ms": now}
            for p in range(min(files, self.partitions))
        ]
        self._fs.write(_marker(step), "".join(json.dumps(line) + "\n" for line in lines).encode(), self._stamp)
        self.last_step, self.planned_ms = step, now


def _marker(step: int) -> str:
    return f"markers/step-{step:012d}.json"


def read_steps(folder: str, schema: T.StructType | None):
    """A task function: from (step, partition_id) to the files planned for them, in order.

    Without a schema the files' stored columns are given as they are.
    """
    arrow = None if schema is None else to_arrow_schema(schema)
    stored = arrow and pa.schema([f for f in arrow if f.name not in ("step", "partition_id")])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for step, part in zip(batch.column("step").to_pylist(), batch.column("partition_id").to_pylist()):
                wanted = fs.FileSelector(f"{root}/step={step}/partition_id={part}")
                for info in sorted(system.get_file_info(wanted), key=lambda i: i.base_name):
                    if info.base_name.startswith(("_", ".")):
                        continue
                    with system.open_input_file(info.path) as file:
                        if stored is None:
                            yield from pq.ParquetFile(file).iter_batches()
                            continue
                        for rows in pq.ParquetFile(file).iter_batches(columns=stored.names):
                            kept = rows.select(stored.names).cast(stored)
                            columns = dict(zip(stored.names, kept.columns))
                            columns["step"] = pa.repeat(pa.scalar(step, pa.int64()), len(rows))
                            columns["partition_id"] = pa.repeat(pa.scalar(part, pa.int32()), len(rows))
                            yield pa.RecordBatch.from_arrays([columns[n] for n in arrow.names], schema=arrow)

    return read


class _Folder:
    """Names and times in the plan folder, on any Hadoop file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _at(self, name: str):
        return self._path(self.path(name))

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._at(name))

    def make(self, name: str) -> None:
        self._fs.mkdirs(self._at(name))

    def steps(self, table: str) -> list[int]:
        if not self.exists(table):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._at(table))]
        return sorted(int(n.removeprefix("step=")) for n in names if n.startswith("step="))

    def markers(self) -> list[int]:
        """Steps that have a marker."""
        names = [s.getPath().getName() for s in self._fs.listStatus(self._at("markers"))]
        return sorted(int(n[5:-5]) for n in names if n.startswith("step-") and n.endswith(".json"))

    def time(self, name: str) -> int:
        return self._fs.getFileStatus(self._at(name)).getModificationTime()

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

    def write(self, name: str, content: bytes, millis: int) -> None:
        """A whole file or none, with this time if the store lets it be set."""
        folder, _, file = name.rpartition("/")
        staged = f"{folder}/.{file}"
        out = self._fs.create(self._at(staged), True)
        out.write(bytearray(content))
        out.close()
        self._fs.setTimes(self._at(staged), millis, -1)
        self.move(staged, name)

    def move(self, source: str, target: str) -> None:
        if not self._fs.rename(self._at(source), self._at(target)):
            raise OSError(f"cannot move {self.path(source)} to {self.path(target)}")
