"""Shared storage of a session: where intermediate tables are written."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Whether a write ends with an empty _SUCCESS file.
MARK_SUCCESS = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
#: Bytes of an Arrow batch that a Python task is given while a table is settled. Both sides hold a batch more than once.
BATCH = 4 << 20


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Only a local session may fall back to a folder of its own machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tidefetch-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/tidefetch/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str = "table", compression: str = "snappy") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    This cuts the lineage and fixes values that a recomputation could change. The copy
    outlives executors, and later reads still prune its columns. The shuffle files of the
    write are of no more use then, so they are freed at once, not when the driver next collects
    garbage. Python tasks of the write get batches of ``BATCH`` bytes, unless the session sets its own bound.
    The table is read only after its write, so it has no _SUCCESS file: on a local folder the driver would start
    a process for that file's permissions and another for its checksum's.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    batch = spark.conf.get(ARROW_BYTES, None) or str(BATCH)
    with _setting(spark, FREE_SHUFFLES, "true"), _setting(spark, ARROW_BYTES, batch):
        df.write.option("compression", compression).option(MARK_SUCCESS, "false").parquet(path)
    settled = spark.read.schema(df.schema).parquet(path)
    settled._settled_in = path
    return settled


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """``key`` is ``value`` meanwhile."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def discard(*tables: DataFrame) -> None:
    """Delete settled tables that nothing reads any more, such as those behind a later settled table."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table._settled_in)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, once per Spark application."""
    context = spark.sparkContext
    if getattr(context, "_tidefetch_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="tidefetch-")) / "tidefetch.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    # Spark copies the archive to every executor.
    context.addPyFile(str(archive))
    context._tidefetch_shipped = True
