"""The registered queries: each runs an operator over whole tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefetch.functions import formats
from tidefetch.operators import metrics, ordering, payload, position
from tidefetch.operators.download import ReadAhead, download
from tidefetch.operators.merge import merge_listings
from tidefetch.operators.throttle import poll_throttle
from tidefetch.plans import views
from tidefetch.session import fresh_path, settle
from tidefetch.sources.blobs import ADDRESS, BlobReader, with_addresses, write_blobs
from tidefetch.sources.client import RemoteClient
from tidefetch.sources.format import NAME, publish, register
from tidefetch.sources.reader import read_remote, read_table
from tidefetch.streaming.plan import StreamPlan
from tidefetch.streaming.stream import planned_files, stream_records

Query = Callable[[SparkSession, str], DataFrame]

PARTITIONS = 8
MAX_FILES = 100
POLL_INTERVAL_MS = 3_600_000
STREAM_STEPS = 4
START_FILE = "file:src14/"

# Languages on offer at successive polls.
GROWING = {1: ["en"], 2: ["en", "fr"], 3: ["en", "fr", "de"], 4: ["fr", "de", "es"]}
REAPPEARING = {
    1: ["en", "fr", "de"],
    2: ["en", "fr", "de"],
    3: ["en", "de"],
    4: ["en", "fr", "de"],
    5: ["en", "de", "es"],
    6: ["en", "fr", "de", "es"],
}

QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__.rstrip("_")] = run
    return run


def _ms(column: str) -> Column:
    return F.unix_millis(F.col(column))


def _index_columns(prefix: str = "") -> list[Column]:
    return [
        F.col(f"{prefix}name").alias("name"),
        _ms(f"{prefix}fetchedAt").alias("fetched_ms"),
        F.col(f"{prefix}fileSize").alias("file_size"),
        _ms(f"{prefix}lastModified").alias("modified_ms"),
        F.col(f"{prefix}etag").alias("etag"),
        F.col(f"{prefix}requestId").alias("request_id"),
    ]


def _record_columns() -> list[Column]:
    return [
        F.col("sourceFile.name").alias("name"),
        _ms("sourceFile.fetchedAt").alias("fetched_ms"),
        F.col("sourceFile.fileSize").alias("file_size"),
        F.col("sourceFile.etag").alias("etag"),
        F.col("logMetadata").alias("log_metadata"),
        F.md5("logContent").alias("content_md5"),
        F.octet_length("logContent").cast("bigint").alias("content_bytes"),
        F.md5("rawFileBinary").alias("raw_md5"),
        F.col("error").alias("error"),
    ]


# Sources ---------------------------------------------------------------------------


@query
def batch_read(spark, folder):
    records = read_table(
        views.index(spark, folder), views.payload(spark, folder), PARTITIONS, keep=("partition_id", "slot")
    )
    return records.select("partition_id", "slot", *_record_columns())


@query
def list_index(spark, folder):
    return views.index(spark, folder).select(*_index_columns())


def _addressed(spark: SparkSession, folder: str) -> DataFrame:
    """The index with the place of each payload in the blobs that the payloads are packed into."""
    return with_addresses(views.index(spark, folder), write_blobs(views.payload(spark, folder)))


def _downloaded(
    spark: SparkSession, folder: str, fetch: type = BlobReader, read_ahead: ReadAhead | None = None
) -> DataFrame:
    # Only names and addresses are shuffled; each task reads the ranges of its own files.
    dealt = ordering.round_robin(_addressed(spark, folder), PARTITIONS)
    plan = ordering.place(dealt, ordering.used_partitions(dealt, PARTITIONS))
    return download(plan, fetch, read_ahead=read_ahead)


@query
def batch_remote(spark, folder):
    records = read_remote(_addressed(spark, folder), BlobReader, PARTITIONS, keep=("partition_id", "rn"))
    return records.select("partition_id", F.expr(f"rn div {PARTITIONS}").alias("slot"), *_record_columns())


@query
def download_rows(spark, folder):
    records = payload.as_records(_downloaded(spark, folder), "separator", keep=("partition_id",))
    return records.hint("merge").select("partition_id", *_record_columns())


@query
def download_prefetch(spark, folder):
    ahead = ReadAhead(files=20, threads=4)
    records = payload.as_records(_downloaded(spark, folder, read_ahead=ahead), "separator", keep=("partition_id",))
    return records.hint("merge").select("partition_id", *_record_columns())


@query
def download_failures(spark, folder):
    return (
        _downloaded(spark, folder)
        .where("file_failed = 1")
        .select("name", "partition_id", F.col("_missing").alias("error"), "bytes")
    )


class BlobClient(RemoteClient, BlobReader):
    """Payloads in blobs, as a client for the named format; its listing is published beforehand."""

    def __init__(self, options):
        RemoteClient.__init__(self, options)
        BlobReader.__init__(self, options)

    def list_files(self, spark):
        raise NotImplementedError("publish a listing with addresses")

    fetch, close = BlobReader.fetch, BlobReader.close


@query
def format_read(spark, folder):
    register(spark)
    listing = publish(_addressed(spark, folder), PARTITIONS)
    client = f"{BlobClient.__module__}:{BlobClient.__name__}"
    records = spark.read.format(NAME).option("listing", listing).option("remoteClient", client).load()
    return records.select(*_record_columns())


class LineReader(BlobReader):
    """A record for each line of a payload but the first, drawn one by one; blank lines have none."""

    def fetch(self, file, options):
        lines = super().fetch(file, options).split(b"\n")[1:]
        return ({"logContent": line} for line in lines if line)


@query
def task_figures_empty(spark, folder):
    figures = _downloaded(spark, folder, LineReader).where("task_ms is not null")
    return figures.select(
        "partition_id",
        F.col("task_files").alias("files"),
        F.col("task_failed").alias("failed"),
        F.col("task_records").alias("records"),
        F.col("task_bytes").alias("bytes"),
    )


@query
def download_lines(spark, folder):
    records = payload.as_records(_downloaded(spark, folder, LineReader), None)
    return (
        records.groupBy(F.col("sourceFile.name").alias("name"), "error")
        .agg(F.count("logContent").alias("records"), F.sum(F.octet_length("logContent")).cast("bigint").alias("bytes"))
    )


@query
def download_join(spark, folder):
    found = payload.with_payload(views.index(spark, folder), views.payload(spark, folder))
    return found.select(
        "name",
        F.octet_length("content").cast("bigint").alias("bytes"),
        F.md5("content").alias("md5"),
        F.col("_missing").alias("error"),
    )


@query
def schema_fixed(spark, folder):
    records = read_table(views.index(spark, folder), views.payload(spark, folder), PARTITIONS)
    leaves = [(f.name, f) for f in records.schema.fields if not isinstance(f.dataType, T.StructType)]
    leaves += [(f"sourceFile.{f.name}", f) for f in records.schema["sourceFile"].dataType.fields]
    counts = records.agg(*[F.count(F.col(path)).alias(path.replace(".", "_")) for path, _ in leaves])
    rows = ", ".join(
        f"'{path}', '{f.dataType.simpleString()}', {str(f.nullable).lower()}, {path.replace('.', '_')}"
        for path, f in leaves
    )
    return counts.select(F.expr(f"stack({len(leaves)}, {rows}) as (field, type, nullable, filled)"))


@query
def no_broadcast_join(spark, folder):
    records = payload.as_records(_downloaded(spark, folder), "separator").hint("merge")
    languages = views.table(spark, folder, "documents").select(views.document_name().alias("name"), "lang")
    sizes = records.select(
        F.col("sourceFile.name").alias("name"), F.octet_length("logContent").cast("bigint").alias("content_bytes")
    )
    return languages.join(sizes, "name").select("name", "lang", "content_bytes")


# Projections -----------------------------------------------------------------------


@query
def project_partial(spark, folder):
    wanted = T.StructType.fromDDL(
        "error string, sourceFile struct<fileSize: bigint, name: string, owner: string>, colour string"
    )
    records = read_remote(_addressed(spark, folder), BlobReader, PARTITIONS, columns=wanted.fieldNames())
    return payload.conform(records, wanted).select(
        F.col("sourceFile.name").alias("name"),
        F.col("sourceFile.fileSize").alias("file_size"),
        F.col("sourceFile.owner").alias("owner"),
        "colour",
        "error",
    )


@query
def source_struct(spark, folder):
    files = views.index(spark, folder)
    return files.select(payload.source_struct(files.columns).alias("f")).select(*_index_columns("f."))


@query
def ts_millis(spark, folder):
    events = views.table(spark, folder, "events")
    return events.select("event_id", F.unix_micros(payload.millis(F.col("ts").cast("timestamp"))).alias("us"))


@query
def split_separator(spark, folder):
    return payload.split_separator(views.payload(spark, folder)).select(
        "name",
        F.col("logMetadata").alias("log_metadata"),
        F.md5("logContent").alias("content_md5"),
        F.md5("rawFileBinary").alias("raw_md5"),
        "error",
    )


@query
def split_json(spark, folder):
    return payload.split_json(views.json_payload(spark, folder)).select(
        "name",
        F.col("logMetadata").alias("log_metadata"),
        F.col("logContent").cast("string").alias("content"),
        F.col("rawFileBinary").cast("string").alias("raw"),
        "error",
    )


@query
def dead_letters(spark, folder):
    records = read_table(views.index(spark, folder), views.payload(spark, folder), PARTITIONS)
    return payload.dead_letters(records).select(F.col("sourceFile.name").alias("name"), "error")


# Order and spread ------------------------------------------------------------------


@query
def order_fetched(spark, folder):
    return ordering.number_rows(views.index(spark, folder)).select("name", "rn")


@query
def order_custom(spark, folder):
    return ordering.number_rows(views.index(spark, folder), [F.desc("name")]).select("name", "rn")


@query
def round_robin_fetched(spark, folder):
    return ordering.round_robin(views.index(spark, folder), PARTITIONS).select("name", "partition_id", "slot")


@query
def round_robin_name(spark, folder):
    dealt = ordering.round_robin(views.index(spark, folder), PARTITIONS, ordering.BY_NAME)
    return dealt.select("name", "partition_id", "slot")


@query
def round_robin_scaled(spark, folder):
    orders = views.table(spark, folder, "orders").select(
        F.concat("o_orderpriority", F.lit("/"), F.col("o_orderkey").cast("string")).alias("name"),
        F.col("o_orderdate").alias("fetchedAt"),
    )
    return ordering.round_robin(orders, PARTITIONS).select("name", "partition_id", "slot")


@query
def round_robin_placed(spark, folder):
    dealt = ordering.round_robin(views.index(spark, folder), PARTITIONS)
    return ordering.place(dealt, PARTITIONS).select("name", F.spark_partition_id().alias("partition_id"))


@query
def partition_sizes(spark, folder):
    return ordering.partition_sizes(views.index(spark, folder), PARTITIONS)


# Positions -------------------------------------------------------------------------


@query
def unprocessed(spark, folder):
    return position.unprocessed(views.index(spark, folder), views.processed(spark, folder)).select(*_index_columns())


@query
def still_listed(spark, folder):
    return position.still_listed(views.index(spark, folder), views.processed(spark, folder)).select("name")


def _start(spark: SparkSession, folder: str, mode: str) -> DataFrame:
    files = views.index(spark, folder)
    skipped = position.start_position(files, mode).select("name", F.lit(True).alias("skipped"))
    return files.join(skipped, "name", "left").select("name", F.coalesce("skipped", F.lit(False)).alias("skipped"))


@query
def start_earliest(spark, folder):
    return _start(spark, folder, "EARLIEST")


@query
def start_latest(spark, folder):
    return _start(spark, folder, "LaTeSt")


@query
def start_file(spark, folder):
    return _start(spark, folder, START_FILE)


@query
def rate_limited(spark, folder):
    taken = position.rate_limited(views.index(spark, folder), views.processed(spark, folder), MAX_FILES)
    return taken.select(*_index_columns())


@query
def next_position(spark, folder):
    files, done = views.index(spark, folder), views.processed(spark, folder)
    return position.next_position(files, done, position.rate_limited(files, done, MAX_FILES))


@query
def next_position_snapshot(spark, folder):
    files, done = views.index(spark, folder), views.processed(spark, folder)
    taken = position.rate_limited(files, done, MAX_FILES, ordering.BY_NAME)
    return position.next_position_snapshot(done, taken)


@query
def files_between(spark, folder):
    return position.files_between(views.processed(spark, folder), views.index(spark, folder).select("name"))


@query
def positions_equal(spark, folder):
    files, done = views.index(spark, folder), views.processed(spark, folder)
    again = position.unprocessed(files, done).select("name").unionByName(
        position.still_listed(files, done).select("name")
    )
    same = position.positions_equal(files.select("name"), again).select(F.lit("split").alias("pair"), "equal")
    other = position.positions_equal(files.select("name"), done).select(F.lit("processed").alias("pair"), "equal")
    return same.unionByName(other)


@query
def merge_listings_(spark, folder):
    return merge_listings(
        views.listing_old(spark, folder), views.listing_fresh(spark, folder), at="fetched_ms", ties=["list_pos"]
    ).orderBy("fetched_ms", "name")


@query
def available_now_plan(spark, folder):
    planned = position.drain_plan(views.index(spark, folder), views.processed(spark, folder), MAX_FILES)
    return planned.select("name", "rn", "step")


def _polled(spark: SparkSession, folder: str, listed: dict[int, list[str]], max_files: int | None):
    """Plan a step per poll: (poll, listing, step or None, position after it)."""
    done = position.start_position(views.index(spark, folder), "earliest")
    for poll, files in views.listings_by_poll(spark, folder, listed).items():
        step = position.plan_step(files, done, max_files)
        done = settle(step.position, "position") if step else done
        yield poll, files, step, done


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


@query
def plan_steps(spark, folder):
    frames = []
    for poll, _, step, done in _polled(spark, folder, GROWING, MAX_FILES):
        taken = step.taken.select("name", F.lit(True).alias("taken")) if step else None
        rows = done.withColumn("poll", F.lit(poll))
        rows = rows.withColumn("taken", F.lit(False)) if taken is None else rows.join(taken, "name", "left")
        frames.append(rows.select("poll", "name", F.coalesce("taken", F.lit(False)).alias("taken")))
    return _union(frames)


@query
def reappearing_file(spark, folder):
    return _union(
        [
            step.taken.select(F.lit(poll).alias("poll"), "name")
            for poll, _, step, _ in _polled(spark, folder, REAPPEARING, None)
            if step is not None
        ]
    )


@query
def poll_counts(spark, folder):
    return _union(
        [
            files.select(F.lit(1).alias("listed"), F.lit(0).alias("done"))
            .unionByName(done.select(F.lit(0).alias("listed"), F.lit(1).alias("done")))
            .agg(F.sum("listed").alias("discovered"), F.sum("done").alias("consumed"))
            .withColumn("poll", F.lit(poll))
            for poll, files, _, done in _polled(spark, folder, GROWING, MAX_FILES)
        ]
    )


@query
def poll_throttle_(spark, folder):
    return poll_throttle(views.polls(spark, folder), POLL_INTERVAL_MS)


# Metrics ---------------------------------------------------------------------------


def _tasks(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.task_metrics(views.download_log(spark, folder))


@query
def task_metrics(spark, folder):
    return _tasks(spark, folder)


@query
def failed_files(spark, folder):
    return metrics.failed_files(views.download_log(spark, folder))


@query
def metrics_files(spark, folder):
    return metrics.summary(_tasks(spark, folder), "files")


@query
def metrics_bytes_total(spark, folder):
    return _tasks(spark, folder).agg(F.sum("bytes").alias("total"))


@query
def metrics_duration(spark, folder):
    return metrics.summary(_tasks(spark, folder), "ms")


@query
def metrics_records_rate(spark, folder):
    return metrics.summary(_tasks(spark, folder), "records_rate")


@query
def metrics_bytes_rate(spark, folder):
    return metrics.summary(_tasks(spark, folder), "bytes_rate")


@query
def metrics_report(spark, folder):
    return metrics.metrics_report(_tasks(spark, folder))


@query
def fmt_duration(spark, folder):
    return views.samples(spark, folder).select("ms", formats.fmt_duration(F.col("ms")).alias("text"))


@query
def fmt_records_rate(spark, folder):
    return views.samples(spark, folder).select("v", formats.fmt_records_rate(F.col("v")).alias("text"))


@query
def fmt_bytes_rate(spark, folder):
    return views.samples(spark, folder).select("bytes", formats.fmt_bytes_rate(F.col("bytes")).alias("text"))


@query
def fmt_bytes(spark, folder):
    return views.samples(spark, folder).select("bytes", formats.fmt_bytes(F.col("bytes")).alias("text"))


@query
def parse_duration(spark, folder):
    return views.duration_texts(spark, folder).select("event_id", formats.parse_duration(F.col("text")).alias("ms"))


# Streams ---------------------------------------------------------------------------


@query
def stream_read(spark, folder):
    files, done = _addressed(spark, folder), views.processed(spark, folder)
    due = settle(position.unprocessed(files, done), "due")
    max_files = max(1, -(-due.count() // STREAM_STEPS))
    home = fresh_path(spark, "stream")
    plan = StreamPlan(spark, f"{home}/plan", max_files=max_files, partitions=PARTITIONS, extra=ADDRESS.fields)
    plan.drain(lambda: due)
    records = stream_records(planned_files(plan), BlobReader, keep=("step",))
    run = (
        records.writeStream.format("parquet")
        .option("checkpointLocation", f"{home}/checkpoint")
        .option("path", f"{home}/records")
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return spark.read.parquet(f"{home}/records").select("step", *_record_columns())
