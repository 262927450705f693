"""Indexes, payloads and logs derived from the tables of a data folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefetch.sources.listing import as_index

EPOCH_MS = 1_704_067_200_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def document_name() -> Column:
    return F.concat("source", F.lit("/"), F.lpad(F.col("doc_id").cast("string"), 12, "0"), F.lit(".log"))


def index(spark: SparkSession, folder: str) -> DataFrame:
    """One listed file per document. Times repeat, so ties occur."""
    return _index(table(spark, folder, "documents"))


def _index(documents: DataFrame) -> DataFrame:
    fetched = F.lit(EPOCH_MS) + (F.col("doc_id") * 7919 % 997) * 60_000
    return as_index(
        documents,
        name=document_name(),
        fetchedAt=F.timestamp_millis(fetched),
        fileSize=F.col("n_chars"),
        lastModified=F.timestamp_millis(fetched - F.col("n_chars")),
        etag=F.when(F.col("lang") != "de", F.concat(F.lit("e"), F.col("doc_id").cast("string"))),
    )


def payload(spark: SparkSession, folder: str) -> DataFrame:
    """Payloads as bytes. Toxic documents are missing, Spanish ones have no separator."""
    toxic = table(spark, folder, "labels").where("toxic = 1")
    header = F.concat("lang", F.lit("|==|\n"))
    body = F.when(F.col("lang") == "es", F.col("text")).otherwise(F.concat(header, "text"))
    return (
        table(spark, folder, "documents")
        .join(toxic, "doc_id", "left_anti")
        .select(document_name().alias("name"), F.encode(body, "UTF-8").alias("content"))
    )


def processed(spark: SparkSession, folder: str) -> DataFrame:
    """A position: labelled documents, and one delisted name per web page."""
    labelled = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left_semi")
    gone = F.concat(F.lit("gone/"), F.col("page_id").cast("string"), F.lit(".log"))
    return labelled.select(document_name().alias("name")).unionByName(
        table(spark, folder, "pages").select(gone.alias("name"))
    )


def epoch_ms(column: str) -> Column:
    return F.unix_millis(F.col(column).cast("timestamp"))


def _listing(events: DataFrame, later: Column, larger: int) -> DataFrame:
    return events.select(
        F.col("event_id").alias("list_pos"),
        F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("-"), "event_type", F.lit(".log")).alias("name"),
        (epoch_ms("ts") + later).alias("fetched_ms"),
        (F.floor(F.col("value") * 100) + larger).alias("file_size"),
    )


def listing_old(spark: SparkSession, folder: str) -> DataFrame:
    """An earlier listing, without the files of errors."""
    return _listing(table(spark, folder, "events").where("event_type <> 'error'"), F.lit(0), 0)


def listing_fresh(spark: SparkSession, folder: str) -> DataFrame:
    """A later listing: sign-up files are gone, error files are new, some times are earlier."""
    earlier = F.when(F.col("value") < 20, -60_000).otherwise(0)
    return _listing(table(spark, folder, "events").where("event_type <> 'signup'"), earlier, 1)


def download_log(spark: SparkSession, folder: str) -> DataFrame:
    """One downloaded file per event, one task per user."""
    return table(spark, folder, "events").select(
        F.concat(F.lit("f"), F.col("event_id").cast("string"), F.lit(".log")).alias("name"),
        F.col("user_id").alias("task_id"),
        F.when(F.col("event_type") == "error", 0).otherwise(1).alias("ok"),
        F.floor(F.col("value") * 100_000).alias("bytes"),
        F.lit(1).cast("bigint").alias("records"),
        (F.floor("value") + 1).alias("ms"),
    )


def json_payload(spark: SparkSession, folder: str) -> DataFrame:
    """JSON bodies: malformed for errors, without metadata for sign-ups, numeric for views."""
    rest = F.concat(F.lit('"user":'), F.col("user_id").cast("string"), F.lit(',"props": '), "props", F.lit("}"))
    body = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("error "), "props"))
        .when(F.col("event_type") == "signup", F.concat(F.lit("{"), rest))
        .when(F.col("event_type") == "view", F.concat(F.lit('{"metadata":7,'), rest))
        .otherwise(F.concat(F.lit('{"metadata":"'), "event_type", F.lit('",'), rest))
    )
    return table(spark, folder, "events").select(
        F.concat(F.lit("j"), F.col("event_id").cast("string"), F.lit(".json")).alias("name"),
        F.encode(body, "UTF-8").alias("content"),
    )


def polls(spark: SparkSession, folder: str) -> DataFrame:
    """Poll requests: one source per user."""
    return table(spark, folder, "events").select(F.col("user_id").alias("source"), epoch_ms("ts").alias("poll_ms"))


def samples(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers to show as text."""
    return table(spark, folder, "events").select(
        F.col("event_id").alias("v"),
        (F.col("event_id") * 500).alias("ms"),
        (F.col("event_id") * 131_072).alias("bytes"),
    )


def duration_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Duration texts with several units; errors have none."""
    unit = (
        F.when(F.col("event_type") == "view", "s")
        .when(F.col("event_type") == "click", " minutes")
        .when(F.col("event_type") == "signup", "ms")
        .when(F.col("event_type") == "purchase", " µs")
        .otherwise("")
    )
    return table(spark, folder, "events").select(
        "event_id", F.concat(F.col("value").cast("string"), unit).alias("text")
    )


def listings_by_poll(spark: SparkSession, folder: str, listed: dict[int, list[str]]) -> dict[int, DataFrame]:
    """Successive listings of the index: poll number to the languages on offer."""
    documents = table(spark, folder, "documents")
    return {poll: _index(documents.where(F.col("lang").isin(*langs))) for poll, langs in listed.items()}
