"""The two fixed schemas: a file index and the records read from its files."""

from __future__ import annotations

from pyspark.sql import types as T


def _field(name: str, kind: T.DataType, nullable: bool, text: str) -> T.StructField:
    return T.StructField(name, kind, nullable, {"description": text})


INDEX_SCHEMA = T.StructType(
    [
        _field("name", T.StringType(), False, "Name that identifies the file"),
        _field("fetchedAt", T.TimestampType(), False, "When the file was first listed"),
        _field("fileSize", T.LongType(), True, "Size announced by the source, in bytes"),
        _field("lastModified", T.TimestampType(), True, "Modification time announced by the source"),
        _field("etag", T.StringType(), True, "Entity tag announced by the source"),
        _field("requestId", T.StringType(), True, "Identifier of the answering request"),
    ]
)

INDEX_COLUMNS = INDEX_SCHEMA.fieldNames()

RECORD_SCHEMA = T.StructType(
    [
        _field("sourceFile", INDEX_SCHEMA, False, "Index entry the record comes from"),
        _field("logMetadata", T.StringType(), True, "Metadata found in the payload"),
        _field("logContent", T.BinaryType(), True, "Content of the payload without its metadata"),
        _field("rawFileBinary", T.BinaryType(), True, "The whole payload, when it could not be split"),
        _field("downloadTimestamp", T.TimestampType(), False, "When the file was downloaded"),
        _field("error", T.StringType(), True, "Why the download or the split failed"),
    ]
)
