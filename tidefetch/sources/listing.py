"""File indexes: from a folder of any Hadoop file system, or from a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefetch.schema import INDEX_SCHEMA


def list_folder(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Index of the files under a folder. File contents are not read.

    ``name`` is the full path, and ``fetchedAt`` the time of the query. A file that is
    removed while the listing runs is left out.
    """
    reader = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("ignoreMissingFiles", "true")
    )
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    files = reader.load(path).select("path", "modificationTime", "length")
    return as_index(
        files,
        name=F.col("path"),
        fetchedAt=F.current_timestamp(),
        fileSize=F.col("length"),
        lastModified=F.col("modificationTime"),
    )


def as_index(df: DataFrame, **columns: Column) -> DataFrame:
    """Index from any table: index columns by name, null where none is given."""
    return df.select(
        *[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in INDEX_SCHEMA.fields]
    )
