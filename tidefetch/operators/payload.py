"""Split payloads into metadata and content, and shape records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefetch.schema import INDEX_COLUMNS, INDEX_SCHEMA, RECORD_SCHEMA

# The separator and the error texts that readers of the records rely on.
SEPARATOR = "|==|\n"
NO_SEPARATOR = "Failed to parse: separator not found"
BAD_JSON = "Failed to parse JSON: malformed document"
NOT_FOUND = "File not found: "
# A payload whose numbers this library could not give back as they are.
INEXACT_JSON = "Failed to parse JSON: a number has more digits or a larger exponent than a double"

# Numbers that a double does not hold: of 16 digits or more with a point or exponent, or of a large exponent.
_LONG_NUMBER = (
    r"(?<![0-9.])(?=[0-9.]*[.eE])[0-9](?:[.]?[0-9]){15}|(?<![0-9.])[0-9.]+[eE][+-]?0*(?:[3-9][0-9]{2}|[0-9]{4})"
)
_STRING = r'"(?:[^"\\]++|\\.)*+"'

SPLIT_COLUMNS = ("logMetadata", "logContent", "rawFileBinary", "error")


def split_separator(df: DataFrame, content: str = "content") -> DataFrame:
    """Cut binary ``content`` at the first separator line.

    The header is found byte by byte, so content that is not text stays intact. Without a
    separator the whole payload is kept in ``rawFileBinary`` next to an error.
    """
    payload = F.col(content)
    header = F.substring_index(payload.cast("string"), SEPARATOR, 1)
    cut = df.withColumn("_cut", F.octet_length(header))
    found = F.col("_cut") < F.octet_length(payload)
    start = F.make_valid_utf8(payload.substr(F.lit(1), F.col("_cut")).cast("string"))
    rest = payload.substr(F.col("_cut") + len(SEPARATOR) + 1, F.octet_length(payload))
    return cut.select(
        *[c for c in df.columns if c != content],
        F.when(found, start).alias("logMetadata"),
        F.when(found, rest).alias("logContent"),
        F.when(~found, payload).alias("rawFileBinary"),
        F.when(~found, F.lit(NO_SEPARATOR)).alias("error"),
    )


def separate(content: bytes) -> dict:
    """The columns of ``split_separator`` for one payload, inside a task."""
    head, found, rest = content.partition(SEPARATOR.encode())
    if found:
        return {"logMetadata": head.decode("utf-8", "replace"), "logContent": rest}
    return {"rawFileBinary": content, "error": NO_SEPARATOR}


def split_json(df: DataFrame, content: str = "content") -> DataFrame:
    """Take the top-level text field ``metadata`` out of a JSON payload.

    ``logContent`` is the rest as compact JSON, fields in their order. A payload that is
    not one JSON value and nothing else, such as JSON lines, is kept in ``rawFileBinary`` next
    to an error, and so is one with a number that would lose digits.
    """
    body = F.col("_body")
    text = F.col("_text")
    # Between brackets and as a field, whatever follows the first value is read as well. A payload that
    # closes the bracket itself breaks the object, and one that closes the brace breaks the array.
    values = F.try_parse_json(F.concat(F.lit("["), body, F.lit("]")))
    field = F.try_parse_json(F.concat(F.lit('{"v":'), body, F.lit("}")))
    digits = body.rlike(_LONG_NUMBER) & F.regexp_replace(body, _STRING, '""').rlike(_LONG_NUMBER)
    parsed = (
        df.withColumn("_body", F.make_valid_utf8(F.col(content).cast("string")))
        .withColumn("_values", values)
        .withColumn(
            "_single",
            F.try_variant_get("_values", "$[0]", "variant").isNotNull()
            & F.try_variant_get("_values", "$[1]", "variant").isNull()
            & field.isNotNull(),
        )
        .withColumn("_inexact", F.col("_single") & digits)
        .withColumn("_single", F.col("_single") & ~F.col("_inexact"))
        # Null unless the payload is an object: a cheap test that spares the others the errors.
        .withColumn("_object", F.col("_single") & F.json_object_keys(body).isNotNull())
        .withColumn("_text", F.when(F.col("_object"), F.from_json(body, T.MapType(T.StringType(), T.StringType()))))
        .withColumn("_typed", F.when(F.col("_object"), F.from_json(body, T.MapType(T.StringType(), T.VariantType()))))
        # Arrays and single values are JSON as well, but have no fields.
        .withColumn("_other", F.when(F.col("_single") & ~F.col("_object"), F.to_json(F.try_parse_json(body))))
    )

    # Values of the text map are JSON except for strings, whose quotes were taken off.
    fields = F.transform(
        F.filter(F.arrays_zip(F.map_entries("_text").alias("t"), F.map_entries("_typed").alias("v")),
                 lambda e: e["t"]["key"] != "metadata"),
        lambda e: F.concat(
            _quoted(e["t"]["key"]),
            F.lit(":"),
            F.when(_is_text(e["v"]["value"]), _quoted(e["t"]["value"])).otherwise(
                F.coalesce(e["t"]["value"], F.lit("null"))
            ),
        ),
    )
    rest = F.when(text.isNotNull(), F.concat(F.lit("{"), F.array_join(fields, ","), F.lit("}"))).otherwise(
        F.col("_other")
    )
    malformed = body.isNotNull() & text.isNull() & F.col("_other").isNull()
    metadata = F.when(_is_text(F.try_element_at("_typed", F.lit("metadata"))), text["metadata"])
    return parsed.select(
        *[c for c in df.columns if c != content],
        metadata.alias("logMetadata"),
        F.encode(rest, "UTF-8").alias("logContent"),
        F.when(malformed, F.col(content)).alias("rawFileBinary"),
        F.when(malformed, F.when(F.col("_inexact"), INEXACT_JSON).otherwise(BAD_JSON)).alias("error"),
    )


def _is_text(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value) == "STRING", F.lit(False))


def _quoted(text: Column) -> Column:
    """JSON string literal: a one-field object without its braces and its key."""
    holder = F.to_json(F.named_struct(F.lit("s"), text))
    return F.substring(holder, F.lit(6), F.length(holder) - 6)


def source_struct(available: list[str]) -> Column:
    """``sourceFile`` from the index columns at hand, times cut to milliseconds."""
    return F.struct(*[_source_field(f, available).alias(f.name) for f in INDEX_SCHEMA.fields])


def _source_field(field: T.StructField, available: list[str]) -> Column:
    if field.name not in available:
        return F.lit(None).cast(field.dataType)
    column = F.col(field.name).cast(field.dataType)
    if isinstance(field.dataType, T.TimestampType):
        column = millis(column)
    return column if field.nullable else _never_null(column, field.dataType)


def _never_null(column: Column, kind: T.DataType) -> Column:
    """A column that cannot be null, which table formats do not record; a null in it fails the query."""
    refused = F.raise_error(F.lit("a listed file needs a name and the time it was listed")).cast(kind)
    never = F.lit("" if isinstance(kind, T.StringType) else 0).cast(kind)
    return F.coalesce(F.when(column.isNull(), refused).otherwise(column), never)


def millis(column: Column) -> Column:
    """Cut a timestamp to milliseconds."""
    return F.timestamp_millis(F.unix_millis(column))


def conform(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Shape records to a partial schema, field by field name.

    Fields the schema lacks are dropped and fields the records lack become null, also
    inside ``sourceFile``; a ``sourceFile`` that is not asked for as a struct becomes null.
    """
    return records.select(*[_conformed(field).alias(field.name) for field in schema.fields])


def _conformed(field: T.StructField) -> Column:
    null = F.lit(None).cast(field.dataType)
    if field.name not in RECORD_SCHEMA.fieldNames():
        return null
    if field.name != "sourceFile":
        return F.col(field.name)
    if not isinstance(field.dataType, T.StructType):
        return null
    return F.struct(
        *[
            (F.col(f"sourceFile.{f.name}") if f.name in INDEX_COLUMNS else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in field.dataType.fields
        ]
    )


def with_payload(index: DataFrame, payload: DataFrame) -> DataFrame:
    """Join an index to a table of payloads (``name``, binary ``content``).

    A file without payload keeps its row, with a null ``content`` and an error. The join
    hashes the index, whose rows are narrow and unique by name, so that payloads are
    shuffled but never sorted.
    """
    return index.hint("shuffle_hash").join(payload.select("name", "content"), "name", "left").withColumn(
        "_missing", F.when(F.col("content").isNull(), F.concat(F.lit(NOT_FOUND), F.col("name")))
    )


SPLITTERS = {"separator": split_separator, "json": split_json}


def as_records(downloaded: DataFrame, parser: str | None, keep: Sequence[str] = ()) -> DataFrame:
    """Records under the fixed schema from files and their ``content``.

    ``_missing`` holds the error of a file that could not be downloaded. ``parser`` names
    the split of rows that have ``content``; without one it becomes ``rawFileBinary``. Rows
    without ``content`` keep the columns of the split that they came with. Columns of the
    plan named in ``keep`` come first.
    """
    if "no_record" in downloaded.columns:
        downloaded = downloaded.where(~F.col("no_record"))
    if "content" not in downloaded.columns:  # the tasks gave back no payloads
        downloaded = downloaded.withColumn("content", F.lit(None).cast("binary"))
    given = {c: f"_given_{c}" for c in SPLIT_COLUMNS if c in downloaded.columns}
    rows = downloaded.withColumnsRenamed(given).withColumn("_split", F.col("content").isNotNull())
    if parser is None:
        none = {c: F.lit(None).cast("string") for c in SPLIT_COLUMNS}
        split = rows.withColumns({**none, "logContent": F.lit(None).cast("binary"), "rawFileBinary": F.col("content")})
    else:
        split = SPLITTERS[parser](rows)
    split = split.withColumns({c: F.when(F.col("_split"), F.col(c)).otherwise(F.col(g)) for c, g in given.items()})
    failed = F.col("_missing").isNotNull()
    empty = {f.name: F.lit(None).cast(f.dataType) for f in RECORD_SCHEMA.fields}
    return split.select(
        *keep,
        source_struct(downloaded.columns).alias("sourceFile"),
        *[F.when(~failed, F.col(c)).otherwise(empty[c]).alias(c) for c in SPLIT_COLUMNS[:3]],
        _never_null(millis(F.col("downloadTimestamp")), T.TimestampType()).alias("downloadTimestamp"),
        F.coalesce(F.col("_missing"), F.col("error")).alias("error"),
    )


def succeeded(records: DataFrame) -> DataFrame:
    return records.where(F.col("error").isNull())


def dead_letters(records: DataFrame) -> DataFrame:
    """Records of files whose download or split failed."""
    return records.where(F.col("error").isNotNull())
