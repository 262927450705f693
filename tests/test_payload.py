from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefetch.operators import payload
from tidefetch.schema import RECORD_SCHEMA

AT = dt.datetime(2021, 1, 1, 12, 0, 0, 123456)


def contents(spark, values):
    rows = [(i, None if v is None else bytearray(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "id int, content binary")


def split(frame):
    rows = frame.orderBy("id").collect()
    value = lambda v: bytes(v) if isinstance(v, bytearray) else v
    return [tuple(value(r[c]) for c in payload.SPLIT_COLUMNS) for r in rows]


def test_split_separator_is_safe_for_bytes(spark):
    values = [
        b"head|==|\nbody",
        "é|==|\n".encode() + b"\xff\x00\xfe|==|\nmore",
        b"|==|\n",
        b"no separator",
        b"almost |==| \n",
        b"\xff\xfe|==|\n\xc3",
        b"",
        None,
    ]
    missing = (None, None)
    assert split(payload.split_separator(contents(spark, values))) == [
        ("head", b"body", *missing),
        ("é", b"\xff\x00\xfe|==|\nmore", *missing),
        ("", b"", *missing),
        (None, None, b"no separator", payload.NO_SEPARATOR),
        (None, None, b"almost |==| \n", payload.NO_SEPARATOR),
        ("��", b"\xc3", *missing),
        (None, None, b"", payload.NO_SEPARATOR),
        (None, None, None, None),
    ]


@pytest.mark.parametrize(
    ("body", "metadata", "content"),
    [
        (
            '{"port":"Brest","metadata":"gauge 4", "height":7.25,"buoy":"é"}',
            "gauge 4",
            '{"port":"Brest","height":7.25,"buoy":"é"}',
        ),
        ('{"metadata":5,"a":1}', None, '{"a":1}'),
        ('{"metadata":null,"a":1}', None, '{"a":1}'),
        ('{"metadata":{"x":1},"a":"1"}', None, '{"a":"1"}'),
        ('{"b":{"z":[1, 2.5],"a":null},"a":true,"n":null}', None, '{"b":{"z":[1,2.5],"a":null},"a":true,"n":null}'),
        ('{"q\\"k":"a\\\\b\\n\\"","metadata":"m\\"n"}', 'm"n', '{"q\\"k":"a\\\\b\\n\\""}'),
        ('{"a":"ü","metadata":""}', "", '{"a":"ü"}'),
        ('{"metadata":"m"}', "m", "{}"),
        ("{}", None, "{}"),
        ("[1, 2]", None, "[1,2]"),
    ],
)
def test_split_json(spark, body, metadata, content):
    assert split(payload.split_json(contents(spark, [body.encode()]))) == [(metadata, content.encode(), None, None)]


@pytest.mark.parametrize("body", [b"not json", b"", b'{"a":', b'{"a":1,}'])
def test_split_json_malformed(spark, body):
    (row,) = split(payload.split_json(contents(spark, [body])))
    assert row[:3] == (None, None, body)
    assert row[3].startswith("Failed to parse JSON: ")


@pytest.fixture()
def record(spark):
    found = spark.createDataFrame(
        [("Brest/été 1.log", AT, (3 << 33) + 1, AT, 'W/"7f"', "call 9/é", bytearray(b"m|==|\nc"), None, AT)],
        "name string, fetchedAt timestamp, fileSize bigint, lastModified timestamp, etag string, requestId string, "
        "content binary, _missing string, downloadTimestamp timestamp",
    )
    return payload.as_records(found, "separator")


def test_record_has_the_fixed_schema(record):
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in record.schema.fields] == [
        (f.name, f.dataType.simpleString(), f.nullable) for f in RECORD_SCHEMA.fields
    ]
    inner = record.schema["sourceFile"].dataType
    assert [(f.name, f.nullable) for f in inner.fields] == [
        (f.name, f.nullable) for f in RECORD_SCHEMA["sourceFile"].dataType.fields
    ]


def test_record_values(record):
    row = record.first()
    cut = AT.replace(microsecond=123000)
    assert tuple(row["sourceFile"]) == ("Brest/été 1.log", cut, (3 << 33) + 1, cut, 'W/"7f"', "call 9/é")
    assert (row["logMetadata"], bytes(row["logContent"]), row["rawFileBinary"]) == ("m", b"c", None)
    assert (row["downloadTimestamp"], row["error"]) == (cut, None)


def test_record_from_the_least_index(spark):
    found = spark.createDataFrame(
        [("a", AT, None, "File not found: a", AT)],
        "name string, fetchedAt timestamp, content binary, _missing string, downloadTimestamp timestamp",
    )
    row = payload.as_records(found, "separator").first()
    assert tuple(row["sourceFile"])[2:] == (None, None, None, None)
    assert (row["logMetadata"], row["logContent"], row["rawFileBinary"]) == (None, None, None)
    assert row["error"] == "File not found: a"


def test_conform_by_name(record):
    wanted = T.StructType.fromDDL(
        "error string, other int, sourceFile struct<etag: string, owner: string, name: string>, logMetadata string"
    )
    shaped = payload.conform(record, wanted)
    assert shaped.columns == ["error", "other", "sourceFile", "logMetadata"]
    row = shaped.first()
    assert tuple(row["sourceFile"]) == ('W/"7f"', None, "Brest/été 1.log")
    assert (row["error"], row["other"], row["logMetadata"]) == (None, None, "m")


def test_conform_refuses_no_odd_schema(record):
    assert payload.conform(record, T.StructType.fromDDL("sourceFile string")).first()["sourceFile"] is None
    assert payload.conform(record, T.StructType([])).columns == []


def test_failures_and_successes_split(record):
    both = record.unionByName(record.withColumn("error", F.lit("bad")))
    assert payload.succeeded(both).count() == 1
    assert payload.dead_letters(both).first()["error"] == "bad"


@pytest.mark.parametrize("body", ['{"a":1}\n{"a":2}', '{"a":1} tail', "{'a':1}", '{"a":1},{"a":2}', "[1] [2]"])
def test_nothing_after_the_first_json_value_is_lost(spark, body):
    row = payload.split_json(contents(spark, [body.encode()])).first()
    assert bytes(row.rawFileBinary) == body.encode() and row.error and row.logContent is None


@pytest.mark.parametrize(
    "body",
    ['{"a":1}], junk', '{"a":1}],[{"b":2}', '{"a":1}}', '{"a":1},"v":{"a":2}', '{"a":1}},{"v":2', '{"a":1}]', "1], [2", '"a"},{"v":"b"'],
)
def test_payloads_that_close_a_wrapper_are_no_single_value(spark, body):
    row = payload.split_json(contents(spark, [body.encode()])).first()
    assert (bytes(row.rawFileBinary), row.error, row.logContent) == (body.encode(), payload.BAD_JSON, None)


@pytest.mark.parametrize(
    ("body", "exact"),
    [
        ('{"a":1e400}', False),
        ('{"a":-1.5E-0400}', False),
        ('{"a":0.1000000000000000055}', False),
        ('{"m":{"n":[1,12345678901234567.5]}}', False),
        ('{"a":"1e400 0.1000000000000000055"}', True),
        ('{"a":"\\"","b":"0.1000000000000000055"}', True),
        ('{"a":12345678901234567890123}', True),
        ('{"a":0.125,"b":-7.5}', True),
        ('{"a":"x","e123":"1"}', True),
    ],
)
def test_numbers_keep_their_digits_or_the_payload_stays_whole(spark, body, exact):
    row = payload.split_json(contents(spark, [body.encode()])).first()
    if exact:
        assert (bytes(row.logContent).decode(), row.rawFileBinary, row.error) == (body, None, None)
    else:
        assert (bytes(row.rawFileBinary), row.error, row.logContent) == (body.encode(), payload.INEXACT_JSON, None)


def test_names_and_times_of_an_index_are_never_null(spark):
    found = spark.createDataFrame([(None, AT, bytearray(b"a|==|\nb"), None, AT)],
        "name string, fetchedAt timestamp, content binary, _missing string, downloadTimestamp timestamp")
    with pytest.raises(Exception, match="needs a name"):
        payload.as_records(found, "separator").collect()
