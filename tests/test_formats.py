from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidefetch.functions import formats


def shown(spark, function, values, kind="long"):
    frame = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [r["text"] for r in frame.select(function(F.col("v")).alias("text")).collect()]


@pytest.mark.parametrize(
    ("ms", "text"),
    [
        (0, "0 millisecond"),
        (1, "1 millisecond"),
        (500, "500 milliseconds"),
        (1_000, "1 second"),
        (30_000, "30 seconds"),
        (60_000, "1 minute"),
        (300_000, "5 minutes"),
        (3_600_000, "1 hour"),
        (7_200_000, "2 hours"),
        (86_400_000, "1 day"),
        (172_800_000, "2 days"),
        (3_661_000, "3661 seconds"),
        (90_500, "90500 milliseconds"),
        (-1_000, "-1 seconds"),
        (None, None),
    ],
)
def test_duration(spark, ms, text):
    assert shown(spark, formats.fmt_duration, [ms]) == [text]


def test_rates(spark):
    assert shown(spark, formats.fmt_records_rate, [0, 1_000, 1_234_567, None]) == [
        "0 records/sec",
        "1,000 records/sec",
        "1,234,567 records/sec",
        None,
    ]
    assert shown(spark, formats.fmt_bytes_rate, [0, 1 << 20, 1_234_567, 131_072, None]) == [
        "0.00 MB/s",
        "1.00 MB/s",
        "1.18 MB/s",
        "0.13 MB/s",
        None,
    ]


def test_bytes(spark):
    values = [0, 1_023, 1_024, 3_584, (1 << 20) - 1, 6 << 20, 2 << 30, None]
    assert shown(spark, formats.fmt_bytes, values) == [
        "0 B",
        "1023 B",
        "1.00 KB",
        "3.50 KB",
        "1024.00 KB",
        "6.00 MB",
        "2.00 GB",
        None,
    ]


@pytest.mark.parametrize(
    ("text", "ms"),
    [
        ("500ms", 500),
        ("10s", 10_000),
        ("5m", 300_000),
        ("0 seconds", 0),
        ("1.5 hours", 5_400_000),
        ("2 days", 172_800_000),
        ("-1s", -1_000),
        ("1ns", 0),
        ("1500 µs", 1),
        ("10000", None),
        ("Inf", None),
        ("s", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_duration(spark, text, ms):
    assert shown(spark, formats.parse_duration, [text], "string") == [ms]
