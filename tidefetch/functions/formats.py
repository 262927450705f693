"""Text forms of metric values, and durations read from text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Units of a shown duration, largest first, in milliseconds.
DURATION_UNITS = {
    "day": 86_400_000,
    "hour": 3_600_000,
    "minute": 60_000,
    "second": 1_000,
    "millisecond": 1,
}

# Spellings of the units of a duration text, in nanoseconds.
UNIT_NANOS = {
    ("d", "day", "days"): 86_400_000_000_000,
    ("h", "hr", "hour", "hrs", "hours"): 3_600_000_000_000,
    ("m", "min", "minute", "mins", "minutes"): 60_000_000_000,
    ("s", "sec", "second", "secs", "seconds"): 1_000_000_000,
    ("ms", "milli", "millis", "millisecond", "milliseconds"): 1_000_000,
    ("µs", "micro", "micros", "microsecond", "microseconds"): 1_000,
    ("ns", "nano", "nanos", "nanosecond", "nanoseconds"): 1,
}

# Fixed value: a number, signed or not, and the name of its unit.
DURATION_PATTERN = r"^\s*([+-]?\d+(?:\.\d+)?)\s*([a-zµ]+)\s*$"


def fmt_duration(ms: Column) -> Column:
    """Milliseconds in the largest unit that divides them, plural unless the value is 1."""
    shown = F.lit(None).cast("string")
    for unit, size in reversed(DURATION_UNITS.items()):
        amount = F.call_function("div", ms, F.lit(size))
        text = F.concat(amount.cast("string"), F.lit(f" {unit}"), F.when(amount == 1, "").otherwise("s"))
        shown = F.when(ms % size == 0, text).otherwise(shown)
    return F.when(ms == 0, "0 millisecond").otherwise(shown)


def fmt_count(value: Column) -> Column:
    """Whole number with separators for thousands."""
    return F.format_number(value, 0)


def fmt_records_rate(per_second: Column) -> Column:
    return F.concat(fmt_count(per_second), F.lit(" records/sec"))


def fmt_bytes_rate(per_second: Column) -> Column:
    return _decimals(per_second, 1 << 20, "MB/s")


def fmt_bytes(size: Column) -> Column:
    """Bytes in B, KB, MB or GB, by 1024, two decimals except for B."""
    return (
        F.when(size < 1 << 10, F.concat(size.cast("string"), F.lit(" B")))
        .when(size < 1 << 20, _decimals(size, 1 << 10, "KB"))
        .when(size < 1 << 30, _decimals(size, 1 << 20, "MB"))
        .otherwise(_decimals(size, 1 << 30, "GB"))
    )


def _decimals(value: Column, unit: int, name: str) -> Column:
    shown = F.format_string(f"%.2f {name}", value / F.lit(float(unit)))
    return F.when(value.isNotNull(), shown)


def parse_duration(text: Column) -> Column:
    """Whole milliseconds of a duration text such as ``500ms`` or ``5 minutes``.

    Null for text that is no duration, and for a number without a unit.
    """
    number = F.regexp_extract(text, DURATION_PATTERN, 1)
    unit = F.regexp_extract(text, DURATION_PATTERN, 2)
    nanos = reduce(
        lambda chain, item: chain.when(unit.isin(*item[0]), F.lit(item[1])),
        UNIT_NANOS.items(),
        F.when(F.lit(False), F.lit(0)),
    )
    total = F.round(F.when(number != "", number).cast("double") * nanos.cast("double")).cast("bigint")
    return F.call_function("div", total, F.lit(1_000_000))
