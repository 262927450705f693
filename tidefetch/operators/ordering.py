"""Order a file index, number it and spread it over partitions."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefetch.session import settle

# The cutoff of a limit is looked up by a sort once it is known to be among so many rows.
NARROW = 20_000
# Rows that are drawn to choose the bounds of a narrowing, and the number of bounds.
DRAWN = 4_096
BOUNDS = 16

# monotonically_increasing_id() holds the partition above these many low bits.
_ROW_BITS = 33

BY_TIME = ("fetchedAt", "name")
BY_NAME = ("name",)


def _columns(keys: Sequence[str | Column]) -> list[Column]:
    return [F.col(key) if isinstance(key, str) else key for key in keys]


def _total(df: DataFrame, order_by: Sequence[str | Column]) -> list[Column]:
    """The order with ties broken by name, so that two runs agree and one key value may span partitions."""
    return _columns(order_by) + ([F.col("name")] if "name" in df.columns else [])


def number_rows(df: DataFrame, order_by: Sequence[str | Column] = BY_TIME, rn: str = "rn") -> DataFrame:
    """Add the 0-based position of each row in the given order, ties broken by name.

    Rows are range-partitioned and sorted, each partition is counted, and the counts of
    the partitions before it are added to the position inside the partition. Range bounds
    are sampled, so the sorted rows are settled once and both steps read that copy. The
    broadcast side has one row per range partition, whatever the size of the index.
    """
    keys = _total(df, order_by)
    ordered = settle(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id()),
        "numbered",
    )
    part = F.shiftright("_at", _ROW_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ordered.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    )
    return (
        ordered.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(rn, F.col("_start") + F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1))
        .drop("_part", "_start", "_at")
    )


def round_robin(df: DataFrame, partitions: int, order_by: Sequence[str | Column] = BY_TIME) -> DataFrame:
    """Give file number i of the order partition i mod n; ``slot`` is its place inside."""
    return deal(number_rows(df, order_by), partitions)


def deal(numbered: DataFrame, partitions: int, rn: str = "rn") -> DataFrame:
    """Round-robin over an index that already has row numbers."""
    return numbered.withColumn("partition_id", (F.col(rn) % partitions).cast("int")).withColumn(
        "slot", F.expr(f"{rn} div {partitions}")
    )


def used_partitions(dealt: DataFrame, partitions: int) -> int:
    """Partitions that have a file: as many as there are files, at most ``partitions``, at least one."""
    return max(1, min(partitions, dealt.count()))


def place(dealt: DataFrame, partitions: int, rn: str = "rn") -> DataFrame:
    """Move each file to the Spark partition it was dealt to, in order."""
    return dealt.repartitionById(partitions, F.col("partition_id")).sortWithinPartitions(rn)


def partition_sizes(df: DataFrame, partitions: int) -> DataFrame:
    """Files per partition of the round-robin spread, min(files, partitions) rows.

    The sizes follow from the number of files alone, so the index is counted, not dealt.
    """
    counted = df.agg(F.count(F.lit(1)).alias("files"))
    used = F.least(F.col("files"), F.lit(partitions))
    return (
        counted.where("files > 0")
        .select("files", F.explode(F.sequence(F.lit(0), used.cast("int") - 1)).alias("partition_id"))
        .select("partition_id", F.expr(f"(files - partition_id + {partitions - 1}) div {partitions}").alias("files"))
    )


@dataclass(frozen=True)
class _Key:
    """One column of an order, as a value that is compared with literals."""

    value: Column
    descending: bool
    nulls_first: bool

    def before(self, bound: object) -> Column:
        """Whether a row is sorted before one that has this value."""
        if bound is None:
            return F.lit(False) if self.nulls_first else self.value.isNotNull()
        earlier = self.value > F.lit(bound) if self.descending else self.value < F.lit(bound)
        return F.coalesce(earlier, F.lit(self.nulls_first))

    def order(self, name: str) -> Column:
        column = F.col(name)
        if self.descending:
            return column.desc_nulls_first() if self.nulls_first else column.desc_nulls_last()
        return column.asc_nulls_first() if self.nulls_first else column.asc_nulls_last()


def _keys(df: DataFrame, order_by: Sequence[str | Column]) -> list[_Key]:
    keys = []
    for column in _total(df, order_by):
        text = column._jc.node().sql()
        direction = re.fullmatch(r"(.*) (ASC|DESC) NULLS (FIRST|LAST)", text, re.DOTALL)
        if direction:
            column = F.expr(direction[1])
        descending = bool(direction) and direction[2] == "DESC"
        nulls_first = direction[3] == "FIRST" if direction else True
        # Microseconds do not depend on a time zone on their way through the driver.
        if isinstance(df.select(column).schema[0].dataType, T.TimestampType):
            column = F.unix_micros(column)
        keys.append(_Key(column, descending, nulls_first))
    return keys


def _at_most(keys: list[_Key], bound: Sequence[object]) -> Column:
    """Whether a row is the one with these values, or sorted before it."""
    result = F.lit(True)
    for key, value in reversed(list(zip(keys, bound))):
        result = key.before(value) | (key.value.eqNullSafe(F.lit(value)) & result)
    return result


def _cutoff(df: DataFrame, keys: list[_Key], rank: int, count: int) -> Sequence[object]:
    """The key of row number ``rank`` of the order, from 1, of ``count`` rows.

    Rows are drawn to choose bounds around it, and the rows up to each bound are counted, until the
    cutoff is among few rows. No row is moved for it but the drawn ones and those few.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    order = [k.order(n) for k, n in zip(keys, names)]
    inside = df.select(*[k.value.alias(n) for k, n in zip(keys, names)])
    compared = [_Key(F.col(n), k.descending, k.nulls_first) for k, n in zip(keys, names)]
    rows, turn = inside, 0
    while count > NARROW and turn < 64:
        turn += 1
        drawn = F.pmod(F.xxhash64(*names, F.lit(turn)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, DRAWN / count))
        sample = rows.where(drawn).orderBy(*order).limit(4 * DRAWN).collect()
        middle, reach = rank / count * len(sample), 3 * len(sample) ** 0.5 + 1
        places = {int(middle - reach + 2 * reach * i / (BOUNDS - 1)) for i in range(BOUNDS)}
        bounds = [tuple(sample[p]) for p in sorted(places) if 0 <= p < len(sample)]
        if not bounds:
            continue
        upto = rows.agg(*[F.count_if(_at_most(compared, b)).alias(f"n{i}") for i, b in enumerate(bounds)]).first()
        below = max((i for i, n in enumerate(upto) if n < rank), default=None)
        above = min((i for i, n in enumerate(upto) if n >= rank), default=None)
        first, last = 0 if below is None else upto[below], count if above is None else upto[above]
        if below is not None:
            rows = rows.where(~_at_most(compared, bounds[below]))
        if above is not None:
            rows = rows.where(_at_most(compared, bounds[above]))
        if last - first == count and turn > 8:
            break  # all of them are equal
        rank, count = rank - first, last - first
    return tuple(rows.orderBy(*order).offset(rank - 1).limit(1).first())


def take_first(df: DataFrame, order_by: Sequence[str | Column], limit: int | None) -> DataFrame:
    """The first ``limit`` rows of the order, in any order, ties broken by name; all rows for None.

    The last of them is found first, by counts; then the rows up to it are kept where they are.
    Rows that have the same name and order are taken together.
    """
    if limit is None:
        return df
    if limit <= 0:
        return df.where(F.lit(False))
    count = df.count()
    if count <= limit:
        return df
    keys = _keys(df, order_by)
    return df.where(_at_most(keys, _cutoff(df, keys, limit, count)))
