"""Stream positions: which listed files are due, and what is done after a step."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefetch.operators.ordering import BY_NAME, BY_TIME, number_rows, take_first
from tidefetch.session import settle

_FILE = "file:"


@dataclass(frozen=True)
class StartOffset:
    """Where a new stream starts: ``earliest``, ``latest`` or ``file:<name>``."""

    mode: str
    name: str | None = None

    @classmethod
    def parse(cls, text: str) -> StartOffset:
        """The mode words ignore case; the file prefix and the file name do not."""
        if text.lower() in ("earliest", "latest"):
            return cls(text.lower())
        if text.startswith(_FILE) and len(text) > len(_FILE):
            return cls("file", text[len(_FILE) :])
        raise ValueError(f"'startOffset' must be 'earliest', 'latest' or 'file:<filename>', not '{text}'")


def start_position(index: DataFrame, start_offset: str) -> DataFrame:
    """Names a new stream skips. A ``file:`` start need not be listed, and is not skipped."""
    start = StartOffset.parse(start_offset)
    names = index.select("name")
    if start.mode == "earliest":
        return names.where(F.lit(False))
    if start.mode == "latest":
        return names
    return names.where(F.col("name") < F.lit(start.name))


def unprocessed(index: DataFrame, processed: DataFrame) -> DataFrame:
    """Listed files that are not in the position."""
    return index.join(processed, "name", "left_anti")


def still_listed(index: DataFrame, processed: DataFrame) -> DataFrame:
    """Listed files that are in the position."""
    return index.join(processed, "name", "left_semi")


def files_between(start: DataFrame, end: DataFrame) -> DataFrame:
    """Names in the end position that the start position lacks."""
    return end.join(start, "name", "left_anti").select("name")


def positions_equal(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row with ``equal``: whether two positions hold the same names."""
    sides = left.select("name", F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select("name", F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    return (
        sides.groupBy("name")
        .agg(F.max("l").alias("l"), F.max("r").alias("r"))
        .agg((F.count_if(F.col("l") != F.col("r")) == 0).alias("equal"))
    )


def rate_limited(
    index: DataFrame,
    processed: DataFrame,
    max_files: int | None,
    order_by: Sequence[str | Column] = BY_TIME,
) -> DataFrame:
    """The files of the next micro-batch; None lifts the limit."""
    return take_first(unprocessed(index, processed), order_by, max_files)


def next_position(index: DataFrame, processed: DataFrame, taken: DataFrame) -> DataFrame:
    """Position after a step: taken files, and processed ones that are still listed.

    The two parts have no name in common, so no distinct is needed.
    """
    return taken.select("name").unionByName(still_listed(index, processed).select("name"))


def next_position_snapshot(processed: DataFrame, taken: DataFrame) -> DataFrame:
    """Position after a step of a snapshot drain: nothing is forgotten."""
    return processed.select("name").unionByName(taken.select("name"))


@dataclass(frozen=True)
class Step:
    """A micro-batch: the files to read and the position once they are read."""

    taken: DataFrame
    position: DataFrame


def plan_step(
    index: DataFrame,
    processed: DataFrame,
    max_files: int | None,
    order_by: Sequence[str | Column] = BY_TIME,
    keep: Callable[[DataFrame, str], DataFrame] = settle,
) -> Step | None:
    """Plan the next micro-batch of a polled source, or None if nothing is due.

    Without a due file the position stays as it is: delisted names are only forgotten by
    a step that takes files. ``keep`` writes the taken files as a table; the position is
    not written, so write it before planning many steps on top.
    """
    taken = keep(rate_limited(index, processed, max_files, order_by), "taken")
    if taken.isEmpty():
        return None
    return Step(taken, next_position(index, processed, taken))


def drain_plan(
    snapshot: DataFrame,
    processed: DataFrame,
    max_files: int | None,
    order_by: Sequence[str | Column] = BY_NAME,
) -> DataFrame:
    """Cut all that is left of a snapshot into micro-batches: adds ``rn`` and ``step``."""
    numbered = number_rows(unprocessed(snapshot, processed), order_by)
    step = F.lit(0).cast("bigint") if max_files is None else F.expr(f"rn div {max_files}")
    return numbered.withColumn("step", step)
