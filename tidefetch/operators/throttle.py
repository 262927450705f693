"""Replay a poll interval over a log of poll requests.

Which polls list depends on the last one that did, so each source is a chain. The time of a
source is cut into slices, and a slice is bounded by its milliseconds, however busy the
source is. Inside a slice the chain is followed from every poll it may be entered at. That
leaves a small graph of entries, in which the real one of each slice is found by doubling
pointers: log2 of the number of slices in a row that depend on each other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefetch.session import settle, ship_package

# Least width of a slice, in milliseconds and in poll intervals.
SLICE_MS = 600_000
SLICE_INTERVALS = 4

_KEYS = ["source", "slice"]
_NEVER = (1 << 63) - 1


def poll_throttle(polls: DataFrame, interval_ms: int, source: str = "source", at: str = "poll_ms") -> DataFrame:
    """Polls that list: those at least the interval after the last one that listed.

    Sources and times must not be null. Polls of one source at one time count once.
    """
    times = polls.select(F.col(source).alias("source"), F.col(at).cast("bigint").alias("t")).distinct()
    if interval_ms <= 0:
        return times.select(F.col("source").alias(source), F.col("t").alias(at))
    ship_package(polls.sparkSession)
    width = max(SLICE_MS, SLICE_INTERVALS * interval_ms)
    sliced = settle(times.withColumn("slice", _slice_of("t", width)), "polls")
    chains = settle(
        _slice_by_slice(sliced, lambda part: _leaves(part, interval_ms, width), "entry long, leave long, high long"),
        "chains",
    )
    entered = _entered(chains, interval_ms, width)
    marked = sliced.withColumn("enters", F.lit(0)).unionByName(
        entered.select("source", "t", _slice_of("t", width).alias("slice"), F.lit(1).alias("enters"))
    )
    kept = _slice_by_slice(marked, lambda part: _listing(part, interval_ms, width), "t long")
    return kept.select(F.col("source").alias(source), F.col("t").alias(at))


def _slice_of(column: str, width: int) -> Column:
    return F.expr(f"({column} - pmod({column}, {width})) div {width}")


def _slice_by_slice(df: DataFrame, work: Callable[[pd.DataFrame], pd.DataFrame], columns: str) -> DataFrame:
    """Apply ``work`` to whole slices, many at a time, rows in order of time."""
    order = [*_KEYS, "t"] + ([F.desc("enters")] if "enters" in df.columns else [])
    schema = T.StructType([df.schema[k] for k in _KEYS] + T.StructType.fromDDL(columns).fields)
    names = schema.fieldNames()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _whole_slices(batches):
            yield work(part)[names]

    return df.repartition(*_KEYS).sortWithinPartitions(*order).mapInPandas(run, schema)


def _whole_slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches cut anew, so that no slice is spread over two of them."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        first = np.flatnonzero(_begins(batch))
        cut = int(first[-1]) if len(first) else 0
        if held and cut == 0 and not _begins(pd.concat([held[-1].tail(1), batch.head(1)]))[-1]:
            held.append(batch)
            continue
        if held or cut:
            yield pd.concat([*held, batch.iloc[:cut]], ignore_index=True)
        held = [batch.iloc[cut:]]
    if held:
        yield pd.concat(held, ignore_index=True)


def _begins(part: pd.DataFrame) -> np.ndarray:
    """Which rows begin another slice than the row before them; the first row does."""
    source, slices = part["source"], part["slice"].to_numpy()
    same = (source == source.shift()).to_numpy(dtype=bool)
    same[1:] &= slices[1:] == slices[:-1]
    same[:1] = False
    return ~same


def _pointers(part: pd.DataFrame, interval: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slice number, time in the slice, and the next poll an interval later or the poll itself."""
    group = np.cumsum(_begins(part))
    time = part["t"].to_numpy() - part["slice"].to_numpy() * width
    line = group * (width + interval) + time
    after = np.searchsorted(line, line + interval)
    own = np.arange(len(line))
    within = after < len(line)
    within[within] = group[after[within]] == group[within]
    return group, time, np.where(within, after, own)


def _leaves(part: pd.DataFrame, interval: int, width: int) -> pd.DataFrame:
    """Per poll a chain may enter a slice at: the last poll of the chain in the slice."""
    group, time, pointer = _pointers(part, interval, width)
    while True:
        further = pointer[pointer]
        if np.array_equal(further, pointer):
            break
        pointer = further
    begins = np.diff(group, prepend=0) != 0
    early = time < interval
    follows_early = begins | np.concatenate(([False], early[:-1]))
    t = part["t"].to_numpy()
    ends = np.append(np.flatnonzero(begins)[1:], len(t)) - 1
    entries = part.assign(entry=t, leave=t[pointer], high=t[ends][group - 1])
    return entries[early | follows_early]


def _listing(part: pd.DataFrame, interval: int, width: int) -> pd.DataFrame:
    """The polls on the chain from the entry of each slice; it is marked by a row before it."""
    marks = np.flatnonzero(part["enters"].to_numpy() == 1)
    polls = part[part["enters"] == 0].reset_index(drop=True)
    on_chain = np.zeros(len(polls), dtype=bool)
    on_chain[marks - np.arange(len(marks))] = True
    pointer = _pointers(polls, interval, width)[2]
    while True:
        reached = pointer[on_chain]
        if on_chain[reached].all():
            return polls[on_chain]
        on_chain[reached] = True
        pointer = pointer[pointer]


def _entered(chains: DataFrame, interval: int, width: int) -> DataFrame:
    """The polls at which the slices are really entered (``source``, ``t``)."""
    in_source = Window.partitionBy("source").orderBy("slice")
    slices = (
        chains.groupBy(*_KEYS)
        .agg(F.min("entry").alias("low"), F.max("high").alias("high"))
        .select(*_KEYS, "low", F.lead("low").over(in_source).alias("after"), F.lag("high").over(in_source).alias("before"))
    )

    # Where each chain goes on: the first entry of the next slice that is late enough, or
    # else the first poll of the slice after that.
    wanted = chains.select(
        "source",
        (F.col("slice") + 1).alias("slice"),
        (F.col("leave") + interval).alias("at"),
        F.lit(0).alias("is_entry"),
        "entry",
        "high",
    )
    present = chains.select(
        "source", "slice", F.col("entry").alias("at"), F.lit(1).alias("is_entry"), "entry", "high"
    )
    latest_first = (
        Window.partitionBy(*_KEYS)
        .orderBy(F.desc("at"), F.desc("is_entry"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    following = F.last(F.when(F.col("is_entry") == 1, F.col("entry")), ignorenulls=True)
    links = (
        wanted.unionByName(present)
        .withColumn("found", following.over(latest_first))
        .where("is_entry = 0")
        .join(slices.select(*_KEYS, "low", F.col("after").alias("after_next")), _KEYS, "left")
        .withColumn("slice", F.col("slice") - 1)
        .join(slices.select(*_KEYS, "after"), _KEYS)
        .select(
            *_KEYS,
            F.col("entry").alias("t"),
            "high",
            F.coalesce("found", F.when(F.col("low").isNotNull(), F.col("after_next")).otherwise(F.col("after"))).alias(
                "target"
            ),
        )
    )
    links = settle(links, "links")

    # Entries that are known at once: those an interval after the poll before them, and those
    # that follow a slice which no chain passes by and which all leave for the same entry.
    target = F.coalesce("target", F.lit(_NEVER))
    decided = (
        links.groupBy(*_KEYS)
        .agg(F.min(target).alias("t"), F.max(target).alias("other"), F.max("high").alias("high"))
        .where((F.col("t") == F.col("other")) & (F.col("t") < _NEVER))
        .where(F.col("high") >= F.col("slice") * width + interval)
    )
    apart = slices.where(F.coalesce(F.col("low") - F.col("before"), F.lit(interval)) >= interval)
    known = settle(
        decided.select("source", "t").unionByName(apart.select("source", F.col("low").alias("t"))).distinct(),
        "known",
    )
    stops = known.select("source", F.col("t").alias("target"))
    jumps = settle(
        links.where("target is not null").join(stops, ["source", "target"], "left_anti").select("source", "t", "target"),
        "jumps",
    )
    entered, walked = known, None
    while not jumps.isEmpty():
        if walked is None:
            # Only known entries that lead on take part in the rounds.
            walked = settle(known.join(jumps.select("source", "t"), ["source", "t"], "left_semi"), "walked")
        reached = settle(walked.join(jumps, ["source", "t"]).select("source", F.col("target").alias("t")), "reached")
        entered, walked = entered.unionByName(reached), walked.unionByName(reached)
        onward = jumps.select("source", F.col("t").alias("target"), F.col("target").alias("beyond"))
        jumps = settle(
            jumps.join(onward, ["source", "target"]).select("source", "t", F.col("beyond").alias("target")), "jumps"
        )
    return entered
