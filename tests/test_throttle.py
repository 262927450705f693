from __future__ import annotations

import random

import pandas as pd
import pytest

from tidefetch.operators import throttle


def kept_by_hand(polls, interval):
    kept, last = set(), {}
    for source, at in sorted(set(polls)):
        if source not in last or at - last[source] >= interval:
            kept.add((source, at))
            last[source] = at
    return kept


@pytest.mark.parametrize(("slice_ms", "intervals"), [(1, 1), (50, 2), (600_000, 4)])
@pytest.mark.parametrize("interval", [1, 7, 30, 400])
def test_same_as_walking_each_source(spark, monkeypatch, slice_ms, intervals, interval):
    monkeypatch.setattr(throttle, "SLICE_MS", slice_ms)
    monkeypatch.setattr(throttle, "SLICE_INTERVALS", intervals)
    draw = random.Random(interval + slice_ms)
    busy = [("busy", t) for t in range(-100, 600, 2)]
    uneven = [("uneven", t * t // 7) for t in range(200)]
    polls = busy + busy[:50] + uneven + [(f"s{draw.randrange(6)}", draw.randrange(-500, 4_000)) for _ in range(500)]
    frame = spark.createDataFrame(polls, "source string, poll_ms long")
    kept = [tuple(r) for r in throttle.poll_throttle(frame, interval).collect()]
    assert len(kept) == len(set(kept))
    assert set(kept) == kept_by_hand(polls, interval)


def batches_of(part, size):
    return (part.iloc[i : i + size] for i in range(0, len(part), size))


@pytest.mark.parametrize("size", [1, 2, 3, 7, 100])
def test_slices_are_never_torn(size):
    part = pd.DataFrame(
        {"source": list("aaaabbcccccccc"), "slice": [0, 0, 1, 1, 1, 1, 0, 0, 0, 0, 0, 2, 3, 3], "t": range(14)}
    )
    pieces = list(throttle._whole_slices(batches_of(part, size)))
    assert [t for piece in pieces for t in piece["t"]] == list(range(14))
    keys = [set(zip(piece["source"], piece["slice"])) for piece in pieces]
    assert sum(map(len, keys)) == len(set().union(*keys)) == 6


def test_no_interval_keeps_all(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 2)], "source string, poll_ms long")
    assert throttle.poll_throttle(frame, 0).count() == 2
