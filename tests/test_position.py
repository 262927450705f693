from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidefetch.operators import position

POLLS = [
    # listed, files taken, position afterwards; two files per step
    ("abc", ["a", "b"], "ab"),
    ("abc", ["c"], "abc"),
    ("ac", None, "abc"),
    ("abc", None, "abc"),
    ("acd", ["d"], "acd"),
    ("abcd", ["b"], "abcd"),
]


def index(spark, names, at=lambda name: 0):
    return spark.createDataFrame([(n, at(n)) for n in names], "name string, ms long").select(
        "name", F.timestamp_millis("ms").alias("fetchedAt")
    )


def names(spark, values):
    return spark.createDataFrame([(v,) for v in values], "name string")


def found(frame):
    return sorted(r["name"] for r in frame.collect())


@pytest.mark.parametrize(
    ("start", "skipped"),
    [
        ("Earliest", []),
        ("lateST", ["Zug", "tide", "tide-2", "tide/1", "été"]),
        ("file:Zug", []),
        ("file:a", ["Zug"]),
        ("file:tide", ["Zug"]),
        ("file:tide-", ["Zug", "tide"]),
        ("file:tide/", ["Zug", "tide", "tide-2"]),
        ("file:u", ["Zug", "tide", "tide-2", "tide/1"]),
        ("file:日", ["Zug", "tide", "tide-2", "tide/1", "été"]),
    ],
)
def test_start_position(spark, start, skipped):
    # Mixed case, a name that begins another one, and letters beyond ASCII.
    listed = index(spark, ["tide/1", "été", "tide", "Zug", "tide-2"])
    assert found(position.start_position(listed, start)) == skipped


@pytest.mark.parametrize("start", ["", "newest", "FILE:a", "file:", "file", " earliest"])
def test_bad_start_offset(start):
    with pytest.raises(ValueError, match="startOffset"):
        position.StartOffset.parse(start)


@pytest.mark.parametrize(
    ("done", "limit", "taken", "after"),
    [
        ([], 2, ["file1", "file2"], ["file1", "file2"]),
        (["file1"], 10, ["file2", "file3"], ["file1", "file2", "file3"]),
        (["file1"], None, ["file2", "file3"], ["file1", "file2", "file3"]),
        (["file2", "gone"], 1, ["file1"], ["file1", "file2"]),
    ],
)
def test_plan_step(spark, done, limit, taken, after):
    step = position.plan_step(index(spark, ["file3", "file1", "file2"]), names(spark, done), limit)
    assert found(step.taken) == taken
    assert found(step.position) == after


def test_plan_step_takes_the_oldest_first(spark):
    times = {"a": 30, "b": 10, "c": 20, "d": 10}
    step = position.plan_step(index(spark, "abcd", times.get), names(spark, []), 3)
    assert found(step.taken) == ["b", "c", "d"]


def test_delisted_names_are_forgotten_by_steps_that_take_files(spark):
    done = names(spark, [])
    for listed, taken, after in POLLS:
        step = position.plan_step(index(spark, listed), done, 2)
        assert (None if step is None else found(step.taken)) == taken
        if step is not None:
            done = step.position
        assert found(done) == list(after)


def test_drain_is_cut_by_name(spark):
    times = {"a": 3, "b": 1, "c": 2, "d": 0, "e": 9}
    planned = position.drain_plan(index(spark, "edcba", times.get), names(spark, ["c", "x"]), 2)
    assert {r["name"]: (r["rn"], r["step"]) for r in planned.collect()} == {
        "a": (0, 0),
        "b": (1, 0),
        "d": (2, 1),
        "e": (3, 1),
    }
    assert {r["step"] for r in position.drain_plan(index(spark, "ab"), names(spark, []), None).collect()} == {0}


def test_next_position_of_a_snapshot_forgets_nothing(spark):
    after = position.next_position_snapshot(names(spark, ["a", "gone"]), names(spark, ["b"]))
    assert found(after) == ["a", "b", "gone"]


def test_files_between(spark):
    special = ["a b", "ü/ß", "c'd", 'e"f', "x,y", "{z}", "日本"]
    assert found(position.files_between(names(spark, ["1", "2"]), names(spark, ["1", "2", "3", "4"]))) == ["3", "4"]
    assert found(position.files_between(names(spark, ["1", "2"]), names(spark, ["1"]))) == []
    assert found(position.files_between(names(spark, []), names(spark, special))) == sorted(special)
    many = [f"file{i:04}" for i in range(1_000)]
    assert found(position.files_between(names(spark, []), names(spark, many))) == many


@pytest.mark.parametrize(
    ("left", "right", "equal"),
    [("ab", "ba", True), ("ab", "abb", True), ("ab", "a", False), ("a", "b", False), ("", "", True), ("", "a", False)],
)
def test_positions_equal(spark, left, right, equal):
    assert position.positions_equal(names(spark, left), names(spark, right)).first()["equal"] is equal
