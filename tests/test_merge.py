from __future__ import annotations

import pytest

from tidefetch.operators.merge import merge_listings, unique_index

SCHEMA = "name string, ms long, etag string"


def listing(spark, rows):
    return spark.createDataFrame([(n, ms, etag) for n, ms, etag in rows], SCHEMA)


@pytest.mark.parametrize(
    ("old", "fresh", "expected"),
    [
        ([("ebb", 7, "o")], [("ebb", 8, "f")], [("ebb", 7, "o")]),
        ([("ebb", 8, "o")], [("ebb", -8, "f")], [("ebb", -8, "f")]),
        ([("ebb", 0, "o")], [("ebb", 0, "f")], [("ebb", 0, "o")]),
        (
            [("kept", 40, "o"), ("delisted", 1, "o"), ("older", 90, "o")],
            [("older", 60, "f"), ("new", 50, "f"), ("kept", 41, "f")],
            [("kept", 40, "o"), ("new", 50, "f"), ("older", 60, "f")],
        ),
        ([], [("b", 2, "f"), ("a", 2, "f")], [("a", 2, "f"), ("b", 2, "f")]),
        ([("a", 1, "o")], [], []),
    ],
)
def test_merge(spark, old, fresh, expected):
    merged = merge_listings(listing(spark, old), listing(spark, fresh), at="ms").orderBy("ms", "name")
    assert [tuple(r) for r in merged.collect()] == expected


def test_a_name_listed_very_often_is_one_entry(spark):
    rows = [("hot", 10_000 - i, f"e{i}") for i in range(5_000)] + [(f"n{i}", i, "x") for i in range(100)]
    merged = {r["name"]: r["ms"] for r in merge_listings(listing(spark, []), listing(spark, rows), at="ms").collect()}
    assert merged == {"hot": 5_001, **{f"n{i}": i for i in range(100)}}


def test_unique_index_keeps_the_entry_listed_first(spark):
    rows = [("a", 2, "late"), ("a", 1, "early"), ("b", 1, "x")]
    assert {tuple(r) for r in unique_index(listing(spark, rows), at="ms").collect()} == {
        ("a", 1, "early"),
        ("b", 1, "x"),
    }
