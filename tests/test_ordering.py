from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidefetch.operators import ordering


def files(spark, names):
    return spark.createDataFrame([(n,) for n in names], "name string").withColumn(
        "fetchedAt", F.timestamp_millis(F.lit(0))
    )


def dealt(frame, n):
    parts = [[] for _ in range(n)]
    for row in sorted(frame.collect(), key=lambda r: r.slot):
        parts[row.partition_id].append(row["name"])
    return parts


@pytest.mark.parametrize(
    ("names", "n", "expected"),
    [
        (["c", "a", "b", "d"], 3, [["a", "d"], ["b"], ["c"]]),
        (["f1", "f2", "f3", "f4"], 2, [["f1", "f3"], ["f2", "f4"]]),
        (["only"], 4, [["only"], [], [], []]),
        ([], 3, [[], [], []]),
    ],
)
def test_round_robin_by_name(spark, names, n, expected):
    assert dealt(ordering.round_robin(files(spark, names), n, ordering.BY_NAME), n) == expected


def test_round_robin_keeps_the_given_order(spark):
    given = spark.createDataFrame([("c", 0), ("a", 1), ("b", 2), ("d", 3)], "name string, list_pos int")
    assert dealt(ordering.round_robin(given, 3, ["list_pos"]), 3) == [["c", "d"], ["a"], ["b"]]


def test_default_order_is_time_then_name(spark):
    at = dt.datetime(2024, 1, 1, 10, 50), dt.datetime(2024, 1, 1, 10, 0), dt.datetime(2024, 1, 1, 10, 28)
    frame = spark.createDataFrame(
        [("entry1", at[0]), ("entry2", at[1]), ("entry3", at[2]), ("entry0", at[2])], "name string, fetchedAt timestamp"
    )
    rows = ordering.number_rows(frame).orderBy("rn").collect()
    assert [r["name"] for r in rows] == ["entry2", "entry0", "entry3", "entry1"]
    assert [r["rn"] for r in rows] == [0, 1, 2, 3]


def test_custom_order(spark):
    rows = ordering.number_rows(files(spark, ["file1", "file3", "file2"]), [F.desc("name")]).orderBy("rn").collect()
    assert [r["name"] for r in rows] == ["file3", "file2", "file1"]


def test_numbers_are_dense_when_one_time_holds_most_rows(spark):
    frame = spark.range(0, 20_000, 1, 16).select(
        F.format_string("f%06d", F.pmod(F.col("id") * 7919, F.lit(20_000))).alias("name"),
        F.timestamp_millis(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(5)).alias("fetchedAt"),
    )
    numbered = ordering.number_rows(frame)
    rows = numbered.orderBy("rn").collect()
    assert [r["rn"] for r in rows] == list(range(20_000))
    keys = [(r["fetchedAt"], r["name"]) for r in rows]
    assert keys == sorted(keys)


def test_numbering_needs_no_single_partition_of_rows(spark):
    plan = ordering.number_rows(files(spark, ["a", "b"]))._jdf.queryExecution().toString()
    single = [line for line in plan.splitlines() if "Exchange SinglePartition" in line]
    # Only the sizes of the range partitions meet in one task.
    assert len(single) <= 1
    assert "Window [row_number" not in plan


@pytest.mark.parametrize(("count", "n", "expected"), [(3, 10, [1, 1, 1]), (0, 4, []), (10, 4, [3, 3, 2, 2])])
def test_partition_sizes(spark, count, n, expected):
    rows = ordering.partition_sizes(files(spark, [f"f{i}" for i in range(count)]), n).orderBy("partition_id").collect()
    assert [r["files"] for r in rows] == expected


def test_place_moves_files_in_order(spark):
    frame = ordering.round_robin(files(spark, [f"f{i:03}" for i in range(50)]), 7, ordering.BY_NAME)
    placed = ordering.place(frame, 7)
    assert placed.rdd.getNumPartitions() == 7
    rows = placed.withColumn("at", F.spark_partition_id()).collect()
    assert all(r["at"] == r["partition_id"] for r in rows)
    for part in range(7):
        slots = [r["slot"] for r in rows if r["at"] == part]
        assert slots == sorted(slots)


@pytest.mark.parametrize("narrow", [1, 10, 1_000])
def test_take_first_is_the_same_however_far_it_is_narrowed(spark, monkeypatch, narrow):
    monkeypatch.setattr(ordering, "NARROW", narrow)
    monkeypatch.setattr(ordering, "DRAWN", 40)
    names = [f"f{i:04}" for i in range(300)]
    rows = ordering.take_first(files(spark, reversed(names)), ["name"], 25).collect()
    assert sorted(r["name"] for r in rows) == names[:25]


@pytest.mark.parametrize("limit", [0, 1, 7, 150, 299, 300, 5_000])
def test_take_first_equals_the_numbering(spark, monkeypatch, limit):
    monkeypatch.setattr(ordering, "NARROW", 8)
    monkeypatch.setattr(ordering, "DRAWN", 60)
    frame = spark.range(0, 300, 1, 5).select(
        F.format_string("f%04d", F.pmod(F.col("id") * 7919, F.lit(300))).alias("name"),
        F.when(F.col("id") % 11 > 0, F.timestamp_millis(F.col("id") % 13 * 1_000)).alias("fetchedAt"),
        F.when(F.col("id") % 5 > 0, F.pmod(F.hash("id"), F.lit(4))).alias("size"),
    )
    for order in (["fetchedAt"], [F.desc("size"), F.col("fetchedAt").asc_nulls_last()], [F.col("size") % 2, F.desc_nulls_first("fetchedAt")]):
        wanted = ordering.number_rows(frame, order).where(F.col("rn") < limit).select("name").collect()
        assert sorted(ordering.take_first(frame, order, limit).select("name").collect()) == sorted(wanted)


def test_take_first_moves_no_row_and_writes_nothing(spark, monkeypatch):
    monkeypatch.setattr(ordering, "settle", lambda *a: pytest.fail("written"))
    plan = ordering.take_first(files(spark, [f"f{i}" for i in range(50)]), ["name"], 10)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Sort" not in text and "Limit" not in text


def test_take_first_without_limit(spark):
    assert ordering.take_first(files(spark, ["b", "a"]), ["name"], None).count() == 2


@pytest.mark.parametrize("narrow", [1, 1_000])
def test_ties_of_an_order_are_broken_by_name(spark, monkeypatch, narrow):
    monkeypatch.setattr(ordering, "NARROW", narrow)
    frame = files(spark, [f"f{i * 7 % 300:04}" for i in range(1, 300)]).withColumn("lang", F.lit("en"))
    rows = ordering.take_first(frame, [F.desc("lang")], 40).collect()
    assert sorted(r["name"] for r in rows) == [f"f{i:04}" for i in range(1, 41)]


def test_one_key_value_spreads_over_partitions(spark):
    frame = spark.range(0, 200_000, 1, 8).select(F.format_string("f%06d", "id").alias("name"), F.lit("en").alias("lang"))
    keys = ordering._total(frame, ["lang"])
    sizes = frame.repartitionByRange(8, *keys).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 100_000
