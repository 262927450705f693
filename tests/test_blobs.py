from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidefetch.operators.download import DownloadError, ReadAhead
from tidefetch.session import fresh_path
from tidefetch.sources.blobs import ADDRESS, OPEN_BLOBS, BlobReader, with_addresses, write_blobs
from tidefetch.sources.reader import read_remote
from tidefetch.streaming.plan import StreamPlan
from tidefetch.streaming.stream import planned_files, stream_records


def payloads(spark, count=60):
    rows = [(f"f{i:03}", bytearray(b"m%d|==|\n" % i + bytes([i]) * (i * 7 % 50))) for i in range(count)]
    return spark.createDataFrame([*rows, ("none", None), ("empty", bytearray())], "name string, content binary")


def index(spark, names):
    return spark.createDataFrame([(n,) for n in names], "name string").withColumn("fetchedAt", F.timestamp_millis(F.lit(0)))


def test_addresses_lead_to_the_payloads(spark, tmp_path):
    addresses = write_blobs(payloads(spark), f"{tmp_path}/blobs", blob_bytes=200)
    rows = addresses.collect()
    assert len(rows) == 61 and len({r.blob for r in rows}) > 5
    wanted = {r.name: r.content for r in payloads(spark).collect()}
    for r in rows:
        data = Path(r.blob.removeprefix("file:")).read_bytes()[r.offset : r.offset + r.length]
        assert data == bytes(wanted[r.name])


@pytest.mark.parametrize("ahead", [None, ReadAhead(8, 4)])
def test_ranges_are_read_in_the_tasks(spark, tmp_path, ahead):
    addresses = write_blobs(payloads(spark).repartition(3), f"{tmp_path}/blobs", blob_bytes=100)
    listed = index(spark, [f"f{i:03}" for i in range(60)] + ["none", "gone"])
    records = read_remote(with_addresses(listed, addresses), BlobReader, 4, read_ahead=ahead)
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert "content" not in "".join(line for line in plan.splitlines() if "Exchange" in line)
    found = {r.sourceFile.name: r for r in records.collect()}
    assert bytes(found["f013"].logContent) == bytes([13]) * 41 and found["f013"].logMetadata == "m13"
    assert {n: found[n].error for n in ("none", "gone")} == {n: f"File not found: {n}" for n in ("none", "gone")}


def test_blobs_that_are_gone_or_short(spark, tmp_path):
    (tmp_path / "b").write_bytes(b"0123456789")
    reader = BlobReader()
    at = {"name": "x", "blob": f"file://{tmp_path}/b", "offset": 2, "length": 3}
    assert reader.fetch(at, {}) == b"234"
    with pytest.raises(DownloadError, match="beyond the end"):
        reader.fetch({**at, "length": 9}, {})
    with pytest.raises(DownloadError, match="File not found: x"):
        reader.fetch({**at, "blob": f"file://{tmp_path}/c"}, {})
    for i in range(2 * OPEN_BLOBS):
        (tmp_path / f"n{i}").write_bytes(b"%03d" % i)
        assert reader.fetch({**at, "blob": f"file://{tmp_path}/n{i}", "offset": 0}, {}) == b"%03d" % i
    assert len(reader._open) == OPEN_BLOBS
    reader.close()


@pytest.mark.parametrize("max_files", [7, None])
def test_a_stream_reads_the_ranges_of_its_step_only(spark, tmp_path, max_files):
    addresses = write_blobs(payloads(spark), f"{tmp_path}/blobs")
    listed = with_addresses(index(spark, [f"f{i:03}" for i in range(30)]), addresses)
    plan = StreamPlan(spark, f"{tmp_path}/plan", max_files=max_files, partitions=3, extra=ADDRESS.fields)
    assert plan.drain(lambda: listed) == (5 if max_files else 1)
    counts = []

    def note(batch, number):
        rows = batch.collect()
        counts.append((number, sorted(r.sourceFile.name for r in rows), {r.step for r in rows}))

    files = planned_files(plan)
    assert "Join" not in files._jdf.queryExecution().logical().toString()
    records = stream_records(files, BlobReader, keep=("step",))
    run = records.writeStream.foreachBatch(note).option("checkpointLocation", fresh_path(spark, "c")).trigger(availableNow=True)
    run.start().awaitTermination()
    size = max_files or 30
    names = [f"f{i:03}" for i in range(30)]
    assert counts == [(n, names[n * size : (n + 1) * size], {n}) for n in range(-(-30 // size))]


def test_a_step_is_written_and_read_by_all_its_partitions(spark, tmp_path):
    plan = StreamPlan(spark, f"{tmp_path}/plan", max_files=None, partitions=5)
    names = spark.range(0, 4_000, 1, 4).select(F.format_string("f%05d", "id").alias("name"), F.timestamp_millis(F.lit(0)).alias("fetchedAt"))
    assert plan.drain(lambda: names) == 1
    sizes = spark.read.parquet(f"{plan.folder}/plan/step=0").groupBy("partition_id").count().collect()
    assert sorted(map(tuple, sizes)) == [(p, 800) for p in range(5)]
    tasks = []

    def note(batch, number):
        tasks.extend(batch.groupBy(F.spark_partition_id()).count().collect())

    run = planned_files(plan).writeStream.foreachBatch(note).option("checkpointLocation", fresh_path(spark, "c"))
    run.trigger(availableNow=True).start().awaitTermination()
    assert sorted(r["count"] for r in tasks) == [800] * 5


def test_steps_without_a_marker_are_written_anew(spark, tmp_path):
    plan = StreamPlan(spark, f"{tmp_path}/plan", max_files=2, partitions=2, poll_interval=0)
    listed = index(spark, "abcde")
    write = plan._fs.write

    def lost(name, content, millis):
        if "0001" in name:
            raise OSError("lost")
        write(name, content, millis)

    plan._fs.write = lost
    with pytest.raises(OSError):
        plan.drain(lambda: listed)
    again = StreamPlan(spark, plan.folder, max_files=2, partitions=2, poll_interval=0)
    assert again.last_step == 0
    assert sorted(r.name for r in again.position().collect()) == ["a", "b"]
    assert again.drain(lambda: index(spark, "abxyz")) == 2
    steps = spark.read.parquet(f"{plan.folder}/plan").groupBy("step").agg(F.array_sort(F.collect_list("name")).alias("n"))
    assert sorted(map(tuple, steps.collect())) == [(0, ["a", "b"]), (1, ["x", "y"]), (2, ["z"])]
