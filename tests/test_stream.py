from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests import clients
from tests.test_position import POLLS
from tidefetch.schema import RECORD_SCHEMA
from tidefetch.sources.reader import remote
from tidefetch.streaming.plan import StreamPlan
from tidefetch.streaming.progress import StreamProgress


def put(folder, *names):
    for name in names:
        (folder / f"{name}.log").write_bytes(f"{name}|==|\nbody of {name}".encode())


def listing(spark, names):
    return spark.createDataFrame([(n,) for n in names], "name string").withColumn(
        "fetchedAt", F.timestamp_millis(F.lit(0))
    )


SINK = T.StructType([T.StructField("step", T.LongType()), *RECORD_SCHEMA.fields])


class Source:
    def __init__(self, tmp_path):
        self.files = tmp_path / "files"
        self.files.mkdir()
        self.home = tmp_path

    def stream(self, spark, unlimited=False, **options):
        return (
            remote(spark)
            .options(remoteClient=clients.FolderClient, uri=f"file:{self.files}", partitions=2, pollInterval="0s")
            .options(**options)
            .stream(f"{self.home}/plan", unlimited=unlimited)
        )

    def run(self, stream):
        """Read all planned files; names by step from the sink."""
        (
            stream.records(keep=("step",))
            .writeStream.format("parquet")
            .option("checkpointLocation", f"{self.home}/checkpoint")
            .option("path", f"{self.home}/sink")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
        return self.sink(stream._spark)

    def sink(self, spark):
        steps = {}
        records = spark.read.schema(SINK).parquet(f"{self.home}/sink")
        for row in records.orderBy("step", "sourceFile.name").collect():
            assert row["error"] is None
            assert bytes(row["logContent"]).decode() == f"body of {row['logMetadata']}"
            steps.setdefault(row["step"], []).append(row["logMetadata"])
        return steps


@pytest.fixture()
def source(tmp_path):
    return Source(tmp_path)


def test_snapshot_is_drained_in_steps_by_name(spark, source):
    put(source.files, "c", "a", "e", "b", "d")
    stream = source.stream(spark, maxFilesPerTrigger=2)
    assert stream.plan_snapshot() == 3
    put(source.files, "late")
    assert source.run(stream) == {0: ["a", "b"], 1: ["c", "d"], 2: ["e"]}


def test_one_step_per_micro_batch_in_order(spark, source):
    put(source.files, *(f"f{i:02}" for i in range(7)))
    stream = source.stream(spark, maxFilesPerTrigger=2)
    stream.plan_snapshot()
    batches = []
    (
        stream.records(keep=("step",))
        .writeStream.foreachBatch(lambda df, n: batches.append((n, sorted(r["step"] for r in df.collect()))))
        .option("checkpointLocation", f"{source.home}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    assert batches == [(0, [0, 0]), (1, [1, 1]), (2, [2, 2]), (3, [3])]


def test_restart_reads_each_file_once(spark, source):
    put(source.files, "a", "b", "c")
    stream = source.stream(spark, maxFilesPerTrigger=2)
    stream.plan_snapshot()
    assert source.run(stream) == {0: ["a", "b"], 1: ["c"]}
    again = source.stream(spark, maxFilesPerTrigger=2)
    assert again.plan_snapshot() == 0
    assert source.run(again) == {0: ["a", "b"], 1: ["c"]}
    put(source.files, "d", "aa")
    later = source.stream(spark, maxFilesPerTrigger=2)
    assert later.plan_snapshot() == 1
    assert source.run(later) == {0: ["a", "b"], 1: ["c"], 2: ["aa", "d"]}


def test_unlimited_steps_take_all(spark, source):
    put(source.files, "a", "b", "c")
    stream = source.stream(spark, unlimited=True, maxFilesPerTrigger=1)
    assert stream.plan_next() == 0
    put(source.files, "d")
    assert stream.plan_next() == 1
    assert source.run(stream) == {0: ["a", "b", "c"], 1: ["d"]}


def test_unlimited_snapshot_is_one_step_of_many_files(spark, tmp_path):
    plan = StreamPlan(spark, f"{tmp_path}/plan", max_files=None)
    names = spark.range(0, 5_000, 1, 4).select(
        F.format_string("f%05d", "id").alias("name"), F.timestamp_millis(F.lit(0)).alias("fetchedAt")
    )
    assert plan.drain(lambda: names) == 1
    step = spark.read.parquet(f"{plan.folder}/plan/step=0")
    assert (step.count(), step.select(F.count_distinct("rn")).first()[0]) == (5_000, 5_000)


@pytest.mark.parametrize(("start", "first"), [("earliest", "ab"), ("latest", ""), ("file:b.log", "b")])
def test_start_offsets(spark, source, start, first):
    put(source.files, "a", "b")
    stream = source.stream(spark, startOffset=start)
    assert (stream.plan_next() is None) == (first == "")
    # The start is fixed at the first planning, also for a later run.
    put(source.files, "c")
    stream = source.stream(spark, startOffset=start)
    stream.plan_next()
    read = [name for names in source.run(stream).values() for name in names]
    assert read == [*first, "c"]


def test_polled_steps_follow_the_listings(spark, tmp_path):
    plan = StreamPlan(spark, f"{tmp_path}/plan", max_files=2, poll_interval=0, snapshot_position_every=2)
    for listed, taken, after in POLLS:
        number = plan.advance(lambda names=listed: listing(spark, names))
        assert (number is None) == (taken is None)
        if taken is not None:
            step = spark.read.parquet(f"{plan.folder}/plan/step={number}")
            assert sorted(r["name"] for r in step.collect()) == taken
        assert sorted(r["name"] for r in plan.position().collect()) == list(after)
        assert [r["consumed"] for r in plan.progress().collect()] == [len(after)]
        assert plan.discovered == len(listed)
        # A planner that starts again knows the same position.
        fresh = StreamPlan(spark, plan.folder, max_files=2, poll_interval=0, snapshot_position_every=2)
        assert sorted(r["name"] for r in fresh.position().collect()) == list(after)
    assert spark.read.parquet(f"{plan.folder}/position/step=1").count() == 3


def test_position_is_written_after_a_long_drain(spark, tmp_path):
    plan = StreamPlan(spark, f"{tmp_path}/plan", max_files=1, poll_interval=0, snapshot_position_every=3)
    assert plan.drain(lambda: listing(spark, "abcd")) == 4
    assert (tmp_path / "plan" / "position" / "step=3" / "_SUCCESS").exists()
    for known in (plan, StreamPlan(spark, plan.folder, max_files=1, poll_interval=0, snapshot_position_every=3)):
        assert sorted(r["name"] for r in known.position().collect()) == list("abcd")
    # A later step takes the new name and forgets the ones that are gone.
    assert plan.advance(lambda: listing(spark, "ade")) == 4
    assert sorted(r["name"] for r in plan.position().collect()) == ["a", "d", "e"]


def lost_step(spark, plan, number, names):
    """What a planner leaves behind that is lost before its step counts."""
    frame = spark.createDataFrame([(n,) for n in names], "name string")
    frame.write.parquet(f"{plan.folder}/forgotten/step={number}")


@pytest.mark.parametrize("way", ["drain", "advance"])
def test_a_lost_step_forgets_nothing(spark, tmp_path, way):
    plan = StreamPlan(spark, f"{tmp_path}/plan", poll_interval=0)
    plan.drain(lambda: listing(spark, "ab"))
    lost_step(spark, plan, 1, "a")
    again = StreamPlan(spark, plan.folder, poll_interval=0)
    assert sorted(r["name"] for r in again.position().collect()) == ["a", "b"]
    getattr(again, way)(lambda: listing(spark, "abc"))
    last = StreamPlan(spark, plan.folder, poll_interval=0)
    assert sorted(r["name"] for r in last.position().collect()) == ["a", "b", "c"]


def test_progress_is_empty_before_a_step(spark, tmp_path):
    plan = StreamPlan(spark, f"{tmp_path}/plan")
    assert plan.drain(lambda: listing(spark, [])) == 0
    assert plan.progress().count() == 0


def test_layout_of_a_step_is_by_name(spark, tmp_path):
    plan = StreamPlan(spark, f"{tmp_path}/plan", max_files=10, partitions=2)
    plan.drain(lambda: listing(spark, "dcba"))
    rows = spark.read.parquet(f"{plan.folder}/plan/step=0").orderBy("rn").collect()
    assert [(r["name"], r["partition_id"], r["slot"]) for r in rows] == [
        ("a", 0, 0),
        ("b", 1, 0),
        ("c", 0, 1),
        ("d", 1, 1),
    ]


def test_times_of_first_sight_are_kept(spark, tmp_path):
    plan = StreamPlan(spark, f"{tmp_path}/plan", max_files=1, poll_interval=0)
    at = lambda ms: (lambda: listing(spark, "ab").withColumn("fetchedAt", F.timestamp_millis(F.lit(ms))))
    for ms in (1_000, 2_000):
        number = plan.advance(at(ms))
        row = spark.read.parquet(f"{plan.folder}/plan/step={number}").first()
        assert row["fetchedAt"].timestamp() == 1.0


def test_poll_interval_reuses_the_listing(spark, tmp_path):
    plan = StreamPlan(spark, f"{tmp_path}/plan", max_files=1, poll_interval=60)
    calls = []

    def list_files():
        calls.append(1)
        return listing(spark, "ab")

    assert [plan.advance(list_files) for _ in range(3)] == [0, 1, None]
    assert len(calls) == 1


def test_failed_discovery_is_no_empty_listing(spark, source):
    put(source.files, "existing")
    (source.files / "FAIL").touch()
    for start in ("latest", "earliest"):
        stream = source.stream(spark, startOffset=start)
        with pytest.raises(ConnectionError):
            stream.plan_snapshot()
        with pytest.raises(ConnectionError):
            stream.plan_next()
        assert stream.plan.last_step == -1
        assert not (source.home / "plan" / "start").exists() or start == "earliest"
    (source.files / "FAIL").rename(source.files / "was-failing")
    stream = source.stream(spark)
    assert stream.plan_snapshot() == 1
    assert source.run(stream) == {0: ["existing"]}


def test_background_listing_keeps_the_last_one_on_failure(spark, source):
    put(source.files, "a", "b")
    stream = source.stream(spark, asyncListFiles=True, maxFilesPerTrigger=1)
    assert stream.plan_next() == 0
    (source.files / "FAIL").touch()
    assert stream.plan_next() == 1
    assert stream.plan_next() is None
    (source.files / "FAIL").rename(source.files / "was-failing")
    put(source.files, "c")
    assert stream.plan_next() == 2


def test_first_background_listing_must_succeed(spark, source):
    (source.files / "FAIL").touch()
    with pytest.raises(ConnectionError):
        source.stream(spark, asyncListFiles=True).plan_next()


def test_planning_query_feeds_the_reading_query(spark, source):
    put(source.files, "a", "b", "c")
    stream = source.stream(spark, maxFilesPerTrigger=2, pollInterval="1s")
    planning = stream.start_planning(f"{source.home}/planning")
    reading = (
        stream.records(keep=("step",))
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{source.home}/checkpoint")
        .option("path", f"{source.home}/sink")
        .start()
    )
    try:
        deadline = time.time() + 90
        wanted = {"a", "b", "c"}
        while time.time() < deadline:
            time.sleep(1)
            if stream.plan.last_step >= 1 and "d" not in wanted:
                put(source.files, "d")
                wanted.add("d")
            if (source.home / "sink" / "_spark_metadata").exists():
                read = [n for names in source.sink(spark).values() for n in names]
                if set(read) == {"a", "b", "c", "d"}:
                    break
    finally:
        planning.stop()
        reading.stop()
    assert sorted(n for names in source.sink(spark).values() for n in names) == ["a", "b", "c", "d"]


def test_stream_metrics_are_reported(spark, source):
    put(source.files, "a", "b", "c")
    stream = source.stream(spark, maxFilesPerTrigger=3)
    stream._observation = "downloads"
    stream.plan_snapshot()
    run = (
        stream.records()
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{source.home}/checkpoint")
        .option("path", f"{source.home}/sink")
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    seen = [p["observedMetrics"]["downloads"] for p in run.recentProgress if p["observedMetrics"]]
    assert [row["total_bytes_downloaded"] for row in seen if row["total_bytes_downloaded"]] == [45]


def test_a_backlog_is_planned_at_once(spark, source):
    put(source.files, *"abcde")
    stream = source.stream(spark, maxFilesPerTrigger=2)
    assert stream.plan_backlog() == 3
    assert stream.plan_backlog() == 0


def test_a_planner_lost_while_it_writes_the_position_plans_nothing_again(spark, tmp_path, monkeypatch):
    plan = StreamPlan(spark, f"{tmp_path}/plan", max_files=2, poll_interval=0, snapshot_position_every=1)
    move = plan._fs.move

    def lost(origin, target):
        if target.startswith("position/"):
            raise OSError("lost")
        move(origin, target)

    monkeypatch.setattr(plan._fs, "move", lost)
    with pytest.raises(OSError):
        plan.advance(lambda: listing(spark, "ab"))
    again = StreamPlan(spark, plan.folder, max_files=2, poll_interval=0, snapshot_position_every=1)
    assert sorted(r["name"] for r in again.position().collect()) == ["a", "b"]
    assert again.advance(lambda: listing(spark, "ab")) is None


def test_a_backlog_is_the_same_as_its_steps_one_by_one(spark, tmp_path):
    at = {"a": 3, "b": 1, "c": 2, "d": 1, "e": 9, "gone": 0}
    frame = lambda names: spark.createDataFrame([(n, at[n]) for n in names], "name string, t long").select(
        "name", F.timestamp_millis("t").alias("fetchedAt")
    )
    found = {}
    for way in ("one", "all"):
        plan = StreamPlan(spark, f"{tmp_path}/{way}", max_files=2, poll_interval=0)
        plan.advance(lambda: frame(["gone"]))
        if way == "all":
            assert plan.advance_all(lambda: frame("abcde")) == 3
            assert plan.advance_all(lambda: frame("abcde")) == 0
        else:
            while plan.advance(lambda: frame("abcde")) is not None:
                pass
        rows = spark.read.parquet(f"{plan.folder}/plan").select("step", "rn", "name", "partition_id", "slot")
        found[way] = sorted(map(tuple, rows.collect())), sorted(r.name for r in plan.position().collect())
    assert found["one"] == found["all"]
    assert [n for s, _, n, *_ in found["all"][0] if s == 1] == ["b", "d"]


def test_progress_tells_when_the_position_was_planned(spark, tmp_path):
    plan = StreamPlan(spark, f"{tmp_path}/plan", max_files=2, poll_interval=0)
    started = time.time()
    plan.advance(lambda: listing(spark, "abc"))
    for known in (plan, StreamPlan(spark, plan.folder)):
        (row,) = known.progress().collect()
        assert (row.consumed, row.step) == (2, 0)
        assert started - 1 < row.planned_at.timestamp() < time.time() + 1


def test_live_progress_joins_figures_and_position(spark, source):
    put(source.files, *"abcde")
    stream = source.stream(spark, maxFilesPerTrigger=2)
    stream._observation = "live"
    progress = StreamProgress(stream.plan, "live")
    assert progress.latest() is None
    spark.streams.addListener(progress)
    try:
        stream.plan_backlog()
        run = stream.records().writeStream.format("noop").option("checkpointLocation", f"{source.home}/checkpoint").start()
        deadline = time.time() + 60
        while time.time() < deadline and sum(b["total_bytes_downloaded"] or 0 for b in progress.batches()) < 75:
            time.sleep(0.5)
        found = progress.latest()  # the query is still running
        assert run.isActive
        run.stop()
    finally:
        spark.streams.removeListener(progress)
    assert sum(b["total_bytes_downloaded"] or 0 for b in progress.batches()) == 75
    assert (found["consumed"], found["discovered"], found["step"]) == (5, 5, 2)
    assert abs(found["planned_at"].timestamp() - time.time()) < 120
