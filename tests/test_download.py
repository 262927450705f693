from __future__ import annotations

import json

import pytest
from pyspark.errors import PythonException
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests import clients
from tidefetch.operators import download as download_module
from tidefetch.operators import metrics
from tidefetch.operators.download import ReadAhead, download
from tidefetch.operators.payload import as_records
from tidefetch.schema import RECORD_SCHEMA
from tidefetch.sources.fetchers import fetch_uri
from tidefetch.sources.listing import list_folder
from tidefetch.sources.reader import read_remote, read_table, remote


def index(spark, names):
    return spark.createDataFrame([(n,) for n in names], "name string").withColumn(
        "fetchedAt", F.timestamp_millis(F.lit(0))
    )


def contents(records):
    return {r["sourceFile"]["name"]: r for r in records.collect()}


EXPECTED = {
    f"file{n}.log": (f"gauge {port}", '{"port":"%s","height":%s}' % (port, height))
    for n, (port, height) in clients.TIDES.items()
}


def test_batch_end_to_end(spark):
    records = remote(spark).options(remoteClient=clients.MockClient, uri="http://localhost:5000", partitions=2).load()
    found = {n: (r["logMetadata"], bytes(r["logContent"]).decode()) for n, r in contents(records).items()}
    assert found == EXPECTED
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in records.schema.fields] == [
        (f.name, f.dataType.simpleString(), f.nullable) for f in RECORD_SCHEMA.fields
    ]


def test_client_by_text_and_path(spark):
    records = remote(spark).option("remoteClient", "tests.clients:MockClient").load("http://localhost:5000")
    assert records.count() == 3


def test_client_with_its_own_order(spark):
    records = remote(spark).options(remoteClient=clients.SortedClient, uri="http://h", partitions=1).load()
    assert [r["sourceFile"]["name"] for r in records.collect()] == ["file3.log", "file2.log", "file1.log"]


def test_other_schema_is_refused(spark):
    reader = remote(spark)
    assert reader.schema(RECORD_SCHEMA) is reader
    with pytest.raises(ValueError, match="fixed schema"):
        reader.schema(T.StructType.fromDDL("z string"))


def test_failed_downloads_become_rows(spark):
    records = contents(read_remote(index(spark, ["file1.log", "nope.log"]), clients.fetch_mock, 2, parser="json"))
    assert records["file1.log"]["error"] is None
    lost = records["nope.log"]
    assert lost["error"] == "File not found: nope.log"
    assert (lost["logMetadata"], lost["logContent"], lost["rawFileBinary"]) == (None, None, None)
    assert lost["downloadTimestamp"] is not None


@pytest.mark.parametrize("ahead", [None, ReadAhead(4, 2)])
def test_other_exceptions_fail_the_task(spark, ahead):
    records = read_remote(index(spark, clients.PAYLOADS), clients.fetch_broken, 2, read_ahead=ahead)
    with pytest.raises(PythonException, match="broken fetch"):
        records.collect()


def test_several_records_per_file_and_private_options(spark):
    records = read_remote(
        index(spark, ["n0", "n1", "n3"]), clients.fetch_lines, 2, parser=None, options={"prefix": "p"}
    ).collect()
    assert sorted((r["sourceFile"]["name"], r["logMetadata"]) for r in records) == [
        ("n1", "p0"),
        ("n3", "p0"),
        ("n3", "p1"),
        ("n3", "p2"),
    ]


def test_no_files(spark):
    assert read_remote(index(spark, []), clients.fetch_mock, 3).count() == 0


def test_small_batches_give_the_same_rows(spark, monkeypatch):
    monkeypatch.setattr(download_module, "BATCH_ROWS", 1)
    records = read_remote(index(spark, clients.PAYLOADS), clients.fetch_mock, 1, parser="json")
    assert set(contents(records)) == set(clients.PAYLOADS)


def test_read_ahead_gives_the_same_records(spark):
    files = index(spark, [*clients.PAYLOADS, *(f"gone{i}" for i in range(30))])
    plain = read_remote(files, clients.fetch_mock, 3, parser="json").drop("downloadTimestamp")
    ahead = read_remote(files, clients.fetch_mock, 3, parser="json", read_ahead=ReadAhead(5, 3)).drop("downloadTimestamp")
    key = lambda rows: sorted(map(repr, rows.collect()))
    assert key(plain) == key(ahead)
    assert plain.count() == 33


def test_read_ahead_is_bounded(spark):
    plan = index(spark, [f"f{i:03}" for i in range(40)]).coalesce(1)
    flying = [
        json.loads(bytes(r["content"]))["flying"]
        for r in download(plan, clients.fetch_counting, read_ahead=ReadAhead(files=3, threads=8)).collect()
    ]
    assert len(flying) == 40
    assert 1 < max(flying) <= 3


def test_read_ahead_emits_what_finishes_first(spark):
    plan = index(spark, [f"f{i:03}" for i in range(6)]).coalesce(1)
    rows = download(plan, clients.fetch_slow_first, read_ahead=ReadAhead(files=6, threads=6)).collect()
    assert rows[-1]["name"] == "f000"
    assert len(rows) == 6


def test_read_ahead_gives_up(spark):
    plan = index(spark, ["f"]).coalesce(1)
    with pytest.raises(PythonException, match="no download finished"):
        download(plan, clients.fetch_hanging, read_ahead=ReadAhead(1, 1, wait_seconds=0.2)).collect()


def test_clients_are_closed(spark, tmp_path):
    (tmp_path / "a.log").write_bytes(b"h|==|\nc")
    marks = tmp_path / "marks"
    reader = remote(spark).options(
        remoteClient=clients.FolderClient, uri=f"file:{tmp_path}", marks=str(marks), partitions=1, failingClose="true"
    )
    records = reader.load()
    assert marks.read_text().split() == ["open", "close"]
    assert contents(records)["a.log"]["logMetadata"] == "h"
    assert marks.read_text().split().count("close") == marks.read_text().split().count("open") >= 2


def test_failing_listing_is_raised_and_the_client_closed(spark, tmp_path):
    (tmp_path / "FAIL").touch()
    marks = tmp_path / "marks"
    reader = remote(spark).options(remoteClient=clients.FolderClient, uri=f"file:{tmp_path}", marks=str(marks))
    with pytest.raises(ConnectionError, match="listing failed"):
        reader.load()
    assert marks.read_text().split() == ["open", "close"]


def test_folder_listing_and_uri_fetch(spark, tmp_path):
    for name, body in (("a.log", b"m1|==|\n\xff\x00"), ("b.log", b"plain"), ("c.txt", b"other")):
        (tmp_path / name).write_bytes(body)
    files = list_folder(spark, str(tmp_path), "*.log")
    rows = files.collect()
    assert sorted((r["name"].rsplit("/", 1)[1], r["fileSize"]) for r in rows) == [("a.log", 9), ("b.log", 5)]
    assert all(r["lastModified"] is not None for r in rows)
    gone = files.where(F.col("name").endswith("b.log"))
    (tmp_path / "b.log").rename(tmp_path / "b.moved")
    records = contents(read_remote(files.where(F.col("name").endswith("a.log")).unionByName(
        index(spark, [f"file://{tmp_path}/b.log"]).select(
            "name", "fetchedAt", *[F.lit(None).cast(f.dataType).alias(f.name) for f in files.schema.fields[2:]]
        )), fetch_uri, 2))
    by_name = {n.rsplit("/", 1)[1]: r for n, r in records.items()}
    assert (by_name["a.log"]["logMetadata"], bytes(by_name["a.log"]["logContent"])) == ("m1", b"\xff\x00")
    assert by_name["b.log"]["error"].startswith("File not found: ")
    assert gone is not None


def test_downloads_are_never_broadcast(spark):
    names = index(spark, clients.PAYLOADS)
    records = read_remote(names, clients.fetch_mock, 2, parser="json").select("sourceFile.name", "logContent")
    assert "BroadcastHashJoin [name" not in names.join(records, "name")._jdf.queryExecution().sparkPlan().toString()
    allowed = read_remote(names, clients.fetch_mock, 2, parser="json", broadcastable=True)
    joined = names.join(allowed.select("sourceFile.name", "logContent"), "name")
    assert "BroadcastHashJoin [name" in joined._jdf.queryExecution().sparkPlan().toString()


def test_payload_table_is_read_like_a_source(spark):
    payloads = spark.createDataFrame([(n, bytearray(p.encode())) for n, p in clients.PAYLOADS.items()],
                                     "name string, content binary")
    records = contents(read_table(index(spark, [*clients.PAYLOADS, "x"]), payloads, 2, parser="json"))
    assert {n: (r["logMetadata"], bytes(r["logContent"]).decode()) for n, r in records.items() if n != "x"} == EXPECTED
    assert records["x"]["error"] == "File not found: x"


def test_payloads_are_hashed_not_sorted(spark):
    payloads = spark.range(10).select(F.col("id").cast("string").alias("name"), F.lit(b"").alias("content"))
    plan = read_table(index(spark, ["1"]), payloads)._jdf.queryExecution().sparkPlan().toString()
    assert "ShuffledHashJoin [name" in plan and "BuildLeft" in plan


def sized(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "name string, fileSize long")
    return frame.withColumn("fetchedAt", F.timestamp_millis(F.lit(0)))


def test_task_figures(spark):
    rows = download(sized(spark, {"a": 44, "b": 69, "bad": 1}).coalesce(1), clients.fetch_sized)
    (figures,) = metrics.task_figures(rows).collect()
    assert (figures["files"], figures["failed"], figures["bytes"], figures["records"]) == (2, 1, 125, 3)
    assert metrics.metrics_report(metrics.task_figures(rows)).count() == 13


def test_metrics_are_observed_while_reading(spark):
    seen = Observation("downloads")
    files = sized(spark, {"a": 94, "b": 94, "c": 94, "bad": 1})
    records = read_remote(files, clients.fetch_sized, 2, observation=seen)
    assert records.count() == 4
    got = seen.get
    assert got["total_bytes_downloaded"] == 300
    assert (got["max_files_downloaded"], got["min_files_downloaded"], got["avg_files_downloaded"]) == (2, 1, 1)
    assert len(got) == 13


def test_outcome_rows_feed_the_records(spark):
    rows = download(sized(spark, {"a": 4}), clients.fetch_sized)
    assert as_records(rows, "separator").first()["logMetadata"] == "h"


@pytest.mark.parametrize("parser", ["separator", "json"])
def test_given_records_are_kept_whatever_the_parser(spark, parser):
    records = read_remote(index(spark, ["n2"]), clients.fetch_lines, 1, parser=parser, options={"prefix": "p"}).collect()
    assert sorted(r["logMetadata"] for r in records) == ["p0", "p1"]


def test_bytes_without_a_parser_are_kept_raw(spark):
    (record,) = read_remote(index(spark, ["file1.log"]), clients.fetch_mock, 1, parser=None).collect()
    assert bytes(record["rawFileBinary"]) == clients.PAYLOADS["file1.log"].encode()


def test_the_listing_is_read_before_the_client_closes(spark, tmp_path):
    (tmp_path / "index").mkdir()
    reader = remote(spark).options(remoteClient=clients.ForgetfulClient, uri=f"file:{tmp_path}", home=str(tmp_path))
    assert [r["sourceFile"]["name"] for r in reader.load().collect()] == ["file1.log"]


def test_empty_tasks_open_no_client(spark, tmp_path):
    for name in "abc":
        (tmp_path / f"{name}.log").write_bytes(b"h|==|\nc")
    marks = tmp_path / "marks"
    reader = remote(spark).options(
        remoteClient=clients.FolderClient, uri=f"file:{tmp_path}", marks=str(marks), partitions=10
    )
    records = reader.load()
    assert records.count() == 3
    assert marks.read_text().split().count("open") == 1 + 3


@pytest.mark.parametrize("ahead", [None, ReadAhead(3, 2)])
def test_records_before_a_late_failure_stay(spark, ahead):
    rows = download(index(spark, ["good2", "lost3", "lost0", "good0"]).coalesce(1), clients.fetch_until_lost, read_ahead=ahead)
    records = as_records(rows, None).collect()
    assert sorted((r["sourceFile"]["name"], r["logMetadata"], r["error"]) for r in records if r["error"] is None) == [
        ("good2", "0", None), ("good2", "1", None), ("lost3", "0", None), ("lost3", "1", None), ("lost3", "2", None),
    ]
    assert sorted(r["error"] for r in records if r["error"]) == ["Lost: lost0", "Lost: lost3"]
    files = {r["name"]: (r["file_ok"], r["file_failed"], r["bytes"]) for r in rows.where("file_ok + file_failed > 0").collect()}
    assert files == {"good2": (1, 0, 10), "lost3": (0, 1, 0), "lost0": (0, 1, 0)}
    (figures,) = metrics.task_figures(rows).collect()
    # A file without records has no row, but it counts.
    assert (figures["files"], figures["failed"], figures["records"], figures["bytes"]) == (2, 2, 7, 10)


def test_a_file_of_many_records_takes_one_batch_of_memory(spark):
    rows = download(index(spark, ["endless"]), clients.fetch_endless)
    assert rows.select(F.length("logContent").alias("n")).agg(F.count("n"), F.sum("n")).first() == (200_000, 200_000_000)
    # Records are drawn only as batches are asked for.
    drawn = []

    def source():
        for i in range(10_000):
            drawn.append(i)
            yield {"logContent": b""}

    records = download_module._Download({}, source(), None, 0).records()
    assert [next(records) for _ in range(5)] and drawn == list(range(5))


def test_tasks_without_records_report_their_figures(spark):
    files = index(spark, ["good0", "good0b0"]).coalesce(1)
    rows = download(files, clients.fetch_until_lost)
    assert as_records(rows, None).count() == 0
    (figures,) = metrics.task_figures(rows).collect()
    assert (figures["files"], figures["failed"], figures["records"], figures["bytes"]) == (2, 0, 0, 0)
    seen = Observation("none")
    assert read_remote(index(spark, ["good0"]), clients.fetch_until_lost, 2, parser=None, observation=seen).count() == 0
    assert seen.get["max_files_downloaded"] == 1
    assert download(index(spark, []), clients.fetch_until_lost).count() == 0


@pytest.mark.parametrize(("files", "partitions", "tasks"), [(3, 10, 3), (0, 10, 0), (10, 3, 3)])
def test_there_are_no_more_tasks_than_files(spark, files, partitions, tasks):
    records = read_remote(index(spark, [f"n{i}" for i in range(files)]), clients.fetch_lines, partitions, options={"prefix": ""})
    assert records.rdd.getNumPartitions() == tasks


@pytest.mark.parametrize("parser", ["separator", None])
def test_payloads_that_are_not_asked_for_stay_in_the_tasks(spark, parser):
    files = sized(spark, {"a": 4, "bad": 1, "c": 9})
    whole = read_remote(files, clients.fetch_sized, 2, parser=parser)
    asked = ["error", "logMetadata", "sourceFile"]
    seen = Observation("pruned")
    few = read_remote(files, clients.fetch_sized, 2, parser=parser, columns=asked, observation=seen)
    assert sorted(few.columns) == asked
    tasks = [line for line in few._jdf.queryExecution().executedPlan().toString().splitlines() if "MapInArrow" in line]
    assert tasks and not any("content#" in t or "logContent#" in t or "rawFileBinary#" in t for t in tasks)
    key = lambda frame: sorted(map(repr, frame.select(*asked).collect()))
    assert key(few) == key(whole)
    assert seen.get["total_bytes_downloaded"] == 13 + 2 * 6
    again = read_remote(files, clients.fetch_sized, 2, parser=parser, columns=["logContent"])
    assert again.columns == ["logContent"]
