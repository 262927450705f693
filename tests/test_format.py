from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests import clients
from tidefetch.schema import RECORD_SCHEMA
from tidefetch.sources.format import NAME, publish, register
from tidefetch.sources.reader import read_remote


@pytest.fixture()
def files(spark, tmp_path):
    register(spark)
    folder = tmp_path / "files"
    folder.mkdir()
    for i in range(7):
        (folder / f"f{i}.log").write_bytes(b"m%d|==|\n" % i + bytes([200 + i]) * i)
    (folder / "plain.log").write_bytes(b"no separator")
    names = [(f"f{i}.log", i) for i in range(7)] + [("plain.log", 9), ("gone.log", 10)]
    index = spark.createDataFrame(names, "name string, fileSize long").withColumn(
        "fetchedAt", F.lit(dt.datetime(2024, 5, 6, 7, 8, 9, 123456))
    )
    return folder, index


def read(spark, listing, folder, **options):
    reader = spark.read.format(NAME).options(listing=listing, uri=f"file:{folder}", remoteClient="tests.clients:FolderClient")
    return reader.options(**options)



@pytest.mark.parametrize("ahead", ["false", "true"])
def test_the_named_format_reads_what_the_front_door_reads(spark, files, tmp_path, ahead):
    folder, index = files
    listing = publish(index, 3, folder=f"{tmp_path}/listing")
    named = read(spark, listing, folder, asyncDownloads=ahead).load()
    assert named.schema.simpleString() == RECORD_SCHEMA.simpleString()
    assert named.rdd.getNumPartitions() == 3
    wanted = read_remote(index, clients.FolderClient, 3, options={"uri": f"file:{folder}"})
    key = lambda frame: sorted(map(repr, frame.drop("downloadTimestamp").collect()))
    assert key(named) == key(wanted)
    assert named.where("downloadTimestamp is null").count() == 0


def test_another_schema_and_a_missing_listing_are_refused(spark, files, tmp_path):
    folder, index = files
    listing = publish(index, 2, folder=f"{tmp_path}/listing")
    with pytest.raises(Exception, match="fixed schema"):
        read(spark, listing, folder).schema("z string").load().collect()
    with pytest.raises(Exception, match="listing"):
        spark.read.format(NAME).option("remoteClient", "tests.clients:FolderClient").load().collect()
    with pytest.raises(Exception, match="by separator"):
        spark.read.format(NAME).options(listing=listing, remoteClient="tests.clients:MockClient").load().collect()


def test_a_listing_without_files_gives_no_records(spark, files, tmp_path):
    folder, index = files
    listing = publish(index.limit(0), 2, folder=f"{tmp_path}/listing")
    assert read(spark, listing, folder).load().count() == 0
