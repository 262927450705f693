"""Sources for the tests. Tasks import this module."""

from __future__ import annotations

import json
import os
import shutil
import threading
import time
from pathlib import Path

from pyspark.sql import functions as F

from tidefetch.operators.download import DownloadError
from tidefetch.sources.client import RemoteClient

TIDES = {1: ("Brest", 7.25), 2: ("Saint-Malo", 12.5), 3: ("Ouessant", 0.75)}
PAYLOADS = {
    f"file{n}.log": json.dumps({"port": port, "metadata": f"gauge {port}", "height": height})
    for n, (port, height) in TIDES.items()
}


class MockClient(RemoteClient):
    """Three JSON files held in memory."""

    parser = "json"

    def list_files(self, spark):
        return spark.createDataFrame([(n,) for n in PAYLOADS], "name string").withColumn(
            "fetchedAt", F.timestamp_millis(F.lit(0))
        )

    def fetch(self, file, options):
        return fetch_mock(file, options)


class SortedClient(MockClient):
    def order_by(self):
        return [F.desc("name")]


class FolderClient(RemoteClient):
    """Files of the folder named by the uri; each life of a client leaves a mark."""

    def __init__(self, options):
        super().__init__(options)
        self.folder = Path(options["uri"].removeprefix("file:"))
        self._mark("open")

    def _mark(self, event):
        if "marks" in self.options:
            with open(self.options["marks"], "a") as marks:
                marks.write(event + "\n")

    def list_files(self, spark):
        if (self.folder / "FAIL").exists():
            raise ConnectionError("listing failed")
        rows = [(p.name, p.stat().st_size) for p in sorted(self.folder.glob("*.log"))]
        return spark.createDataFrame(rows, "name string, fileSize long").withColumn(
            "fetchedAt", F.current_timestamp()
        )

    def fetch(self, file, options):
        try:
            return (self.folder / file["name"]).read_bytes()
        except FileNotFoundError as missing:
            raise DownloadError(f"File not found: {file['name']}") from missing

    def close(self):
        self._mark("close")
        if self.options.get("failingClose") == "true":
            raise OSError("close failed")


def fetch_mock(file, options):
    if file["name"] not in PAYLOADS:
        raise DownloadError(f"File not found: {file['name']}")
    return PAYLOADS[file["name"]].encode()


def fetch_broken(file, options):
    if file["name"] == "file2.log":
        raise RuntimeError("broken fetch")
    return b"h|==|\nc"


def fetch_lines(file, options):
    """One record per number in the name; none for zero."""
    count = int(file["name"][-1])
    return ({"logMetadata": f"{options['prefix']}{i}", "logContent": b"x" * 10} for i in range(count))


def fetch_until_lost(file, options):
    """Records up to the number in the name, then the source is lost."""
    for i in range(int(file["name"][-1])):
        yield {"logContent": b"y" * 5, "logMetadata": str(i)}
    if file["name"].startswith("lost"):
        raise DownloadError(f"Lost: {file['name']}")


def fetch_endless(file, options):
    """Many records, each noting how many came before it was asked for."""
    for i in range(200_000):
        yield {"logMetadata": str(i), "logContent": bytes(1000)}


def fetch_sized(file, options):
    if file["name"].startswith("bad"):
        raise DownloadError(f"File not found: {file['name']}")
    return b"h|==|\n" + b"x" * file["fileSize"]


_flying = 0
_lock = threading.Lock()


def fetch_counting(file, options):
    """Payload: how many downloads of this task were under way."""
    global _flying
    with _lock:
        _flying += 1
        now = _flying
    time.sleep(0.02)
    with _lock:
        _flying -= 1
    return json.dumps({"flying": now}).encode()


def fetch_slow_first(file, options):
    time.sleep(0.5 if file["name"] == "f000" else 0)
    return file["name"].encode()


def fetch_hanging(file, options):
    time.sleep(5)
    return b""


class ForgetfulClient(MockClient):
    """Its listing is a table that goes when the client closes."""

    def __init__(self, options):
        super().__init__(options)
        self.table = f"{options['home']}/index/names"

    def list_files(self, spark):
        super().list_files(spark).where("name = 'file1.log'").write.parquet(self.table)
        return spark.read.parquet(self.table)

    def close(self):
        if os.path.exists(self.table):
            shutil.rmtree(self.table)
