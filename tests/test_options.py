from __future__ import annotations

import pytest

from tests import clients
from tidefetch.sources.options import RemoteOptions, client_class, duration_nanos
from tidefetch.sources.reader import remote

BASE = {"uri": "http://localhost:5000"}

# Per rule of an option: the least value that is taken, and so what is not.
WHOLE = {
    "maxFilesPerTrigger": 1,
    "partitions": 1,
    "asyncDownloadThreads": 1,
    "asyncPrefetchSize": 1,
    "maxRetries": 0,
}
LONG_ENOUGH = {"connectTimeout": "999us", "readTimeout": "0ns", "retryDelay": "-3ms", "pollInterval": "-1h"}
FLAGS = ("asyncListFiles", "asyncDownloads", "enableSsl")
TEXTS = {
    "uri": ["", "\t", "ftp://a|b", "http://[half"],
    "startOffset": ["later", "file:", "earliest "],
    "remoteClient": ["", "\t", "tests.clients", "tests.clients:NoSuchClient", "not_there.at_all:Client"],
}

BAD = [
    *[(key, str(wrong)) for key, least in WHOLE.items() for wrong in (least - 1, least - 50, "2.5", "", "1e3", "four")],
    *[(key, wrong) for key, short in LONG_ENOUGH.items() for wrong in (short, "7", "s", "", "Infinity", "NaN s", "3 parsecs")],
    *[(key, wrong) for key in FLAGS for wrong in ("", "yes", "0")],
    *[(key, wrong) for key, values in TEXTS.items() for wrong in values],
]


class NeverListed(clients.MockClient):
    def __init__(self, options):
        raise AssertionError("a client was made before the options were checked")


@pytest.mark.parametrize("entry", ["batch", "stream"])
@pytest.mark.parametrize(("key", "value"), BAD)
def test_bad_value_is_refused_before_a_client_is_made(spark, tmp_path, entry, key, value):
    reader = remote(spark).options(remoteClient=NeverListed, **BASE).option(key, value)
    with pytest.raises(ValueError, match=key):
        reader.load() if entry == "batch" else reader.stream(str(tmp_path / "plan"))


def test_missing_values(spark):
    with pytest.raises(ValueError, match="remoteClient"):
        remote(spark).options(**BASE).load()
    with pytest.raises(ValueError, match="uri"):
        remote(spark).option("remoteClient", NeverListed).load()
    with pytest.raises(ValueError, match="uri"):
        remote(spark).options(remoteClient=NeverListed, **BASE).load("http://other")


def test_defaults():
    options = RemoteOptions.parse(BASE)
    assert (options.partitions, options.max_files_per_trigger, options.start_offset) == (4, 100, "earliest")
    assert (options.poll_interval, options.read_timeout, options.read_ahead) == (2.0, 60.0, None)


def test_least_values():
    options = RemoteOptions.parse(
        {
            **BASE,
            "connectTimeout": "1ms",
            "readTimeout": "1ms",
            "pollInterval": "0s",
            "retryDelay": "0s",
            "maxRetries": "0",
            "asyncDownloads": "TRUE",
            "asyncPrefetchSize": "1",
            "asyncDownloadThreads": "1",
        }
    )
    assert options.poll_interval == 0
    assert (options.read_ahead.files, options.read_ahead.threads, options.read_ahead.wait_seconds) == (1, 1, 0.002)


def test_names_ignore_case_and_private_options_pass_through():
    options = RemoteOptions.parse({"URI": "http://h", "PARTITIONS": 8, "myOwn": "x", "apiKey": "k"})
    assert (options.uri, options.partitions) == ("http://h", 8)
    assert options.passed == {"URI": "http://h", "PARTITIONS": "8", "myOwn": "x", "apiKey": "k"}


def test_older_names_count_when_the_new_one_is_missing():
    old = {"spark.remoteFile.asyncDownload.threads": "7", "asyncDownloads": "true"}
    assert RemoteOptions.parse({**BASE, **old}).read_ahead.threads == 7
    assert RemoteOptions.parse({**BASE, **old, "asyncDownloadThreads": "2"}).read_ahead.threads == 2
    for key, value in (("connectionTimeout", "0s"), ("spark.remoteFile.connectionTimeout", "0")):
        with pytest.raises(ValueError, match="connectTimeout"):
            RemoteOptions.parse({**BASE, key: value})
        RemoteOptions.parse({**BASE, key: value, "connectTimeout": "1s"})
    RemoteOptions.parse({**BASE, "spark.remoteFile.connectionTimeout": "5000"})


def test_secrets_are_not_shown():
    shown = repr(RemoteOptions.parse({**BASE, "apiKey": "k1", "APISECRET": "s2", "trustStorePassword": "p3", "x": "y"}))
    assert "k1" not in shown and "s2" not in shown and "p3" not in shown
    assert "'x': 'y'" in shown


@pytest.mark.parametrize(
    ("text", "nanos"),
    [("500ms", 500_000_000), ("10s", 10**10), ("5 minutes", 3 * 10**11), ("1.5s", 1_500_000_000), ("5", None), ("x", None)],
)
def test_durations(text, nanos):
    assert duration_nanos(text) == nanos


def test_client_class():
    assert client_class("tests.clients:MockClient") is clients.MockClient
    assert client_class(clients.MockClient) is clients.MockClient
