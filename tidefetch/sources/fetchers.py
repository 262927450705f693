"""Ready-made fetch functions."""

from __future__ import annotations

from collections.abc import Mapping

from pyarrow import fs

from tidefetch.operators.download import DownloadError
from tidefetch.operators.payload import NOT_FOUND


def fetch_uri(file: dict, options: Mapping[str, str]) -> bytes:
    """Read a file whose name is a URI of a file system that Arrow knows."""
    system, path = fs.FileSystem.from_uri(file["name"])
    try:
        with system.open_input_stream(path) as stream:
            return stream.read()
    except FileNotFoundError as missing:
        raise DownloadError(NOT_FOUND + file["name"]) from missing


def fetch_content(file: dict, options: Mapping[str, str]) -> bytes:
    """Payload that a join has put into the ``content`` column of the plan."""
    if file["content"] is None:
        raise DownloadError(NOT_FOUND + file["name"])
    return file["content"]
