"""What a user writes to connect a source."""

from __future__ import annotations

import logging
from abc import ABC, abstractmethod
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession

log = logging.getLogger("tidefetch")


class RemoteClient(ABC):
    """Lists the files of a source on the driver and downloads them in the tasks.

    One client is made for a listing and one per download task; it gets all options as
    they were given. ``parser`` tells how payload bytes split: ``separator``, ``json``, or
    None for a client whose ``fetch`` returns records.
    """

    parser: str | None = "separator"

    def __init__(self, options: Mapping[str, str]):
        self.options = options

    @abstractmethod
    def list_files(self, spark: SparkSession) -> DataFrame:
        """All files on offer, with at least the index columns ``name`` and ``fetchedAt``."""

    def order_by(self) -> Sequence[str | Column] | None:
        """Order of a batch read, if it is not by time. Asked on the driver."""
        return None

    @abstractmethod
    def fetch(self, file: dict, options: Mapping[str, str]) -> bytes | Iterator[dict]:
        """Payload or records of a file; ``DownloadError`` if it cannot be had."""

    def close(self) -> None:
        """Release what the client holds."""


@contextmanager
def opened(kind: type, options: Mapping[str, str]) -> Iterator:
    """A client that is closed afterwards. A failing close is logged only."""
    client = kind(options)
    try:
        yield client
    finally:
        try:
            client.close()
        except Exception as failure:  # the outcome of the work must not depend on it
            log.warning("closing the client failed: %s", failure)
