"""Options of a remote source: names, defaults and checks, done before any listing."""

from __future__ import annotations

import importlib
import re
from collections.abc import Mapping
from dataclasses import dataclass
from urllib.parse import urlsplit

from tidefetch.functions.formats import DURATION_PATTERN, UNIT_NANOS
from tidefetch.operators.download import ReadAhead
from tidefetch.operators.position import StartOffset

# Defaults of the options.
DEFAULTS = {
    "partitions": "4",
    "maxFilesPerTrigger": "100",
    "startOffset": "earliest",
    "pollInterval": "2s",
    "connectTimeout": "30s",
    "readTimeout": "60s",
    "maxRetries": "3",
    "retryDelay": "1s",
    "asyncDownloads": "false",
    "asyncPrefetchSize": "20",
    "asyncDownloadThreads": "4",
    "asyncListFiles": "false",
    "enableSsl": "false",
}

# Options whose value never shows in a log.
SECRETS = ("apiKey", "apiSecret", "trustStorePassword", "sessionId")

# Older names of an option, which count when the option is not set.
ALIASES = {
    "asyncDownloadThreads": ("spark.remoteFile.asyncDownload.threads",),
    "connectTimeout": ("connectionTimeout", "spark.remoteFile.connectionTimeout"),
}

_PLAIN_MILLIS = "spark.remoteFile.connectionTimeout"
_URI = re.compile(r"^[A-Za-z0-9\-._~:/?#\[\]@!$&'()*+,;=%]+$")


def duration_nanos(text: str) -> int | None:
    """Nanoseconds of a duration text, None if it is no finite duration with a unit."""
    match = re.match(DURATION_PATTERN, text)
    if not match:
        return None
    for spellings, nanos in UNIT_NANOS.items():
        if match[2] in spellings:
            return round(float(match[1]) * nanos)
    return None


class _Values:
    """Option values by name, in any case of letters."""

    def __init__(self, options: Mapping[str, object]):
        self.given = {str(k).lower(): str(v) for k, v in options.items() if v is not None}

    def get(self, key: str) -> str | None:
        return self.given.get(key.lower(), DEFAULTS.get(key))

    def first(self, key: str) -> tuple[str, str]:
        """Value of an option or of its aliases, with the name it was found under."""
        for name in (key, *ALIASES.get(key, ())):
            if name.lower() in self.given:
                return name, self.given[name.lower()]
        return key, DEFAULTS[key]

    def whole(self, key: str, least: int) -> int:
        text = self.first(key)[1].strip()
        if not re.fullmatch(r"[+-]?\d+", text) or int(text) < least:
            raise ValueError(f"'{key}' must be a whole number of at least {least}, not '{text}'")
        return int(text)

    def flag(self, key: str) -> bool:
        text = self.get(key).strip().lower()
        if text not in ("true", "false"):
            raise ValueError(f"'{key}' must be 'true' or 'false', not '{text}'")
        return text == "true"

    def seconds(self, key: str, least_nanos: int) -> float:
        name, text = self.first(key)
        nanos = duration_nanos(f"{text}ms" if name == _PLAIN_MILLIS else text)
        if nanos is None or nanos < least_nanos:
            raise ValueError(f"'{key}' must be a finite duration with a unit, at least {least_nanos} ns, not '{text}'")
        return nanos / 1e9

    def uri(self) -> str:
        uri, path = self.get("uri"), self.get("path")
        if uri is not None and path is not None:
            raise ValueError("both 'uri' and 'path' are set; use one of them")
        value = uri if uri is not None else path
        if value is None:
            raise ValueError("'uri' or 'path' is required")
        if not value.strip():
            raise ValueError("'uri' must not be empty")
        try:
            urlsplit(value)
            valid = bool(_URI.match(value))
        except ValueError:
            valid = False
        if not valid:
            raise ValueError(f"'uri' is not a valid URI: {value}")
        return value


@dataclass(frozen=True)
class RemoteOptions:
    """Checked options. ``passed`` holds all of them, as given, for the client."""

    uri: str
    partitions: int
    max_files_per_trigger: int
    start_offset: str
    poll_interval: float
    read_timeout: float
    read_ahead: ReadAhead | None
    async_list_files: bool
    passed: dict[str, str]

    @classmethod
    def parse(cls, options: Mapping[str, object]) -> RemoteOptions:
        values = _Values(options)
        start = values.get("startOffset")
        StartOffset.parse(start)
        values.whole("maxRetries", 0)
        values.flag("enableSsl")
        values.seconds("connectTimeout", 1_000_000)
        values.seconds("retryDelay", 0)
        read_timeout = values.seconds("readTimeout", 1)
        ahead = ReadAhead(
            files=values.whole("asyncPrefetchSize", 1),
            threads=values.whole("asyncDownloadThreads", 1),
            wait_seconds=2 * read_timeout,
        )
        return cls(
            uri=values.uri(),
            partitions=values.whole("partitions", 1),
            max_files_per_trigger=values.whole("maxFilesPerTrigger", 1),
            start_offset=start,
            poll_interval=values.seconds("pollInterval", 0),
            read_timeout=read_timeout,
            read_ahead=ahead if values.flag("asyncDownloads") else None,
            async_list_files=values.flag("asyncListFiles"),
            passed={str(k): str(v) for k, v in options.items() if v is not None},
        )

    def __repr__(self) -> str:
        secret = {s.lower() for s in SECRETS}
        shown = {k: "***" if k.lower() in secret else v for k, v in self.passed.items()}
        return f"RemoteOptions({shown})"


def client_class(given: object) -> type:
    """The client of the ``remoteClient`` option: a class, or its ``module:Class`` text."""
    if isinstance(given, type):
        return given
    if not isinstance(given, str) or not given.strip():
        raise ValueError("'remoteClient' must be a client class or a 'module:Class' text")
    module, _, name = given.partition(":")
    try:
        return getattr(importlib.import_module(module), name)
    except (ImportError, AttributeError, ValueError) as cause:
        raise ValueError(f"'remoteClient' cannot be loaded: {given}") from cause
