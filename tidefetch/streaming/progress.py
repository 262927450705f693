"""Live progress of a stream: what its micro-batches downloaded, next to the position of its plan."""

from __future__ import annotations

from collections import deque
from threading import Lock

from pyspark.sql.streaming import StreamingQueryListener

from tidefetch.streaming.plan import StreamPlan


class StreamProgress(StreamingQueryListener):
    """Keeps the observed figures of the last micro-batches of a stream that is observed as ``name``.

    Add it with ``spark.streams.addListener``. The callbacks only take notes; the position is read
    when ``latest`` is asked for.
    """

    def __init__(self, plan: StreamPlan, name: str, keep: int = 100):
        self._plan, self._name = plan, name
        self._batches: deque[dict] = deque(maxlen=keep)
        self._lock = Lock()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        figures = (event.progress.observedMetrics or {}).get(self._name)
        if figures is not None:
            row = {"batch": event.progress.batchId, "at": event.progress.timestamp, **figures.asDict()}
            with self._lock:
                self._batches.append(row)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def batches(self) -> list[dict]:
        """The figures of the last micro-batches, the newest last."""
        with self._lock:
            return list(self._batches)

    def latest(self) -> dict | None:
        """The newest figures with consumed, discovered, step and planned_at of the plan; None before any."""
        batches, position = self.batches(), self._plan.progress().first()
        return batches[-1] | position.asDict() if batches and position else None
