"""A watchdog over a streaming query: it notices when nothing new has come for too long, and says so at most once in a while."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql.streaming import StreamingQueryListener

#: Fixed value: seconds between two notices.
NOTICE_SECONDS = 600


@dataclass
class Watch:
    """limit: seconds without rows from which the stream is stale (0: never); notify is called with the silence in seconds."""

    limit: float
    notify: Callable[[float], None]
    now: Callable[[], float] = time.monotonic
    progress: float = field(init=False)
    noticed: float | None = None

    def __post_init__(self):
        self.progress = self.now()

    def beat(self, rows: int) -> None:
        if rows:
            self.progress = self.now()

    def check(self) -> bool:
        """Whether the stream is stale; the first time, and then once in NOTICE_SECONDS, notify is called."""
        now = self.now()
        silent = now - self.progress
        if self.limit <= 0 or silent < self.limit:
            return False
        if self.noticed is None or now - self.noticed >= NOTICE_SECONDS:
            self.noticed = now
            self.notify(silent)
        return True


class WatchListener(StreamingQueryListener):
    """Feeds a watch from a session's queries: spark.streams.addListener(WatchListener(watch))."""

    def __init__(self, watch: Watch):
        self.watch = watch

    def onQueryStarted(self, event):
        self.watch.beat(1)

    def onQueryProgress(self, event):
        self.watch.beat(event.progress.numInputRows)
        self.watch.check()

    def onQueryIdle(self, event):
        self.watch.check()

    def onQueryTerminated(self, event):
        pass
