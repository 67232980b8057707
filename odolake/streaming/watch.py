"""Alarms for stages of the stream that fall silent, and their running totals."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

STAGE = "stage"  # name of the observed metrics below


def observed(rows: DataFrame) -> DataFrame:
    """Rows of a stage, counted as they pass; costs no further pass."""
    return rows.observe(STAGE, F.count("*").alias("rows"))


class StageWatch(StreamingQueryListener):
    """Hears of every micro-batch of the named queries and tells which have been silent for too long.

    A stage counts as heard from when a micro-batch had rows, or when its query began. ``clock`` gives
    the time in seconds. Spark calls a listener from a thread of its own, so the totals are guarded.
    """

    def __init__(self, silent_seconds: float = 90, clock: Callable[[], float] = time.time):
        self.silent, self.clock = silent_seconds, clock
        self.heard: dict[str, float] = {}
        self.totals: dict[str, int] = {}
        self.names: dict[str, str] = {}
        self.ended: set[str] = set()
        self.lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        with self.lock:
            name = self.names[str(event.id)] = event.name or str(event.id)
            self.heard.setdefault(name, self.clock())
            self.ended.discard(name)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        metrics = progress.observedMetrics.get(STAGE)
        rows = int(metrics["rows"]) if metrics is not None else progress.numInputRows
        self.passed(progress.name or str(progress.id), rows)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.lock:
            self.ended.add(self.names.get(str(event.id), str(event.id)))

    def passed(self, stage: str, rows: int) -> None:
        """Count the rows of a micro-batch."""
        with self.lock:
            self.totals[stage] = self.totals.get(stage, 0) + rows
            if rows or stage not in self.heard:
                self.heard[stage] = self.clock()

    def alarms(self) -> dict[str, float]:
        """Stages that still run and have passed no row for longer than allowed, with their silence in seconds."""
        now = self.clock()
        with self.lock:
            quiet = {s: now - t for s, t in self.heard.items() if s not in self.ended}
        return {s: t for s, t in quiet.items() if t > self.silent}
