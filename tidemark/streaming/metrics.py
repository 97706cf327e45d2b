"""What every trigger of a stream read and did (A9): a listener over Spark's progress events and the runs' results.

The rows of a trigger are counted by ``observe`` as they are read, without a job of
their own; late, held and written rows come from the run (counted while writing).
"""

from __future__ import annotations

import threading
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..plans.increment import RunResult
from ..schemas import TS


@dataclass
class Trigger:
    """One micro-batch.  ``read``: rows read; ``undated``: those without a time; ``watermark``: Spark's event-time mark, if the
    stream has one; ``result``: what the run did (None until it ended)."""

    batch_id: int
    read: int = 0
    undated: int = 0
    watermark: str | None = None
    result: RunResult | None = None


@dataclass
class TriggerMetrics(StreamingQueryListener):
    """Register with ``spark.streams.addListener`` and hand to ``run_stream``."""

    triggers: dict = field(default_factory=dict)  # (stream name, batch id) -> Trigger

    def __post_init__(self):
        super().__init__()
        self._lock = threading.Lock()
        self._told: set = set()

    @staticmethod
    def _name(stream: str) -> str:
        return f"{stream}_rows"

    def observed(self, stream: DataFrame, name: str) -> DataFrame:
        return stream.observe(self._name(name), F.count(F.lit(1)).alias("read"), F.count(F.when(F.col(TS).isNull(), 1)).alias("undated"))

    def _trigger(self, name: str, batch_id: int) -> Trigger:
        with self._lock:
            return self.triggers.setdefault((name, batch_id), Trigger(batch_id))

    def applied(self, name: str, batch_id: int, result: RunResult) -> None:
        self._trigger(name, batch_id).result = result

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        counts = progress.observedMetrics.get(self._name(progress.name))
        if counts is None:
            return
        trigger = self._trigger(progress.name, progress.batchId)
        trigger.read, trigger.undated = counts["read"], counts["undated"]
        trigger.watermark = progress.eventTime.get("watermark")
        self._told.add((progress.name, progress.batchId))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def wait(self, seconds: float = 30.0) -> list[Trigger]:
        """The triggers in order, once Spark has told of all that ran (events come a little after a trigger's end)."""
        end = time.monotonic() + seconds
        while set(self.triggers) - self._told and time.monotonic() < end:
            time.sleep(0.1)
        return [self.triggers[k] for k in sorted(self.triggers)]
