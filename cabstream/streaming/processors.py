"""The keyed stateful processor of `jobs.thin_stream`, the only per-row Python of its kind; the live job does without it.

Each call handles one key's rows of one micro-batch, whose size the source
options bound (``maxOffsetsPerTrigger``, ``maxFilesPerTrigger``). Rows arrive
shuffled, so they are put in event order before they are looked at.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

IDLE_STATE_MS = 3_600_000


def _in_order(rows: Iterator[pd.DataFrame], by: Sequence[str]) -> pd.DataFrame:
    chunks = list(rows)
    if not chunks:
        return pd.DataFrame()
    frame = chunks[0] if len(chunks) == 1 else pd.concat(chunks, ignore_index=True)
    return frame.sort_values(list(by), kind="stable", ignore_index=True)


class ThinningProcessor(StatefulProcessor):
    """Keep an event if it is ``interval_s`` or more away from the last kept one of its key.

    A late event is compared by absolute distance, as any other. State is one
    number per key; ``ttl_ms`` lets it expire, which needs processing time. Run
    in event time (``by_watermark``), events behind the watermark are dropped:
    the engine drops those behind the previous batch's watermark, this
    processor those behind the current one; idle keys then expire by timer.
    """

    def __init__(self, time: str, order: Sequence[str], interval_s: int = 2,
                 by_watermark: bool = False, ttl_ms: int | None = None) -> None:
        self.time, self.order, self.interval_s = time, list(order), interval_s
        self.by_watermark, self.ttl_ms = by_watermark, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        ttl = None if self.by_watermark else self.ttl_ms
        self.last = handle.getValueState("last_kept", "t LONG", ttl)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame],
                        timerValues: Any) -> Iterator[pd.DataFrame]:
        frame = _in_order(rows, self.order)
        if self.by_watermark and len(frame):
            frame = frame[frame[self.time] * 1000 >= timerValues.getCurrentWatermarkInMs()]
        last = self.last.get()[0] if self.last.exists() else None
        keep = []
        for t in frame[self.time].tolist() if len(frame) else ():
            kept = last is None or abs(t - last) >= self.interval_s
            keep.append(kept)
            last = t if kept else last
        if any(keep):
            self.last.update((int(last),))
            if self.by_watermark:
                for timer in list(self.handle.listTimers()):
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(int(last) * 1000 + (self.ttl_ms or IDLE_STATE_MS))
            yield frame[keep]

    def handleExpiredTimer(self, key: Any, timerValues: Any,
                           expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        self.last.clear()
        return iter(())

    def close(self) -> None:
        pass
