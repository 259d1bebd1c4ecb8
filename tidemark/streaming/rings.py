"""T1-T3 as custom state: a ring of pane counts for each key.

A window is a row of panes (``gcd(size, slide)`` long).  The state of a key is
one row for each pane that lies in a window still open, and the first window
that is not sent yet; a timer stands at that window's end.  When the watermark
passes it, all closed windows are summed from their panes and sent, and the
panes that no open window holds leave the state.  An hour sliding by 30
seconds so keeps at most 120 rows and the panes of the watermark's delay for a
key, not 120 windows for each pane.

Events are counted by key and pane in the task that reads them, so a key that
a third of all events carry costs a row a task and pane.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.streaming.windows import _seconds

#: panes a task counts before it passes them on
HELD = 100_000
_COUNTED = "key string, pane long, n long, last long"


def _count_panes(width: int):
    """Counts by key and pane, with the last event's time, all in milliseconds."""
    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, list[int]] = {}

        def out() -> pd.DataFrame:
            rows = [(k, p, n, last) for (k, p), (n, last) in held.items()]
            held.clear()
            return pd.DataFrame(rows, columns=["key", "pane", "n", "last"])
        for pdf in frames:
            pane = pdf["at"] // width * width
            for (k, p), own in pdf.groupby([pdf["key"], pane], dropna=False)["at"]:
                k = None if pd.isna(k) else k
                n, last = held.get((k, p), (0, own.iloc[0]))
                held[k, p] = [n + len(own), max(last, own.max())]
            if len(held) > HELD:
                yield out()
        if held:
            yield out()
    return run


class PaneRing(StatefulProcessor):
    """Pane counts of one key; sends its closed windows."""

    def __init__(self, size: int, slide: int):
        self.size, self.slide = size, slide

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.panes = handle.getMapState("panes", "pane long", "n long")
        self.next = handle.getValueState("next", "start long")

    def _first_start(self, pane: int) -> int:
        """Start of the first window that holds a pane."""
        return ((pane - self.size) // self.slide + 1) * self.slide

    def handleInputRows(self, key, rows, timerValues):
        added: dict[int, int] = {}
        for pdf in rows:
            for p, n in zip(pdf["pane"].tolist(), pdf["n"].tolist()):
                added[p] = added.get(p, 0) + n
        for p, n in added.items():
            before = self.panes.getValue((p,)) if self.panes.containsKey((p,)) else (0,)
            self.panes.updateValue((p,), (before[0] + n,))
        first = self._first_start(min(added))
        if not self.next.exists() or first < self.next.get()[0]:
            self.next.update((first,))
            self.handle.registerTimer(first + self.size)
        return iter([])

    def closed(self, panes: dict[int, int], start: int, watermark: int) -> tuple[list[tuple[int, int]], int]:
        """The windows from ``start`` on that end by the watermark, with their counts, and the next start."""
        at = sorted(panes)
        before = [0]
        for p in at:
            before.append(before[-1] + panes[p])
        out = []
        while start + self.size <= watermark:
            lo, hi = bisect_left(at, start), bisect_left(at, start + self.size)
            if hi > lo:
                out.append((start, before[hi] - before[lo]))
                start += self.slide
            elif lo < len(at):
                start = max(start + self.slide, self._first_start(at[lo]))  # over the gap
            else:
                break
        return out, start

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if not self.next.exists():
            return
        panes = {p[0]: n[0] for p, n in self.panes.iterator()}
        found, start = self.closed(panes, self.next.get()[0], timerValues.getCurrentWatermarkInMs())
        left = [p for p in panes if p // self.slide * self.slide >= start]
        for p in panes.keys() - set(left):
            self.panes.removeKey((p,))
        if left:
            start = max(start, self._first_start(min(left)))
            self.next.update((start,))
            self.handle.registerTimer(start + self.size)
        else:
            self.next.clear()
        if found:
            yield pd.DataFrame({"key": [key[0]] * len(found), "start": [s for s, _ in found], "n": [n for _, n in found]})

    def close(self) -> None:
        pass


def ring_window_counts(events: DataFrame, ts: str, key: str, size: str, slide: str, watermark: str) -> DataFrame:
    """Counts per closed window and key of a stream: ``(window_start, window_end, key, n)``, append mode.

    Events without time are left out; those behind the watermark are dropped
    (``late.split_late`` keeps them); a null key is a key.
    """
    size_ms, slide_ms = _seconds(size) * 1000, _seconds(slide) * 1000
    counted = (events.where(F.col(ts).isNotNull()).select(F.col(key).cast("string").alias("key"), F.unix_millis(ts).alias("at"))
               .mapInPandas(_count_panes(math.gcd(size_ms, slide_ms)), _COUNTED))
    timed = counted.select("key", "pane", "n", F.timestamp_millis("last").alias("event_time")).withWatermark("event_time", watermark)
    sent = timed.groupBy("key").transformWithStateInPandas(
        PaneRing(size_ms, slide_ms), "key string, start long, n long", "Append", "EventTime")
    return sent.select(F.timestamp_millis("start").alias("window_start"),
                       F.timestamp_millis(F.col("start") + size_ms).alias("window_end"), F.col("key").alias(key), "n")
