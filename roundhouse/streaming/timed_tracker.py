"""The item tracker over an endless stream: keyed map state, timers that close silent rounds, and late rows as a side output.

A round's state is a map of its live tracks and a value with the last processed frame. Rows carry the time at which they
were seen; the watermark follows it. A round from which nothing was seen for `silence` is closed by a timer: its good tracks
come out without any further row of it. Its last frame is remembered for `memory` more, so that what arrives even later is
still told apart: a frame not after the last processed one is late. Each late row comes out once, as a row of kind 'late',
whether or not a track closes. State and timers are in the checkpoint, so a restart neither repeats nor loses rows.

Rows without det_id move the clock of their round but are no detections; a null round_id is a round of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from roundhouse.streaming.tracker import Tracks, detections, in_order

OUT = "round_id long, kind string, track_key int, det_id long, first_frame long, last_frame long, n_obs int"
_NAMES = [x.split()[0] for x in OUT.split(", ")]
#: last_frame of the round, next track, when it was last seen (ms), and whether its tracks are closed.
_ROUND = "last_frame long, next_id int, seen long, closed boolean"
_TRACK = "x double, y double, first long, last long, n int"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class RoundTracker(StatefulProcessor):
    def __init__(self, reach: float, recency: int, least_obs: int, least_span: int, silence_ms: int, memory_ms: int):
        self.reach, self.recency, self.least_obs, self.least_span = reach, recency, least_obs, least_span
        self.silence_ms, self.memory_ms = silence_ms, memory_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.round = handle.getValueState("round", _ROUND)
        self.live = handle.getMapState("tracks", "track int", _TRACK)

    def _out(self, key: tuple, closed: list[list], late: list[tuple[int, int]] = ()) -> pd.DataFrame:
        good = [t for t in closed if t[5] >= self.least_obs and t[4] - t[3] >= self.least_span]
        rows = [(key[0], "track", t[0], None, t[3], t[4], t[5]) for t in good] + [(key[0], "late", None, det, frame, frame, 1) for frame, det in late]
        out = pd.DataFrame(rows, columns=_NAMES)
        return out.astype({"track_key": "Int32", "det_id": "Int64"})

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last, next_id, seen, _ = self.round.get() if self.round.exists() else (-1, 0, 0, False)
        tracks = Tracks(None)
        tracks.frame, tracks.next_id = last, next_id
        tracks.live = sorted([k[0], *t] for k, t in self.live.iterator())
        before = {t[0]: tuple(t[1:]) for t in tracks.live}
        batches = list(rows)
        seen = max(seen, *(int(pdf["seen_ms"].max()) for pdf in batches))
        own = in_order(detections(batches))
        late, closed = [r for r in own if r[0] <= last], []
        for frame, dets in groupby((r for r in own if r[0] > last), key=lambda r: r[0]):
            closed += tracks.add_frame(int(frame), [r[3:] for r in dets], self.reach, self.recency)
        after = {t[0]: tuple(t[1:]) for t in tracks.live}
        for track in before.keys() - after.keys():
            self.live.removeKey((track,))
        for track, values in after.items():  # only what changed is written
            if before.get(track) != values:
                self.live.updateValue((track,), values)
        self.round.update((tracks.frame, tracks.next_id, seen, False))
        self._wake(seen + self.silence_ms)
        yield self._out(key, closed, [(int(r[0]), int(r[1])) for r in late])

    def _wake(self, at: int) -> None:
        """One timer a round: the latest."""
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(at)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last, next_id, seen, closed = self.round.get()
        if closed:  # nothing came since: the round is forgotten
            self.round.clear()
            yield self._out(key, [])
            return
        out = sorted([k[0], *t] for k, t in self.live.iterator())
        self.live.clear()
        self.round.update((last, next_id, seen, True))
        self.handle.registerTimer(expiredTimerInfo.getExpiryTimeInMs() + self.memory_ms)
        yield self._out(key, out)

    def close(self) -> None:
        pass


def use_rocksdb(spark: SparkSession) -> None:
    """Timers and map state need this state store: set it for the session's streams, at their entry."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


def track_timed(dets: DataFrame, delay: str = "0 seconds", silence_s: float = 60.0, memory_s: float = 3600.0, reach: float = 35.0, recency: int = 75, least_obs: int = 30, least_span: int = 50) -> DataFrame:
    """Closed tracks (kind 'track') and late rows (kind 'late') of a stream of detections (round_id, frame_id, det_id, cx, cy, conf, seen_at).

    delay: how far behind the latest seen_at the watermark is; rows seen before it are dropped by Spark, so seen_at should be the time of arrival.
    """
    processor = RoundTracker(reach, recency, least_obs, least_span, int(silence_s * 1000), int(memory_s * 1000))
    rows = dets.withColumn("seen_ms", F.unix_millis("seen_at")).withWatermark("seen_at", delay)
    return rows.groupBy("round_id").transformWithStateInPandas(processor, OUT, "Append", "EventTime")
